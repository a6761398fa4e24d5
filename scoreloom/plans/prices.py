"""Daily prices: cleaning, and the technical score built on the indicators."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.numbers import divide, round_half_away
from scoreloom.operators.joins import lookup
from scoreloom.operators.keyed import newest_per_key
from scoreloom.plans.companies import latest_companies

SIGNALS = ["rsi_signal", "macd_signal", "golden_cross_signal", "bollinger_signal", "trend_signal"]

# Signal limits and the lengths of the two smoothed scores.
OVERSOLD, OVERBOUGHT = 35, 65
BAND_LOW, BAND_HIGH = 0.2, 0.8
SHORT_ROWS, LONG_ROWS = 7, 14


def valid_price() -> Column:
    """A code, and positive finite prices; Spark sorts NaN above all numbers, so an upper bound keeps it out."""
    infinite = F.lit(float("inf"))
    positive = [(F.col(c) > 0) & (F.col(c) < infinite) for c in ("Close", "Open")]
    return F.col("isin").isNotNull() & positive[0] & positive[1]


def session_closed(as_of: dt.datetime) -> Column:
    """Leaves out today's bar while the market is open."""
    return F.col("Date") <= clock.last_closed_session(as_of)


def in_rewrite_months(as_of: dt.datetime) -> Column:
    """From the first day of the month that held the day a week ago."""
    return F.col("Date") >= F.trunc(F.date_sub(clock.local_date(as_of), 7), "month")


def clean_bars(raw: DataFrame, as_of: dt.datetime, incremental: bool = False, ties: list = ()) -> DataFrame:
    """Valid, closed sessions, the latest ingestion per (isin, Date)."""
    kept = raw.where(valid_price() & session_closed(as_of))
    if incremental:
        kept = kept.where(in_rewrite_months(as_of))
    newest = newest_per_key(kept, ["isin", "Date"], "ingested_at", list(ties))
    return newest.select("Date", "Open", "High", "Low", "Close", "Volume", "isin", "yf_ticker")


def last_dates(bars: DataFrame) -> DataFrame:
    return bars.groupBy("isin").agg(F.max("Date").alias("last_date"))


def only_newer(new_bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows after the last stored day of their company; unknown companies keep all rows."""
    marked = lookup(new_bars, last_dates(stored), ["isin"])
    return marked.where(F.col("last_date").isNull() | (F.col("Date") > F.col("last_date"))).drop("last_date")


def _known(name: str) -> Column:
    """Files written by other tools hold NaN for a missing indicator; Spark sorts NaN above all numbers."""
    return F.when(~F.isnan(name), F.col(name))


def _above(left: Column, right: Column) -> Column:
    missing = left.isNull() | right.isNull()
    return F.when(missing, 1.0).when(left > right, 2.0).otherwise(0.0)


def signals(rows: DataFrame) -> DataFrame:
    """Five signals of 0, 1 or 2 points; a missing indicator is neutral."""
    rsi = _known("RSI_14")
    place = divide(F.col("Close") - _known("BB_lower"), _known("BB_upper") - _known("BB_lower"))
    return rows.withColumns(
        {
            "rsi_signal": F.when(rsi < OVERSOLD, 2.0).when(rsi >= OVERBOUGHT, 0.0).otherwise(1.0),
            "macd_signal": _above(_known("MACD"), _known("MACD_signal")),
            "golden_cross_signal": _above(_known("SMA_50"), _known("SMA_200")),
            "bollinger_signal": F.when(place < BAND_LOW, 2.0).when(place > BAND_HIGH, 0.0).otherwise(1.0),
            "trend_signal": F.when(_known("EMA_20").isNull(), 1.0)
            .when(F.col("Close") > _known("EMA_20"), 2.0)
            .otherwise(0.0),
        }
    )


def stocks_score(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Technical score per company and day, two smoothed scores, and the latest-day flag.

    `rows` are indicator rows, one per (isin, Date): the windows are bounded by the calendar and
    share one exchange on `isin` with the join.
    """
    scored = signals(rows.where(F.col("isin").isNotNull()))
    points = F.col("rsi_signal")
    for name in SIGNALS[1:]:
        points = points + F.col(name)
    series = Window.partitionBy("isin").orderBy("Date")
    everything = Window.partitionBy("isin")
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    smoothed = scored.withColumn("_points", points).withColumns(
        {
            "_total": F.sum("_points").over(so_far),  # points are whole numbers, so totals are exact
            "_rows": F.row_number().over(series),
            "is_latest": F.col("Date") == F.max("Date").over(everything),
        }
    )

    def mean(rows: int) -> Column:
        before = F.coalesce(F.lag("_total", rows).over(series), F.lit(0.0))
        return round_half_away((F.col("_total") - before) / F.least("_rows", F.lit(rows)), 1)

    smoothed = smoothed.withColumns({"score_7d_avg": mean(SHORT_ROWS), "score_14d_avg": mean(LONG_ROWS)})
    names = latest_companies(snapshots).select("isin", "name")
    return smoothed.join(names, "isin", "left").select(
        "isin",
        F.coalesce("name", "yf_ticker").alias("company_name"),
        "yf_ticker",
        F.col("Date").alias("date"),
        "Close",
        *SIGNALS,
        F.round("_points", 1).alias("score_technique"),
        "score_7d_avg",
        "score_14d_avg",
        "is_latest",
    )


def latest_stocks_score(rows: DataFrame) -> DataFrame:
    """Technical score of each company's last day, from `latest_indicators`; what the composite takes of `stocks_score`."""
    points = F.col("rsi_signal")
    for name in SIGNALS[1:]:
        points = points + F.col(name)
    scored = signals(rows.where(F.col("isin").isNotNull()))
    return scored.select("isin", F.col("Date").alias("date"), "Close", *SIGNALS, F.round(points, 1).alias("score_technique"),
                         F.lit(True).alias("is_latest"))
