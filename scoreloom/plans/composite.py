"""The composite score: the newest score of each kind per company, on one scale."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.numbers import rescale_1_10, round_half_away
from scoreloom.operators.keyed import newest_per_key
from scoreloom.plans.companies import latest_companies

# Equal weights, and the mid-point for a missing score.
WEIGHTS = {"score_news": 0.25, "score_stock": 0.25, "score_insider": 0.25, "score_financials": 0.25}
DEFAULT = 5.0
INSIDER_DAYS = 45


def company_scores(
    snapshots: DataFrame, news: DataFrame, stocks: DataFrame, insider: DataFrame, financials: DataFrame,
    as_of: dt.datetime, weights: dict[str, float] = WEIGHTS, default: float = DEFAULT,
) -> DataFrame:
    """Every company once.  All five sides are reduced to one row per isin before they meet."""
    recent = insider.where(F.col("signal_date") >= F.date_sub(clock.local_date(as_of), INSIDER_DAYS))
    news = newest_per_key(news, ["isin"], "score_date", [F.col("investment_score").desc()])
    stocks = newest_per_key(stocks.where("is_latest"), ["isin"], "date", [F.col("score_technique").desc()])
    recent = newest_per_key(recent, ["isin"], "signal_date", [F.col("score_1_10").desc()])
    newest_report = newest_per_key(
        financials, ["isin"], "date_cloture_exercice", [F.col("score_fondamental").desc()]
    )
    rows = (
        latest_companies(snapshots)
        .join(news.select("isin", "investment_score"), "isin", "left")
        .join(stocks.select("isin", "score_technique"), "isin", "left")
        .join(recent.select("isin", "score_1_10"), "isin", "left")
        .join(newest_report.select("isin", "score_fondamental"), "isin", "left")
    )
    scores = {
        "score_news": rescale_1_10(F.col("investment_score")),
        "score_stock": F.col("score_technique"),
        "score_insider": rescale_1_10(F.col("score_1_10")),
        "score_financials": F.col("score_fondamental"),
    }
    rows = rows.withColumns({name: F.coalesce(c, F.lit(default)) for name, c in scores.items()})
    composite = F.lit(0.0)
    for name, weight in weights.items():
        composite = composite + F.col(name) * weight
    return rows.select(
        "isin", "name", "ticker_bourso", "snapshot_date",
        *[round_half_away(F.col(name), 2).alias(name) for name in scores],
        round_half_away(composite, 2).alias("composite_score"),
        clock.local_date(as_of).alias("score_date"),
    )
