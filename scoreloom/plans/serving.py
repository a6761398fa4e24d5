"""The read queries on the gold tables."""

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.text import LOOSE_CODE
from scoreloom.operators.keyed import newest_per_key
from scoreloom.plans.news import NEWS_DAYS, within_days

RECENT_LIMIT = 500


def latest_scores(stocks: DataFrame) -> DataFrame:
    return (
        stocks.where("is_latest")
        .select("isin", "company_name", "yf_ticker", "date", F.col("Close").alias("close"), "score_technique",
                "score_7d_avg", "rsi_signal", "macd_signal", "golden_cross_signal", "bollinger_signal", "trend_signal")
        .orderBy(F.desc("score_technique"), F.desc("score_7d_avg"), "isin")
    )


def valid_codes(isins: list[str]) -> list[str]:
    wrong = [i for i in isins if not re.match(LOOSE_CODE, i)]
    if wrong:
        raise ValueError(f"invalid codes: {wrong}")
    return isins


def score_history(stocks: DataFrame, isins: list[str], as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Scores of some companies over the last `days`, 1 to 365."""
    if not 1 <= days <= 365:
        raise ValueError(f"days must be 1 to 365: {days}")
    since = F.date_sub(clock.at(as_of).cast("date"), days)
    return (
        stocks.where(F.col("isin").isin(valid_codes(isins)) & (F.col("date") >= since))
        .select("isin", "company_name", "date", "score_technique", "score_7d_avg")
        .orderBy("isin", "date")
    )


def _newest_snapshot(table: DataFrame) -> DataFrame:
    """Of a table in folders by `score_date` (`write_snapshots`) one folder is scanned; the newest day comes from the folder names."""
    return table.where(F.col("score_date") == table.agg(F.max("score_date")).scalar())


def latest_composite(scores: DataFrame) -> DataFrame:
    columns = ["isin", "name", "ticker_bourso", "score_date", "composite_score", "score_news", "score_stock",
               "score_insider", "score_financials"]
    return _newest_snapshot(scores).select(*columns).orderBy(F.desc("composite_score"), "isin")


def latest_news(news: DataFrame) -> DataFrame:
    columns = ["isin", "matched_name", "ticker_bourso", "mention_count_45d", "avg_sentiment_45d",
               "investment_score", "score_date"]
    return _newest_snapshot(news).select(*columns).orderBy(F.desc("investment_score"), "isin")


def recent_insider(insider: DataFrame, as_of: dt.datetime, days: int = NEWS_DAYS) -> DataFrame:
    since = F.date_sub(clock.at(as_of).cast("date"), days)
    columns = ["isin", "societe", "signal_date", "insider_names", "num_operations", "total_amount", "score_1_10"]
    return (
        insider.where(F.col("signal_date") >= since)
        .select(*columns)
        .orderBy(F.desc("signal_date"), F.desc("score_1_10"), "isin")
    )


def latest_financials(financials: DataFrame) -> DataFrame:
    columns = ["ticker", "isin", "date_cloture_exercice", "score_fondamental", "ca_growth_pct", "marge_op_pct",
               "levier_dette_ebitda", "fcf_yield_pct", "nb_metrics", "coverage_score"]
    newest = newest_per_key(financials, ["isin"], "date_cloture_exercice",
                            [F.desc("score_fondamental"), F.col("ticker")])
    return newest.select(*columns).orderBy(F.desc("score_fondamental"), "ticker")


SENTIMENT = ["isin", "matched_name", "title", "published_at", "sentiment_score", "sentiment_reason"]


def recent_sentiments(
    sentiment: DataFrame, as_of: dt.datetime, days: int = NEWS_DAYS, limit: int = RECENT_LIMIT
) -> DataFrame:
    rows = sentiment.where(within_days("published_at", as_of, days))
    return rows.orderBy(F.desc("published_at"), "row_id").limit(limit).select(*SENTIMENT)


def top_companies(scores: DataFrame, score_date, n: int) -> DataFrame:
    return (
        scores.where(F.col("score_date") == F.lit(score_date))
        .select("name", "ticker_bourso", "composite_score", "score_news", "score_stock", "score_insider",
                "score_financials")
        .orderBy(F.desc("composite_score"), "name")
        .limit(n)
    )


def lookup_company(table: DataFrame, name_column: str, name_part: str, ticker: str) -> DataFrame:
    return table.where(F.contains(F.col(name_column), F.lit(name_part)) | (F.col("ticker_bourso") == ticker))


def recent_articles(sentiment: DataFrame, isin: str, n: int = 5) -> DataFrame:
    rows = sentiment.where(F.col("isin") == isin).orderBy(F.desc("published_at"), "row_id").limit(n)
    return rows.select("title", "published_at", "sentiment_score", "sentiment_reason")


def articles_driving_score(sentiment: DataFrame, isin: str, as_of: dt.datetime, days: int = NEWS_DAYS) -> DataFrame:
    rows = sentiment.where((F.col("isin") == isin) & within_days("published_at", as_of, days))
    columns = ["title", "published_at", "sentiment_score", "sentiment_reason"]
    return rows.orderBy(F.desc("sentiment_score"), F.desc("published_at"), "row_id").select(*columns)


def beyond(column: str, above: float | None = None, below: float | None = None, at_least: float | None = None) -> Column:
    """Condition that a score lies beyond the given limits."""
    kept = F.lit(True)
    for limit, test in ((above, lambda c, x: c > x), (below, lambda c, x: c < x), (at_least, lambda c, x: c >= x)):
        if limit is not None:
            kept = kept & test(F.col(column), limit)
    return kept


def screened(table: DataFrame, screens: dict[str, Column]) -> DataFrame:
    """Each row once per screen it passes, named in `screen`; the table is read once."""
    passed = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in screens.items()]))
    return table.withColumn("screen", F.explode(passed))
