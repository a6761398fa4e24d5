"""News: one table of linked articles from all feeds, sentiment answers, and the news score."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.answers import usable_answers
from scoreloom.functions.numbers import greatest_or_null, round_half_away
from scoreloom.functions.text import article_key, entry_code, nonblank
from scoreloom.operators.keyed import first_per_key, newest_per_key, without
from scoreloom.operators.ranking import percent_rank

# Source tags of the three kinds of feed.
SOURCES = ["yahoo_rss", "google_news_rss", "abcbourse_rss"]
NEWS_DAYS = 45


def within_days(column: str, as_of: dt.datetime, days: int) -> Column:
    return F.col(column) >= clock.days_before(as_of, days)


def feed_articles(entries: DataFrame, source: str) -> DataFrame:
    """Matched entries of a feed whose dates are texts."""
    return _article(
        entries, source, F.col("summary"), clock.iso_timestamp(F.col("fetched_at")), clock.feed_timestamp(F.col("published"))
    )


def site_articles(entries: DataFrame, source: str) -> DataFrame:
    """Matched entries of a feed that comes with typed dates."""
    return _article(entries, source, F.col("description"), F.col("ingested_at"), F.col("published"))


def _article(entries: DataFrame, source: str, summary: Column, fetched: Column, published: Column) -> DataFrame:
    return entries.where(F.col("isin").isNotNull()).select(
        article_key(F.col("title"), F.col("isin")).alias("row_id"),
        "title", "link", summary.alias("summary"), "matched_name",
        F.col("match_score").cast("double").alias("match_score"),
        "isin", "ticker_bourso", fetched.alias("fetched_at"), F.lit(source).alias("source"),
        published.alias("published_at"),
    )


def newer_than_target(rows: DataFrame, target: DataFrame, sources: list = SOURCES) -> DataFrame:
    """Rows fetched after the newest stored row of their own source.

    The marks are one per known source, so they travel as a literal map instead of a join.
    """
    marks = target.where(F.col("source").isin(sources)).groupBy("source").agg(F.max("fetched_at").alias("mark"))
    marks = marks.agg(F.map_from_entries(F.collect_list(F.struct("source", "mark")))).scalar()
    mark = F.element_at(marks, F.col("source"))
    return rows.where(mark.isNull() | (F.col("fetched_at") > mark))


def articles(parts: list[DataFrame], target: DataFrame | None = None) -> DataFrame:
    """All feeds as one table, the newest fetch per article."""
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if target is not None:
        rows = newer_than_target(rows, target)
    return newest_per_key(rows, ["row_id"], "fetched_at", [F.col("source"), F.col("link"), F.col("title")])


def first_title(entries: DataFrame, order: list) -> DataFrame:
    """The first entry per title, in feed order."""
    return first_per_key(entries, ["title"], order)


def unseen_entries(entries: DataFrame, stored: DataFrame, order: list) -> DataFrame:
    """Entries whose guid (else link) is new for their category, once per batch, with their code."""
    keyed = entries.withColumn("guid", F.coalesce("guid", "link"))
    once = first_per_key(keyed, ["category", "guid"], order)  # first, so that no key is frequent in the join
    new = without(once, stored, ["category", "guid"])
    return new.withColumn("feed_isin", entry_code(F.col("isin_tag"), F.col("title"), F.col("summary")))


def unscored(rows: DataFrame, scored: DataFrame) -> DataFrame:
    return without(rows, scored, ["row_id"])


def article_sentiment(answered: DataFrame, model: str, as_of: dt.datetime, answer: str = "raw_response") -> DataFrame:
    """Scored articles; rows whose answer is unusable are left out."""
    return usable_answers(answered, answer).select(
        "row_id", "isin", "ticker_bourso", "matched_name", "title", "published_at",
        F.col("score").cast("bigint").alias("sentiment_score"),
        F.col("reason").alias("sentiment_reason"),
        F.lit(model).alias("groq_model"),
        clock.at(as_of).alias("scored_at"),
    )


def news_45d(sentiment: DataFrame, as_of: dt.datetime, days: int = NEWS_DAYS) -> DataFrame:
    return (
        sentiment.where(within_days("published_at", as_of, days))
        .groupBy("isin", "ticker_bourso", "matched_name")
        .agg(
            F.count(F.lit(1)).alias("mention_count_45d"),
            round_half_away(F.avg("sentiment_score"), 2).alias("avg_sentiment_45d"),
        )
    )


def score_news(sentiment: DataFrame, as_of: dt.datetime, days: int = NEWS_DAYS) -> DataFrame:
    """1..10 by the rank of a company's mean sentiment."""
    ranked = percent_rank(news_45d(sentiment, as_of, days), "avg_sentiment_45d", "_share")
    score = greatest_or_null(F.lit(1), F.ceil(F.col("_share") * 10).cast("int")).cast("bigint")
    return ranked.select(
        "isin", "ticker_bourso", "matched_name", "mention_count_45d", "avg_sentiment_45d",
        score.alias("investment_score"), clock.local_date(as_of).alias("score_date"),
    )


def matched_by_category(linked: DataFrame) -> DataFrame:
    """Linked entries only; the category column is the write partition."""
    return linked.where(nonblank(F.col("category")) & F.col("matched_name").isNotNull())
