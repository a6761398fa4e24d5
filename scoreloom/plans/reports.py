"""Aggregates behind the dashboards: key figures, histograms, freshness, run counters, matrices."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from scoreloom.functions.text import signal_label
from scoreloom.plans.prices import SIGNALS

# Limits shown on the dashboards.
OPPORTUNITY, STRONG, GOLDEN = 6, 7, 2
BINS, TOP_SCORE = 20, 10
DIMENSIONS = ["score_news", "score_stock", "score_insider", "score_financials"]


def composite_kpis(scores: DataFrame) -> DataFrame:
    best = F.struct("composite_score", "name")
    return scores.agg(
        F.count(F.lit(1)).alias("companies"),
        F.avg("composite_score").alias("mean_score"),
        F.count_if(F.col("composite_score") >= OPPORTUNITY).alias("opportunities"),
        F.max_by("name", best).alias("top_name"),
        F.max("composite_score").alias("top_score"),
    )


def technical_kpis(scores: DataFrame) -> DataFrame:
    """Over one row per company, best first by score, then by its 7-day mean."""
    order = F.struct("score_technique", "score_7d_avg", "company_name")
    strong = F.count_if(F.col("score_technique") >= STRONG)
    return scores.agg(
        F.count(F.lit(1)).alias("companies"),
        F.max_by("company_name", order).alias("top_name"),
        F.max("score_technique").alias("top_score"),
        (strong / F.count(F.lit(1)) * 100).alias("pct_strong"),
        F.count_if(F.col("golden_cross_signal") == GOLDEN).alias("golden_crosses"),
    )


def score_histogram(scores: DataFrame, score: str, high_zone: float) -> DataFrame:
    """Rows per bin of a 0..10 score, with the zone the bin lies in."""
    width = TOP_SCORE / BINS
    place = F.least(F.floor(F.col(score) / width), F.lit(BINS - 1)).cast("int")
    start = F.col("bin") * width
    zone = F.when(start < 4, "caution").when(start < high_zone, "neutral").otherwise("opportunity")
    return (
        scores.where(F.col(score).isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("companies"))
        .select("bin", start.alias("bin_start"), zone.alias("zone"), "companies")
    )


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The newest date of each table: name -> (table, date column)."""
    parts = [
        df.agg(F.max(F.col(column).cast("date")).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        for name, (df, column) in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_counters(rows: DataFrame, run: str, status: str) -> DataFrame:
    """Rows per run, and how many ended in each kind of status."""
    good = F.col(status) == "success"
    skipped = F.col(status) == "no_financial_data"
    return rows.groupBy(run).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("success"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(F.col(status).isNull() | ~(good | skipped)).alias("errors"),
    )


def counted_write(rows: DataFrame, run: str, status: str, runs: list[str], path: str) -> DataFrame:
    """Append `rows` to the table at `path` and give the counters of `runs`, taken by the same job as it writes.

    `runs` are the run ids of the batch, few and known to the caller; rows of other runs are written, not counted.
    """
    counts = []
    for k, name in enumerate(runs):
        of_run = F.col(run) == F.lit(name)
        good, skipped = F.col(status) == "success", F.col(status) == "no_financial_data"
        counts += [
            F.count_if(of_run).alias(f"total_{k}"), F.count_if(of_run & good).alias(f"success_{k}"),
            F.count_if(of_run & skipped).alias(f"skipped_{k}"),
            F.count_if(of_run & (F.col(status).isNull() | ~(good | skipped))).alias(f"errors_{k}"),
        ]
    seen = Observation()
    rows.observe(seen, *counts).write.mode("append").parquet(path)
    found = seen.get
    kinds = ("total", "success", "skipped", "errors")
    data = [(name, *(found[f"{kind}_{k}"] for kind in kinds)) for k, name in enumerate(runs)]
    schema = f"`{run}` {rows.schema[run].dataType.simpleString()}, " + ", ".join(f"{kind} bigint" for kind in kinds)
    return rows.sparkSession.createDataFrame(data, schema).where("total > 0")


def numbered_top(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows with their place; the window sees n rows only."""
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _ends(scores: DataFrame, descending: bool) -> list[Column]:
    turn = (lambda c: F.desc(c)) if descending else (lambda c: F.asc(c))
    return [turn("score_technique"), turn("score_7d_avg"), turn("isin")]


def technical_ranking(scores: DataFrame, n: int = 10, flop: bool = False) -> DataFrame:
    """The n best companies of the latest day, or the n last ones."""
    return numbered_top(scores, _ends(scores, not flop), n)


def labelled_ranking(scores: DataFrame, n: int = 10) -> DataFrame:
    return technical_ranking(scores, n).withColumns({f"{s}_label": signal_label(F.col(s)) for s in SIGNALS})


def profile_matrix(scores: DataFrame, n: int = 5) -> DataFrame:
    """The four scores of the n best companies, one row per company and dimension."""
    top = scores.orderBy(F.desc("composite_score"), "isin").limit(n)
    return top.unpivot(["isin", "name"], DIMENSIONS, "dimension", "score")


def signal_heatmap(scores: DataFrame, n: int = 10, flop: bool = False) -> DataFrame:
    top = scores.orderBy(*_ends(scores, not flop)).limit(n)
    return top.unpivot(["isin", "company_name"], SIGNALS, "signal", "points")


def news_scatter(news: DataFrame) -> DataFrame:
    return news.select("isin", "matched_name", "mention_count_45d", "avg_sentiment_45d", "investment_score")


def growth_margin_scatter(financials: DataFrame) -> DataFrame:
    return financials.dropna(subset=["ca_growth_pct", "marge_op_pct"]).select(
        "ticker", "date_cloture_exercice", "ca_growth_pct", "marge_op_pct", "score_fondamental"
    )


def financials_with_names(financials: DataFrame, stocks: DataFrame) -> DataFrame:
    """Fundamental scores labelled with the company's name, else its ticker."""
    names = stocks.where("is_latest").groupBy("isin").agg(F.min("company_name").alias("company_name"))
    return financials.join(names, "isin", "left").withColumn("company_name", F.coalesce("company_name", "ticker"))
