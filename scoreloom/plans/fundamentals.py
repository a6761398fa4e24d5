"""Figures from filings, normalised, and the fundamental score."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.numbers import (
    clip, decimals_to_double, divide, first_number, money_to_eur, round_half_away, version_number,
)
from scoreloom.operators.keyed import first_per_key
from scoreloom.operators.ranking import percent_rank, percentile_values

# Weight of each metric, in scoring order.
WEIGHTS = {"ca_growth": 0.25, "marge_op": 0.30, "levier": 0.25, "fcf_yield": 0.20}
LESS_IS_BETTER = {"levier"}

MONEY = {"ca": "ca_raw", "ebitda": "ebitda_raw", "dette_nette": "dette_nette_raw", "fcf": "fcf_raw"}
PERCENT = {"ca_growth": "ca_growth_raw", "marge_op": "marge_op_raw"}
LINEAGE = ["parser_used", "llm_model", "llm_prompt_version", "llm_prompt_version_num", "source", "source_run_id",
           "financial_signal_run_id", "extracted_at"]


def successful(staging: DataFrame, prompt_version: str | None = None, since: Column | None = None) -> DataFrame:
    """Successful extractions, of one prompt version or extracted lately if asked."""
    rows = staging.where(F.col("extraction_status") == "success")
    if prompt_version is not None:
        rows = rows.where(F.col("llm_prompt_version") == prompt_version)
    if since is not None:
        rows = rows.where(F.col("extracted_at") >= since)
    return rows.withColumn("llm_prompt_version_num", version_number(F.col("llm_prompt_version")))


def lookback_mark(target: DataFrame, days: int = 7) -> Column:
    """`days` before the newest row of the target, or the epoch for an empty one."""
    newest = target.agg(F.max("extracted_at")).scalar()
    return F.coalesce(newest - F.make_dt_interval(F.lit(days)), F.lit("1970-01-01").cast("timestamp_ntz"))


VERSION_ORDER = ["llm_prompt_version_num", "extracted_at", "financial_signal_run_id"]


def best_version(rows: DataFrame) -> DataFrame:
    """One row per record: highest prompt version, then the newest."""
    return first_per_key(rows, ["record_id"], [F.col(c).desc() for c in VERSION_ORDER])


def financial_signal(
    staging: DataFrame, as_of: dt.datetime, prompt_version: str | None = None, target: DataFrame | None = None
) -> DataFrame:
    """One row per record with figures as numbers: money in EUR, percentages as doubles.

    With a `target` only the last week before its newest row is read, and stored rows of those
    records compete, so that a late run of an older prompt does not replace a newer one.
    """
    rows = successful(staging, prompt_version, None if target is None else lookback_mark(target))
    best = best_version(rows)
    fresh = best.select(
        "record_id", "isin", "ticker", "source_url", "pdf_gcs_uri", "document_publication_ts",
        clock.strict_date(F.col("date_cloture_exercice_raw")).alias("date_cloture_exercice"),
        *[money_to_eur(F.col(raw)).alias(name) for name, raw in MONEY.items()],
        *[first_number(F.col(raw)).alias(name) for name, raw in PERCENT.items()],
        *LINEAGE,
        clock.at(as_of).alias("loaded_at"),
    )
    if target is None:
        return fresh
    stored = target.join(fresh.select("record_id"), "record_id", "left_semi").select(*fresh.columns)
    return best_version(fresh.unionByName(stored))


def ratios(signal: DataFrame) -> DataFrame:
    """One row per (ticker, period) with leverage and cash yield."""
    dated = signal.where(F.col("date_cloture_exercice").isNotNull() & F.col("ticker").isNotNull())
    newest = [F.col("extracted_at").desc(), F.col("llm_prompt_version_num").desc(), F.col("record_id")]
    rows = decimals_to_double(first_per_key(dated, ["ticker", "date_cloture_exercice"], newest))
    return rows.withColumns(
        {
            "levier": F.when(F.col("ebitda") > 0, F.col("dette_nette") / F.col("ebitda")),
            "fcf_yield": F.when(F.col("ca") > 0, F.col("fcf") / F.col("ca")),
        }
    )


def winsorised(rows: DataFrame, low: float, high: float) -> DataFrame:
    """Each metric clipped to its percentiles, as `<metric>_w`; a missing metric stays missing.

    The percentiles are found at once, by jobs over `rows`, and are constants of the plan.
    """
    limits = percentile_values(rows, list(WEIGHTS), {"low": low, "high": high})
    limit = {name: F.lit(value).cast("double") for name, value in limits.items()}
    return rows.withColumns({f"{m}_w": clip(F.col(m), limit[f"low_{m}"], limit[f"high_{m}"]) for m in WEIGHTS})


def z_scores(rows: DataFrame) -> DataFrame:
    """Distance from the mean in standard deviations, over all periods of all companies."""
    moments = [f(f"{m}_w").alias(f"{name}_{m}") for m in WEIGHTS for name, f in (("mu", F.avg), ("sd", F.stddev_samp))]
    moments = rows.agg(*moments).select(F.struct("*")).scalar()
    held = F.lit(0)
    z = {}
    for m in WEIGHTS:
        score = divide(F.col(f"{m}_w") - F.col(f"_moments.mu_{m}"), F.col(f"_moments.sd_{m}"))
        z[f"z_{m}"] = -score if m in LESS_IS_BETTER else score
        held = held + F.col(f"{m}_w").isNotNull().cast("int")
    return rows.withColumn("_moments", moments).withColumns({**z, "nb_metrics": held}).drop("_moments")


def weighted(rows: DataFrame, min_metrics: int, weights: dict[str, float]) -> DataFrame:
    """Mean of the available z-scores, with the weights of the missing ones shared out."""
    total, product = F.lit(0.0), F.lit(0.0)
    for m, w in weights.items():
        z = F.col(f"z_{m}")
        total = total + F.when(z.isNotNull(), w).otherwise(0.0)
        product = product + F.coalesce(z * w, F.lit(0.0))
    return (
        rows.where(F.col("nb_metrics") >= min_metrics)
        .withColumn("total_weight", total)
        .withColumn("z_composite", divide(product, F.col("total_weight")))
    )


def financials_score(
    rows: DataFrame, as_of: dt.datetime, weights: dict[str, float] = WEIGHTS, min_metrics: int = 2,
) -> DataFrame:
    """Fundamental score per (ticker, period): 0..10 by rank among all of them.

    `rows` are the z-scores; the rank reads them for its cuts and writes them once, with their places.
    """
    ranked = percent_rank(weighted(rows, min_metrics, weights), "z_composite", "_share")
    return ranked.select(
        "ticker", "isin", "date_cloture_exercice",
        round_half_away(F.col("_share") * 10, 2).alias("score_fondamental"),
        F.col("ca_growth").alias("ca_growth_pct"),
        F.col("marge_op").alias("marge_op_pct"),
        round_half_away(F.col("levier"), 2).alias("levier_dette_ebitda"),
        round_half_away(F.col("fcf_yield") * 100, 2).alias("fcf_yield_pct"),
        *[round_half_away(F.col(f"z_{m}"), 3).alias(f"z_{m}") for m in weights],
        round_half_away(F.col("z_composite"), 3).alias("z_composite"),
        "nb_metrics",
        round_half_away(F.col("total_weight"), 2).alias("coverage_score"),
        "source", "financial_signal_run_id", "extracted_at",
        clock.at(as_of).alias("scored_at"),
    )
