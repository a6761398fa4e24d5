"""The company universe: one cleaned row per company and snapshot."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.functions.text import nonblank
from scoreloom.operators.keyed import first_per_key, newest_per_key


def companies(listing: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Today's snapshot: trimmed names, upper-case codes, the first name per code."""
    cleaned = listing.where(nonblank(F.col("isin"))).select(
        F.trim("name").alias("name"),
        F.upper(F.trim("isin")).alias("isin"),
        F.trim("ticker_bourso").alias("ticker_bourso"),
        clock.local_date(as_of).alias("snapshot_date"),
    )
    return first_per_key(cleaned, ["isin"], [F.col("name"), F.col("ticker_bourso")])


def latest_companies(snapshots: DataFrame) -> DataFrame:
    return newest_per_key(snapshots, ["isin"], "snapshot_date", [F.col("name")])


def resolve_ticker(rows: DataFrame, overrides: DataFrame, resolver: DataFrame) -> DataFrame:
    """Price ticker of each company: the manual override, else the resolver table, else NULL.

    Both tables have one row per isin; whether either is small enough to broadcast is for the
    optimizer's size check.
    """
    manual = overrides.select("isin", F.col("ticker").alias("_manual"))
    found = resolver.select("isin", F.nullif(F.col("ticker"), F.lit("")).alias("_found"))
    return (
        rows.join(manual, "isin", "left")
        .join(found, "isin", "left")
        .withColumn("yf_ticker", F.coalesce("_manual", "_found"))
        .drop("_manual", "_found")
    )
