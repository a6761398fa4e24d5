"""Attaching a keyed table to rows whose keys may be very unevenly spread."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000
SPREAD = 997


def lookup(rows: DataFrame, table: DataFrame, on: list, copies: str | None = None) -> DataFrame:
    """Left join of `rows` to `table`, which has one row per key.

    The HEAVY_KEYS most frequent keys are joined by broadcast: that side has at most HEAVY_KEYS
    rows whatever the data size.  Their rows, and rows with a NULL key, carry a salt that matches
    nothing in the second join, so they spread over its tasks; any other key holds less than
    1/HEAVY_KEYS of the rows.  The salt is a digest of the whole row: a task that is run again after
    a lost executor sends each row where it went before.  `copies` names a column of `table` that already counts the rows per
    key; without it the keys are counted first (partial counts before the exchange).
    """
    values = [c for c in table.columns if c not in on and c != copies]
    if copies is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_copies"))
        top = counts.orderBy(F.desc("_copies")).limit(HEAVY_KEYS).select(*on)
        heavy = table.join(F.broadcast(top), on, "left_semi")
    else:
        heavy = table.orderBy(F.desc(copies)).limit(HEAVY_KEYS)
    heavy = heavy.select(*on, *[F.col(c).alias(f"_h_{c}") for c in values]).withColumn("_heavy", F.lit(True))

    keyless = F.lit(False)
    for c in on:
        keyless = keyless | F.col(c).isNull()
    hashable = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(SPREAD)).cast("int") + 1
    first = rows.join(F.broadcast(heavy), on, "left").withColumn(
        "_salt", F.when(F.col("_heavy") | keyless, spread).otherwise(F.lit(0))
    )
    light = table.select(*on, *[F.col(c).alias(f"_l_{c}") for c in values]).withColumn("_salt", F.lit(0))
    both = first.join(light, [*on, "_salt"], "left")
    return both.select(
        *[F.col(c) for c in rows.columns],
        *[F.when(F.col("_heavy"), F.col(f"_h_{c}")).otherwise(F.col(f"_l_{c}")).alias(c) for c in values],
    )
