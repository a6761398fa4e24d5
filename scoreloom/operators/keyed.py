"""Tables with a key: newest or first row per key, merges, rows not seen yet."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.operators.joins import SPREAD, lookup


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key, the first in `order` (make it total).

    Spark keeps only the best row per key on each map task before the exchange (WindowGroupLimit),
    so a key with a third of all rows sends one row per task, not its rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def newest_per_key(df: DataFrame, keys: list, newest: str, ties: list = ()) -> DataFrame:
    return first_per_key(df, keys, [F.col(newest).desc(), *ties])


def newest_n_per_key(df: DataFrame, keys: list, order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def _all_keys_present(keys: list) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _spread_keyless(df: DataFrame, keys: list) -> DataFrame:
    """Add `_salt`: 0, or a digest of the row where a key is NULL, so that such rows do not all meet in one task."""
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    digest = F.pmod(F.xxhash64(*hashable), F.lit(SPREAD)).cast("int") + 1
    return df.withColumn("_salt", F.when(_all_keys_present(keys), F.lit(0)).otherwise(digest))


def without(
    df: DataFrame, seen: DataFrame, keys: list, seen_keys: list | None = None, uneven: bool = False
) -> DataFrame:
    """Rows of `df` whose key is not in `seen`; each input is read once.

    A NULL key equals nothing, so such rows are kept, and spread over the tasks of the join.
    `uneven` is for rows that may repeat one key very often.
    """
    names = seen_keys or keys
    marks = seen.select(*[F.col(s).alias(k) for s, k in zip(names, keys)]).where(_all_keys_present(keys)).distinct()
    if uneven:
        return lookup(df, marks.withColumn("_seen", F.lit(True)), keys).where(F.col("_seen").isNull()).drop("_seen")
    marks = marks.withColumn("_salt", F.lit(0))
    return _spread_keyless(df, keys).join(marks, [*keys, "_salt"], "left_anti").select(*df.columns)


def upsert(target: DataFrame, new: DataFrame, keys: list) -> DataFrame:
    """`new` replaces the rows of `target` with the same key and adds the others."""
    return without(target, new, keys).unionByName(new)


def merge(target: DataFrame, source: DataFrame, keys: list, update: list, insert: bool = True) -> DataFrame:
    """The table after a MERGE: matched rows get the `update` columns, the rest stay as they are.

    With `insert`, unmatched source rows join with NULL in the columns they lack.  A source key that
    comes twice raises an error where it meets a target row.  Keys with a NULL match nothing.  One join reads each input once.
    """
    fresh = _spread_keyless(source.select(*keys, *update), keys)
    nth = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*update))  # the join's own partitioning
    fresh = fresh.withColumn("_nth", nth).withColumnsRenamed({c: f"_s_{c}" for c in update})
    old = _spread_keyless(target, keys).withColumn("_old", F.lit(True))
    joined = old.join(fresh, [*keys, "_salt"], "full" if insert else "left")
    repeated = F.col("_old") & (F.col("_nth") > 1)
    checked = joined.where(F.when(repeated, F.raise_error(F.lit(f"a source key of {keys} comes twice")).cast("boolean")).otherwise(True))
    return checked.select(
        *[
            F.when(F.col("_nth").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in target.columns
        ]
    )
