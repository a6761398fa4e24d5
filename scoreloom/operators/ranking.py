"""Exact ranks and percentiles of a whole table without a one-task window.

percent_rank() over an unpartitioned window, and percentile(), bring every row to one task.

Percentiles are found by bracketing: a quantile sketch a little below and above a wanted position
gives two limits, one pass counts the rows below and between them, and so on with the rows between,
until few enough lie there to be sorted.  The sketch decides how fast the brackets close, never the
result: a bracket that misses its position is seen by the counts, and widened.

Ranks come from one range partitioning: a row's place in its sorted partition and the sizes of the
partitions before it.  Values frequent enough to fill partitions are spread by a digest of the row.
"""

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import staged

ACCURACY = 10_000
MARGIN = 2 / ACCURACY  # the sketch errs by 1 / ACCURACY at most
MOST_INSIDE = 200_000  # rows of a bracket that are sorted, copies apart
FREQUENT = 1 / 256  # a value with a larger share of the rows is spread
SPREAD = 997
IN_PARTITION = 33  # bits of monotonically_increasing_id() that number the rows of a partition


@dataclass(frozen=True)
class Bracket:
    """Where the value at a position lies: between two limits (None: open), with the rows below and between them."""

    column: str
    share: float
    rows: int = 0
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0
    nans: int = 0
    margin: float = 0.0

    @property
    def value(self) -> Column:
        return F.col(f"`{self.column}`").cast("double")

    @property
    def places(self) -> tuple[int, int]:
        """The positions to interpolate between, from 0."""
        at = self.share * (self.rows - 1)
        return math.floor(at), math.ceil(at)

    @property
    def holds(self) -> bool:
        return self.below <= self.places[0] and self.places[1] < self.below + self.inside

    @property
    def closed(self) -> bool:
        """Few enough rows, or one value only."""
        return self.inside <= MOST_INSIDE or self.low is not None and self.low == self.high

    def between(self, low: float | None, high: float | None) -> Column:
        """NaN is above all numbers."""
        kept = self.value.isNotNull()
        if low is not None:
            kept = kept & (self.value >= F.lit(low))
        return kept if high is None else kept & (self.value <= F.lit(high))

    def shares_inside(self) -> tuple[float, float]:
        """The wanted positions as shares of the numbers between the limits, with the margin."""
        last = max(self.inside - self.nans - 1, 1)
        low, high = (min(max((p - self.below) / last, 0.0), 1.0) for p in self.places)  # NaN lies beyond 1
        return max(low - self.margin, 0.0), min(high + self.margin, 1.0)


def _count(rows: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """The brackets with their counts, in one pass."""
    counts = []
    for k, b in enumerate(brackets):
        below, inside = F.lit(False) if b.low is None else b.value < F.lit(b.low), b.between(b.low, b.high)
        counts += [F.count(b.value).alias(f"n{k}"), F.count_if(below).alias(f"b{k}"), F.count_if(inside).alias(f"i{k}"),
                   F.count_if(inside & F.isnan(b.value)).alias(f"nan{k}")]
    found = rows.agg(*counts).first()
    return [replace(b, rows=found[f"n{k}"], below=found[f"b{k}"], inside=found[f"i{k}"], nans=found[f"nan{k}"])
            for k, b in enumerate(brackets)]


def _narrowed(rows: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """Brackets with new limits from one sketch of the rows in each; open ends stay open."""
    sketches = []
    for k, b in enumerate(brackets):
        inside = F.when(b.between(b.low, b.high) & ~F.isnan(b.value), b.value)
        sketches.append(F.percentile_approx(inside, list(b.shares_inside()), ACCURACY).alias(f"s{k}"))
    found = rows.agg(*sketches).first()
    out = []
    for k, b in enumerate(brackets):
        (low_share, high_share), limits = b.shares_inside(), found[f"s{k}"]
        low = b.low if limits is None or low_share == 0.0 else limits[0]
        high = b.high if limits is None or high_share == 1.0 else limits[1]
        out.append(replace(b, low=low, high=high))
    return out


def _close(rows: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """Brackets that hold their positions, closed as far as the sketch can."""
    brackets = _count(rows, brackets)
    stuck: set[int] = set()
    while ahead := [k for k, b in enumerate(brackets) if not b.closed and k not in stuck]:
        tried = _count(rows, _narrowed(rows, [brackets[k] for k in ahead]))
        for k, new in zip(ahead, tried):
            old = brackets[k]
            if not new.holds and old.margin < 1:  # missed: wider limits around the same position
                brackets[k] = replace(old, margin=old.margin * 8)
            elif new.holds and new.inside < old.inside:
                brackets[k] = replace(new, margin=MARGIN)
            else:  # few values with very many copies
                stuck.add(k)
    return brackets


def percentile_values(rows: DataFrame, columns: list[str], at: dict[str, float]) -> dict[str, float | None]:
    """The interpolated percentiles `<name>_<column>`; NULLs are ignored, NaN is the largest value.

    Runs jobs: two passes of aggregates over `rows` for each narrowing (none for small tables, one or
    two for large ones), and one pass that sorts the few values left.  `rows` should be a table or
    written first.
    """
    names = [(name, c) for c in columns for name in at]
    brackets = _close(rows, [Bracket(c, at[name], margin=MARGIN) for name, c in names])
    cells = [
        F.when(b.between(b.low, b.high), F.struct(F.lit(k).alias("bracket"), b.value.alias("value")))
        for k, b in enumerate(brackets)
    ]
    inside = reduce(lambda a, b: a | b, [b.between(b.low, b.high) for b in brackets])
    # one row per value and task is shuffled
    values = rows.where(inside).select(F.explode(F.array_compact(F.array(*cells))).alias("m")).select("m.*").groupBy("bracket", "value").agg(
        F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy("bracket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.withColumn("end", F.sum("copies").over(upto))
    wanted = F.lit(False)
    for k, b in enumerate(brackets):
        for place in b.places:
            position = place - b.below
            here = (F.col("end") > position) & (F.col("end") - F.col("copies") <= position)
            wanted = wanted | (F.col("bracket") == k) & here
    found: dict[int, list] = {}
    for bracket, value, copies, end in placed.where(wanted).collect():  # two rows a percentile at most
        found.setdefault(bracket, []).append((end, value))
    out = {}
    for k, ((name, c), b) in enumerate(zip(names, brackets)):
        values_here = [value for _, value in sorted(found.get(k, []))]
        if not values_here:
            out[f"{name}_{c}"] = None
            continue
        low, high = values_here[0], values_here[-1]
        part = b.share * (b.rows - 1) - b.places[0]
        out[f"{name}_{c}"] = low if low == high or len(values_here) == 1 else low + (high - low) * part
    return out


def exact_percentiles(rows: DataFrame, columns: list[str], at: dict[str, float]) -> DataFrame:
    """`percentile_values` as one row."""
    found = percentile_values(rows, columns, at)
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in found])
    return rows.sparkSession.createDataFrame([tuple(found.values())], schema)


def _key(rows: DataFrame, value: str) -> Column:
    """The column to order by; -0.0 becomes 0.0."""
    kind = rows.schema[value].dataType
    return F.col(value) + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(value)


def percent_rank(rows: DataFrame, value: str, name: str) -> DataFrame:
    """percent_rank() over the whole table ordered by `value`, NULLs first, NaN last, as column `name`.

    The rows are shuffled by ranges of the value, which gives their places, then by the value, which
    gives equal values one place (Spark takes no range of doubles for a grouping of them), and are
    written to the shared folder; as many partitions as the session shuffles to, whatever the size.
    """
    key = _key(rows, value)
    ordinary = key if not isinstance(rows.schema[value].dataType, (T.DoubleType, T.FloatType)) else F.when(~F.isnan(key), key)
    cuts = rows.agg(F.percentile_approx(ordinary, [k * FREQUENT / 2 for k in range(int(2 / FREQUENT) + 1)], ACCURACY)).first()[0] or []
    frequent = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})  # 256 at most
    hashable = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.col("_key").isNull() | F.col("_key").isin(frequent)
    if isinstance(rows.schema[value].dataType, (T.DoubleType, T.FloatType)):
        spread = spread | F.isnan("_key")
    salt = F.when(spread, F.pmod(F.xxhash64(*hashable), F.lit(SPREAD)) + 1).otherwise(0).cast("int")
    laid = rows.withColumn("_key", key).withColumn("_salt", salt).repartitionByRange("_key", "_salt").sortWithinPartitions("_key", "_salt")
    run = Window.partitionBy("_key", "_salt")
    placed = laid.withColumn("_id", F.monotonically_increasing_id()).withColumn("_first", F.min("_id").over(run))
    part = F.shiftright("_first", IN_PARTITION).cast("int")
    placed = staged(placed.select(
        *rows.columns, "_key", "_salt", part.alias("_part"), (F.col("_first") - F.shiftleft(part.cast("long"), IN_PARTITION)).alias("_place")), "ranks")

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")).withColumns({
        "_before": F.coalesce(F.sum("_size").over(before), F.lit(0)), "_total": F.sum("_size").over(Window.partitionBy())}).drop("_size")
    ranked = placed.join(F.broadcast(sizes), "_part").withColumn("_rank", F.col("_before") + F.col("_place"))
    # of a value that is spread the first run counts; one row a frequent value
    firsts = ranked.where("_salt > 0").groupBy("_key").agg(F.min("_rank").alias("_least")).withColumnRenamed("_key", "_value")
    ranked = ranked.join(F.broadcast(firsts), (F.col("_salt") > 0) & F.col("_key").eqNullSafe(F.col("_value")), "left")
    share = F.coalesce("_least", "_rank") / F.greatest(F.col("_total") - 1, F.lit(1))
    return ranked.select(*rows.columns, share.alias(name))
