"""Comparing the members of groups block against block, whatever a group's size."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow


class Forest:
    """Joins the members of a block, and gives the pairs that join two groups."""

    def __init__(self, labels: np.ndarray):
        self.label = labels.copy()

    def join(self, a: int, others: np.ndarray) -> Iterator[tuple[int, int]]:
        groups, first = np.unique(self.label[others], return_index=True)
        for group, k in zip(groups, first, strict=True):
            if group != self.label[a]:
                self.label[self.label == group] = self.label[a]
                yield a, int(others[k])


def sides(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers to compare with each other: a block with itself, or one block with the other."""
    side = part.column("side").to_numpy()
    if (side == side[0]).all():
        every = np.arange(len(part))
        return every, every
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def in_blocks(members: DataFrame, key: str, member: str, weight: int | str, most: int, compare: Callable, schema: str) -> DataFrame:
    """What `compare` gives for the rows of each `key`.

    A group is dealt into as many blocks as `most` weight each takes, by a hash of `member`; every block meets itself and every
    other block once, in a task of its own.  `compare` gets the rows of such a meeting, with `side` 0 or 1 for the two blocks.
    Groups of one row are left out.  Rows come in order of `member`, so that a task that runs again gives the same.
    """
    size = F.sum(F.lit(weight) if isinstance(weight, int) else F.col(weight))
    sizes = members.groupBy(key).agg(F.ceil(size / most).cast("int").alias("blocks"), F.count(F.lit(1)).alias("rows")).where(
        "rows > 1").select(key, "blocks")
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    placed = members.join(sizes, key).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
            "low": F.least("own", "other"), "high": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    keys = [key, "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in arrow.groups(batches, keys):
            for start, end in arrow.runs(table, keys):
                if end - start > 1:
                    yield from compare(table.slice(start, end - start))

    return placed.drop("blocks", "own", "other").repartition(*keys).sortWithinPartitions(
        *keys, member).mapInArrow(run, schema)
