"""Incremental refresh: file streams that run until the input is used up, then stop."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.keyed import first_per_key, without
from scoreloom.session import staged
from scoreloom.sources.writers import KeyedTable, conform


def new_files(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
              files_per_batch: int | None = None) -> DataFrame:
    """Parquet files a checkpointed stream has not read yet."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a Parquet table, exactly once, until the input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_batches(stream: DataFrame, handle: Callable[[DataFrame], None], checkpoint: str) -> None:
    """Hand each new batch to `handle`, which must be repeatable (a keyed merge is)."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_stream(
    stream: DataFrame, table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Merge each batch into a keyed table; a batch that runs twice gives the same table."""
    run_batches(stream, lambda batch: table.upsert(prepare(batch)), checkpoint)


def append_unseen(
    stream: DataFrame, table: KeyedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Process only keys the table does not have yet; no stored file is rewritten.

    A batch that runs twice finds its keys in the table the second time.
    """

    def handle(batch: DataFrame) -> None:
        batch = staged(batch, "batch")
        fresh = without(batch, table.rows_near(batch), table.keys, uneven=True)
        table.append(prepare(fresh))

    run_batches(stream, handle, checkpoint)


def refresh(table: KeyedTable, build: Callable[[DataFrame | None], DataFrame], full: bool = False) -> None:
    """Merge what `build` derives from the current table, or rebuild it from nothing."""
    if full:
        table.write(build(None))
    else:
        table.upsert(build(table.read()))


def lookback_stream(
    stream: DataFrame, table: KeyedTable, checkpoint: str, event_time: str, lookback: str, newest: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Merge records that may be delivered again, or in a better version, within `lookback` of the newest.

    A record that arrives twice unchanged within the lookback (equal keys, `event_time` and `newest`) is left out by the
    stream's state, which holds no more than the lookback.  Records that lie further back are not read again.  What `prepare`
    makes of the rest of a batch competes with the stored rows of its keys, best by `newest` in descending order, so an older
    version that arrives late replaces nothing.  `event_time` is an instant.
    """
    delivered = stream.withWatermark(event_time, lookback).dropDuplicatesWithinWatermark([*table.keys, event_time, *newest])

    def handle(batch: DataFrame) -> None:
        batch = staged(conform(prepare(batch), table.schema), "batch")
        stored = table.rows_near(batch).join(batch.select(*table.keys).distinct(), table.keys, "left_semi")
        best = first_per_key(stored.unionByName(batch), table.keys, [F.col(c).desc() for c in newest])
        table.upsert(best)

    run_batches(delivered, handle, checkpoint)
