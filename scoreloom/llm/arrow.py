"""Small helpers for operators that run numpy code on Arrow batches."""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands at most 1000 rows to Python at once: with whole texts 10,000 rows, the default, take
    many MB in the JVM's buffers and in each worker.  For jobs that run many such steps in one session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that `column` (text or binary) holds about `most` bytes in each; a longer row stays whole."""
    for batch in batches:
        values = batch.column(column)
        if batch.num_rows == 0:
            continue
        sizes = lengths(values)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each value; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def texts(values: pa.Array) -> list[str]:
    return [x or "" for x in values.to_pylist()]


def utf8(values: pa.Array) -> list[bytes]:
    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]


def int_lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per array."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def with_columns(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    """`batch` with columns added; columns of these names that it already has are replaced."""
    keep = [i for i, n in enumerate(batch.schema.names) if n not in names]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in keep] + arrays, names=[batch.schema.names[i] for i in keep] + names)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted input, also where a run spans batches; small runs come together in one table.

    Every table holds whole runs only, so that callers may split it by key themselves.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            if held:
                change[0] |= held[-1].column(k)[held[-1].num_rows - 1].as_py() != batch.column(k)[0].as_py()
        cuts = np.flatnonzero(change)
        if len(cuts) == 0:
            held.append(batch)
            continue
        head, last = batch.slice(0, cuts[-1]), batch.slice(cuts[-1])
        ready = held + ([head] if head.num_rows else [])
        if ready:
            yield pa.Table.from_batches(ready)
        held = [last]
    if held:
        yield pa.Table.from_batches(held)


def runs(table: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    change = np.zeros(table.num_rows, bool)
    if table.num_rows == 0:
        return []
    change[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(change).tolist()
    return list(itertools.pairwise([*starts, table.num_rows]))
