"""Near-duplicate vectors by cross-polytope hashing.

1. Vectors that are equal in label and components are one class.
2. Each of TABLES tables hashes a class PARTS times: three rounds of random signs and a fast Hadamard transform, then the place
   and sign of the largest component.  Besides its own bucket a class is posted in those where one part takes its second
   largest component (multiprobe).
3. Members of a bucket are compared block against block by cosine in double precision.  A pair counts in the first bucket
   that both are posted in, so every pair counts once; a task passes on link counts by class, and as many links as join
   its members.

Null or zero vectors, and those with null or non-finite components, link with nothing, as do vectors without a label.
Vectors of different lengths never link.  Rows that repeat a vec_id are rows of their own.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.blocks import Forest, in_blocks, sides
from scoreloom.llm.graph import components
from scoreloom.session import staged

SIMILAR = 0.98
TABLES, PARTS = 8, 2
POSTS = TABLES * (PARTS + 1)
BLOCK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, width)
        step *= 2
    return x


def buckets(vectors: np.ndarray) -> np.ndarray:
    """(rows, POSTS) codes of the buckets that unit vectors are posted in, ascending over the tables."""
    n, size = vectors.shape
    width = 1 << max(1, (size - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :size] = vectors
    signs = np.random.default_rng(width).choice([-1.0, 1.0], (TABLES, PARTS, 3, width))
    out = np.empty((n, TABLES, PARTS + 1), np.int64)
    for t in range(TABLES):
        best, second = [], []
        for k in range(PARTS):
            y = padded
            for r in range(3):
                y = hadamard(y * signs[t, k, r])
            top = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            value = np.take_along_axis(y, top, axis=1)
            order = np.argsort(-np.abs(value), axis=1, kind="stable")
            code = np.take_along_axis(2 * top + (value < 0), order, axis=1)
            best.append(code[:, 0])
            second.append(code[:, 1])
        for probe in range(PARTS + 1):
            total = np.full(n, t, np.int64)
            for k in range(PARTS):
                total = total * (2 * width) + (second[k] if k == probe - 1 else best[k])
            out[:, t, probe] = total
    return out.reshape(n, POSTS)


def usable(vector: list | None) -> bool:
    if not vector or any(x is None for x in vector):
        return False
    norm = np.linalg.norm(np.array(vector, np.float64))
    return bool(np.isfinite(norm) and norm > 0)


def classes_of(rows: DataFrame) -> DataFrame:
    """vec_id, label, and class: a digest of label and components, null for vectors that link with nothing; vector as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = [], []
            for vector, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
                ok = label is not None and usable(vector)
                data = np.array(vector, np.float64).tobytes() if ok else None
                raw.append(data)
                ids.append(hashlib.blake2b(data, digest_size=16, key=str(label).encode()[:64]).digest() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(ids, pa.binary()), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "class", "vector"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label")]
    return rows.select("vec_id", "label", "embedding").mapInArrow(run, f"{', '.join(kinds)}, class binary, vector binary")


def posted(classes: DataFrame) -> DataFrame:
    """The classes with codes: the buckets each is posted in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            sizes = np.array([len(x) for x in raw])
            codes = np.zeros((len(raw), POSTS), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(raw[r] for r in rows), np.float64).reshape(len(rows), -1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                codes[rows] = buckets(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * POSTS, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "codes"])

    return classes.mapInArrow(run, classes.withColumn("codes", F.array().cast("array<long>")).schema)


def compare(part: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links counted in one bucket: rows (a, null, links) and joining links (a, b, 0)."""
    x = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float64).reshape(len(part), -1)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    codes = np.array(part.column("codes").to_pylist())
    copies = part.column("copies").to_numpy()
    code = part.column("code")[0].as_py()
    left, right = sides(part)
    links = np.zeros(len(part), np.int64)
    forest, joins = Forest(np.arange(len(part))), []
    for k in range(0, len(left), 512):
        rows = left[k:k + 512]
        i, j = np.nonzero(x[rows] @ x[right].T >= SIMILAR)
        i, j = rows[i], right[j]
        i, j = (i[i < j], j[i < j]) if left is right else (i, j)
        mine = np.ones(len(i), bool)
        for at in range(0, len(i), 4096):  # the first bucket that both are posted in, in ascending order of codes
            a, b = codes[i[at:at + 4096]], codes[j[at:at + 4096]]
            common = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.iinfo(np.int64).max)
            mine[at:at + 4096] = common.min(axis=1) == code
        i, j = i[mine], j[mine]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        for row in np.unique(i):
            joins += forest.join(int(row), j[i == row])
    ids = part.column("class").combine_chunks()
    counted = np.flatnonzero(links)
    a = ids.take(pa.array(np.concatenate([counted, np.array([p[0] for p in joins], np.int64)])))
    b = pa.concat_arrays([pa.nulls(len(counted), pa.binary()), ids.take(pa.array([p[1] for p in joins], pa.int64()))])
    if len(a):
        yield pa.RecordBatch.from_arrays([a, b, pa.array(np.append(links[counted], np.zeros(len(joins), np.int64)))], names=["a", "b", "links"])


def near_vectors(rows: DataFrame) -> DataFrame:
    """Every row of `rows` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    summary = staged(classes_of(rows), "vectors")
    classes = summary.where("class is not null").groupBy("class").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector"))
    classes = staged(posted(classes), "vector-classes")
    posts = classes.select("class", "copies", "vector", "codes", "label", F.explode(F.array_distinct("codes")).alias("code"))
    members = posts.withColumn("bucket", F.struct("label", F.length("vector").alias("size"), "code")).drop("label")
    found = staged(in_blocks(members, "bucket", "class", 1, BLOCK, compare, "a binary, b binary, links long"), "vector-links")
    links = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "class")
    linked = classes.select("class", "copies", "least_id").join(links, "class", "left").join(roots, "class", "left").withColumn(
        "root", F.coalesce("root", "class"))
    lowest = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = linked.join(lowest, "root").select("class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    result = summary.select("vec_id", "class").join(by_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


#: All pairs of a label.
ORACLE = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))) and list_max(list_transform(embedding, lambda x: abs(x))) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach as (
  select vec_id as id, vec_id as there from embeddings union select id, b from reach join links on there = a
)
select vec_id, coalesce(n, 0) as n_links, low as component_id, vec_id = low as kept
from embeddings join (select id, min(there) as low from reach group by id) on id = vec_id
left join (select a, count(*) as n from links group by a) on a = vec_id
"""
