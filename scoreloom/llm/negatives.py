"""Hard negatives by Four-Russians scoring: full exact integer inner products from table lookups.

1. Components become whole numbers, floor(256 * x).  Rows are dealt into blocks by a hash; in a block the components lie as bit
   planes, eight dimensions to a byte (two's complement: the highest plane counts negative).
2. An anchor gets a table for each eight dimensions: the sums of all 256 subsets of its components there, made by doubling.  The
   packed byte of a candidate is the index, so a plane's share of the inner product is one lookup for each eight dimensions, and
   planes combine by shift and add.  Tables are made for some hundred anchors at once, so that a lookup fetches a row of sums.
3. Anchors come in chunks, and every chunk meets every block once: a cartesian product of a few ranges of blocks and many groups
   of chunks, each task reading both from where they lie, so that nothing is written for each pair or sent to the driver.
   A task holds the chunks of its group, one block after the other, and the best few rows of each of its anchors; windows merge
   what the tasks found.
4. The first round looks at rows of the anchor's label (one slice of a block, which is sorted by label), the second at all others,
   below each of the scores that the first one found.

The work is anchors x rows by nature; what is shuffled is rows and anchors once, and some rows of each anchor from each range of
blocks.  No join may be a broadcast: Spark takes a table's file size for its size in memory, and does not see that rows multiply.

Rows with a null label or vector, or with null or non-finite components, take no part.  Vectors of different lengths never meet.
A row that is equal to the anchor in id, label and score with it counts as the anchor itself once; further such rows are others.
A row without an id is no anchor, and comes last among equal scores.  Whole numbers and sums are those of 64 bits: floor
stops at their ends, sums beyond them wrap around.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.session import staged, tasks_for

POSITIVES, NEGATIVES = 5, 5
BLOCK_PARTS = 1 << 17  # components in a block: 2048 vectors of 64 dimensions
CHUNK_PARTS = 1 << 14  # components in a chunk of anchors: their tables take 2 MB in 16 bits, 8 MB in 64
BLOCK_TASKS, CHUNK_TASKS = 16, 512  # ranges of blocks and groups of chunks, at most, that meet
EACH_ANCHOR, EACH_LABEL, LABELS = 100, 7, 10


def taking_part(rows: DataFrame) -> DataFrame:
    """vec_id, label, size and whole components (parts) of the rows that take part, labels changed where the id says so."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    label = F.col("label").cast("long")
    next_label = F.when(label < 0, (label + 1) % LABELS).otherwise((label % LABELS + 1) % LABELS)  # of any long
    moved = F.when(F.col("vec_id") % EACH_LABEL == 0, next_label).otherwise(label)
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), F.size(x).alias("size"),
        F.transform(x, lambda v: F.floor(v * 256.0)).alias("parts"))


def dealt(rows: DataFrame, by: str, groups: int) -> DataFrame:
    return rows.withColumn(by, F.pmod(F.xxhash64("vec_id", "parts"), F.lit(groups)).cast("int"))


def planes_of(parts: np.ndarray) -> np.ndarray:
    """(planes, groups of eight dimensions, rows) bytes of whole numbers in two's complement."""
    low, high = int(parts.min(initial=0)), int(parts.max(initial=0))
    count = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
    packed = [np.packbits(((parts >> k) & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(count)]
    return np.ascontiguousarray(np.stack(packed))


def packed_blocks(rows: DataFrame, groups: int) -> DataFrame:
    """One row per block and vector length: ids and labels, sorted by label and id, and the bit planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in arrow.groups(batches, ["block", "size"]):
            for start, end in arrow.runs(table, ["block", "size"]):
                part = table.slice(start, end - start).combine_chunks()
                size = part.column("size")[0].as_py()
                bits = planes_of(part.column("parts").combine_chunks().flatten().to_numpy().reshape(-1, size)
                                 if size else np.zeros((len(part), 0), np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column("block")[0].as_py()], pa.int32()), pa.array([size], pa.int32()), pa.array([len(bits)], pa.int32()),
                    pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column("label").to_pylist()], pa.list_(pa.int64())), pa.array([bits.tobytes()], pa.binary()),
                ], names=["block", "size", "planes", "ids", "labels", "bits"])

    order = [F.col("block"), F.col("size"), F.col("label"), F.col("vec_id").asc_nulls_last()]
    tasks = min(groups, tasks_for(rows.sparkSession, groups * BLOCK_PARTS // 64))  # fifty blocks a file
    return dealt(rows, "block", groups).repartition(tasks, "block").sortWithinPartitions(*order).mapInArrow(
        run, "block int, size int, planes int, ids array<long>, labels array<long>, bits binary")


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of every subset of each eight components, in the smallest type that holds a plane's sum."""
    count, size = anchors.shape
    groups = -(-size // 8)
    padded = np.zeros((count, groups * 8), np.int64)
    padded[:, :size] = anchors
    largest = int(max(np.abs(padded).astype(object).sum(axis=1), default=0)) if size else 0
    kind = np.int16 if largest < 1 << 15 else np.int32 if largest < 1 << 31 else np.int64
    eight = padded.T.reshape(groups, 8, count).astype(kind)
    sums = np.zeros((groups, 256, count), kind)
    for j in range(8):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + eight[:, j][:, None, :]
    return sums


def inner_products(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(rows, anchors) whole inner products; `bits` are the planes of the rows."""
    planes, groups, rows = bits.shape
    kind = np.int32 if sums.dtype == np.int16 and planes <= 16 else np.int64
    total = np.zeros((rows, sums.shape[2]), kind)
    share, found = (np.empty(total.shape, sums.dtype) for _ in range(2))
    for k in reversed(range(planes)):
        share[:] = 0
        for g in range(groups):
            np.take(sums[g], bits[k, g], axis=0, out=found, mode="clip")
            share += found
        total += total
        if k == planes - 1:
            total -= share
        else:
            total += share
    return total


def best(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, highest first, equal ones in order of place."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.argsort(~scores[at], kind="stable")[:most]]


def leading(rows: list[np.ndarray], most: int) -> list[np.ndarray]:
    """Of (slot, limit, score, itself, unknown, id) the first `most` rows of each slot and limit, in the order of the windows."""
    slot, limit, score, itself, unknown, ids = rows
    order = np.lexsort((ids, unknown, ~itself, ~score, limit, slot))
    change = np.ones(len(order), bool)
    change[1:] = (slot[order][1:] != slot[order][:-1]) | (limit[order][1:] != limit[order][:-1])
    starts = np.flatnonzero(change)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    return [x[order[place < most]] for x in rows]


def meetings(blocks: DataFrame, anchors: DataFrame, chunks: int, find, most: int) -> DataFrame:
    """chunk, slot, id, limit, score, itself: the first `most` rows of each slot and limit that each task found.

    Every chunk of `anchors` meets every block of its vector length; `find` gives slots, places in the block, limits, scores, and
    which rows are the anchor itself.
    """
    fields = ["label", "slot", "vec_id", "parts", *(["limits"] if "limits" in anchors.columns else [])]
    packed = anchors.groupBy("chunk", "size").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("anchors"))
    met = blocks.coalesce(BLOCK_TASKS).join(
        packed.repartition(min(chunks, CHUNK_TASKS)).hint("shuffle_replicate_nl"), "size")  # the left side is read once a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        after: dict[int, int] = {}  # rows from which what is held of a chunk is sorted and cut
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                size, chunk = row.column("size")[0].as_py(), row.column("chunk")[0].as_py()
                ids = row.column("ids").flatten()
                labels = row.column("labels").flatten().to_numpy()
                bits = np.frombuffer(row.column("bits")[0].as_py(), np.uint8).reshape(
                    row.column("planes")[0].as_py(), -1, len(ids)) if size else np.zeros((1, 0, len(ids)), np.uint8)
                own = pa.RecordBatch.from_struct_array(row.column("anchors").flatten())
                parts = own.column("parts").flatten().to_numpy().reshape(len(own), size)
                slots, places, limit, score, itself = find(own, parts, labels, bits, ids)
                if len(slots) == 0:
                    continue
                new = [own.column("slot").to_numpy()[slots], limit, score, itself, ids.is_null().to_numpy(zero_copy_only=False)[places],
                       ids.fill_null(0).to_numpy(zero_copy_only=False)[places]]
                held[chunk] = [np.concatenate(x) for x in zip(held[chunk], new, strict=True)] if chunk in held else new
                if len(held[chunk][0]) >= after.get(chunk, 0):
                    held[chunk] = leading(held[chunk], most)
                    after[chunk] = 2 * len(held[chunk][0])
        for chunk, rows in held.items():
            slot, limit, score, itself, unknown, ids = leading(rows, most)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(slot), chunk, np.int32)), pa.array(slot), pa.array(ids, mask=unknown), pa.array(limit),
                pa.array(score), pa.array(itself)], names=["chunk", "slot", "id", "limit", "score", "itself"])

    return met.mapInArrow(run, "chunk int, slot int, id long, limit long, score long, itself boolean")


def same_label(own: pa.RecordBatch, parts: np.ndarray, labels: np.ndarray, bits: np.ndarray, ids: pa.Array) -> tuple:
    """The best rows of each anchor's label, one more than wanted for the anchor itself."""
    found, place, score, itself = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    wanted = own.column("label").to_numpy()
    names, known = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
    mine, norms = own.column("vec_id").to_numpy(), (parts * parts).sum(axis=1)
    for label in np.unique(wanted):
        low, high = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
        if low == high:
            continue
        at = np.flatnonzero(wanted == label)
        for a, scores in zip(at, np.ascontiguousarray(inner_products(subset_sums(parts[at]), bits[:, :, low:high]).T), strict=True):
            top = best(scores, POSITIVES + 1)
            found.append(np.full(len(top), a))
            place.append(low + top)
            score.append(scores[top].astype(np.int64))
            itself.append((names[low + top] == mine[a]) & known[low + top] & (score[-1] == norms[a]))
    found, place, score, itself = map(np.concatenate, (found, place, score, itself))
    return found, place, np.zeros(len(found), np.int64), score, itself


def other_labels(own: pa.RecordBatch, parts: np.ndarray, labels: np.ndarray, bits: np.ndarray, ids: pa.Array) -> tuple:
    """The best rows of other labels from four fifths of each limit up to it."""
    found, place, limit, score = ([np.zeros(0, np.int64)] for _ in range(4))
    limits = own.column("limits").to_pylist()
    by_id = np.argsort(ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), kind="stable")
    known = labels[by_id]
    for a, (scores, label) in enumerate(zip(
            np.ascontiguousarray(inner_products(subset_sums(parts), bits).T), own.column("label").to_numpy(), strict=True)):
        others = by_id[(known != label) & (scores[by_id] <= limits[a][-1])]
        among = scores[others].astype(np.int64)
        for high in limits[a]:
            inside = np.flatnonzero((among <= high) & (among >= -(-4 * high // 5)))
            top = inside[best(among[inside], NEGATIVES)]
            found.append(np.full(len(top), a))
            place.append(others[top])
            limit.append(np.full(len(top), high))
            score.append(among[top])
    found, place, limit, score = map(np.concatenate, (found, place, limit, score))
    return found, place, limit, score, np.zeros(len(found), bool)


def hard_negatives(rows: DataFrame) -> DataFrame:
    """`rows` (vec_id, embedding, label): anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    part = staged(taking_part(rows), "vectors")
    anchor = F.col("vec_id") % EACH_ANCHOR == 0
    size = part.agg(F.sum(F.col("size") + 1).alias("rows"), F.sum(F.when(anchor, F.col("size") + 1)).alias("anchors")).first()
    groups, chunks = -(-(size.rows or 1) // BLOCK_PARTS), -(-(size.anchors or 1) // CHUNK_PARTS)
    blocks = staged(packed_blocks(part, groups), "blocks")
    number = Window.partitionBy("chunk").orderBy("size", "label", "vec_id", "parts")
    anchors = staged(dealt(part.where(anchor), "chunk", chunks).withColumn("slot", F.row_number().over(number)), "anchors")

    near = meetings(blocks, anchors, chunks, same_label, POSITIVES + 1).withColumnsRenamed(
        {"id": "positive_id", "score": "positive_score"})
    each = Window.partitionBy("chunk", "slot")
    top = near.withColumn("place", F.row_number().over(each.orderBy(
        F.desc("positive_score"), F.desc("itself"), F.col("positive_id").asc_nulls_last()))).where(F.col("place") <= POSITIVES + 1)
    after = top.withColumn("own", F.min(F.when(F.col("itself"), F.col("place"))).over(each)).where(
        F.col("own").isNull() | (F.col("place") != F.col("own")))
    kept = after.where(F.col("place") - F.coalesce((F.col("own") < F.col("place")).cast("int"), F.lit(0)) <= POSITIVES)
    positives = staged(kept.select("chunk", "slot", "positive_id", "positive_score"), "positives")

    limits = positives.groupBy("chunk", "slot").agg(F.sort_array(F.collect_set("positive_score")).alias("limits"))
    far = meetings(blocks, anchors.join(limits.hint("merge"), ["chunk", "slot"]), chunks, other_labels, NEGATIVES).withColumnsRenamed(
        {"id": "negative_id", "limit": "positive_score", "score": "negative_score"})
    within = Window.partitionBy("chunk", "slot", "positive_score").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    negatives = far.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= NEGATIVES)
    names = anchors.select("chunk", "slot", F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives.hint("merge"), ["chunk", "slot", "positive_score"]).join(names.hint("merge"), ["chunk", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
  from r a join r c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""
