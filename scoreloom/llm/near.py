"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Every text becomes its set of distinct shingles of `words` words (64-bit hashes), and COORDINATES minimum hashes.  Texts with equal
   sets are one class from here on.
2. Each class is posted under its first POSTED pairs of coordinates: a posting counts two collisions at once, which unrelated sets
   with a common shingle hardly ever have.  Two sets of similarity 0.8 agree on at least LEAST_POSTED of the pairs (but for 1 in
   10^5), so a class may leave out its LEAST_POSTED - 1 longest postings (prefix rule); classes with fewer shared pairs drop out.
3. Every class is first compared with one pivot of each of its postings, the set with most copies: a hot posting costs as
   many comparisons as it has members.  Pairs whose signatures collide on LEAST coordinates join.
4. Postings that still hold several groups are cut into blocks, and a task counts collisions block against block; it passes on
   only pairs that join two groups, so that a hot posting gives no more pairs than members.  All candidate pairs now lie
   within one family.
5. Links are confirmed on the full sets, which travel once for each family and block: 100 * intersection >= 80 * union.  Again
   a task passes on no more links than join its members.

Texts without a word, and nulls, have empty sets, and link with nothing.  Repeated rows are rows of their own with equal results.
A component's id is its least doc_id; a row with a null doc_id and no linked id has none, and is kept.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.llm.blocks import Forest, in_blocks, sides
from scoreloom.llm.graph import components
from scoreloom.llm.substrings import mix
from scoreloom.llm.words import grams, word_hashes
from scoreloom.session import discard, staged

COORDINATES, LEAST = 256, 179  # P(fewer than 179 of 256 agree at similarity 0.8) is about 5 in 10^5
POSTED, LEAST_POSTED = 24, 5  # P(fewer than 5 of 24 pairs agree at similarity 0.8) is about 10^-5
BLOCK = 2048  # members of a posting in a block
BLOCK_SHINGLES = 2_000_000  # shingles of a family in a block
BATCH_BYTES = 1 << 20
_random = np.random.default_rng(20)
SALT = _random.integers(0, 2**64, COORDINATES, np.uint64)
FACTOR = _random.integers(0, 2**64, COORDINATES, np.uint64) | np.uint64(1)
SUMMARY = "n_shingles long, set_id binary, posted array<long>, signature binary"


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of `size` words, sorted; fewer words are one shingle."""
    flat, counts = word_hashes(texts)
    whole = grams(flat, size)
    ends = np.cumsum(counts).tolist()
    return [np.unique(whole[e - n:e - size + 1]) if n >= size else grams(flat[e - n:e], n)[:1] for e, n in zip(ends, counts.tolist(), strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) least hashes; empty sets give all ones."""
    out = np.full((len(sets), COORDINATES), 2**64 - 1, np.uint64)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    flat = np.concatenate([sets[i] for i in filled])
    starts = np.cumsum([0, *[len(sets[i]) for i in filled[:-1]]])
    least = np.empty((COORDINATES, len(filled)), np.uint64)
    for k in range(COORDINATES):
        least[k] = np.minimum.reduceat((flat ^ SALT[k]) * FACTOR[k], starts)
    out[filled] = least.T
    return out


def summaries(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, digest of the text, and the columns of SUMMARY for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            sets = shingle_sets(arrow.utf8(batch.column("text")), words)
            found = signatures(sets)
            first, second = found[:, :2 * POSTED:2], found[:, 1:2 * POSTED:2]
            posted = mix(mix(first + np.arange(POSTED, dtype=np.uint64)) + second).view(np.int64)
            short = ((found >> np.uint64(24)) & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("digest"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * POSTED, pa.int32()), pa.array(posted.ravel())),
                pa.array([s.tobytes() for s in short], pa.binary()),
            ], names=["doc_id", "digest", "n_shingles", "set_id", "posted", "signature"])

    rows = documents.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    return rows.mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, digest long, {SUMMARY}")


def full_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_id, root, shingles) for `wanted` (set_id, root, source: a row's doc_id and digest), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            sets = shingle_sets(arrow.utf8(batch.column("text")), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), batch.column("root"), arrow.int_lists([s.view(np.int64) for s in sets], pa.int64())],
                names=["set_id", "root", "shingles"])

    rows = documents.select("text", "doc_id", F.xxhash64("text").alias("digest"))
    keys = wanted.select("set_id", "root", F.col("source.doc_id").alias("id"), F.col("source.digest").alias("sum"))
    texts = rows.join(keys, [rows.doc_id.eqNullSafe(keys.id), rows.digest == keys.sum]).select("set_id", "root", "text")
    return texts.mapInArrow(run, "set_id binary, root binary, shingles array<long>")


def alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree on LEAST coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, COORDINATES) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= LEAST))

    left = classes.select(F.col("set_id").alias("a"), F.col("signature").alias("x"))
    right = classes.select(F.col("set_id").alias("b"), F.col("signature").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def colliding(part: pa.Table) -> Iterator[tuple[int, int]]:
    """Pairs that collide on LEAST coordinates, as many as it takes to join the groups that they join."""
    sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(len(part), COORDINATES)
    forest = Forest(np.unique(np.array(part.column("root").to_pylist(), object), return_inverse=True)[1])
    left, right = sides(part)
    step = max(1, (16 << 20) // (COORDINATES * len(right)))
    for k in range(0, len(left), step):
        hit = (sig[left[k:k + step]][:, None, :] == sig[right][None]).sum(axis=2) >= LEAST
        for row, found in zip(left[k:k + step].tolist(), hit, strict=True):
            yield from forest.join(row, right[found])


def similar(part: pa.Table) -> Iterator[tuple[int, int]]:
    """Pairs whose full sets are similar, as many as it takes to join the groups that they join.

    The members of a block are listed under each shingle, so that one count over a row's lists gives its intersection with all.
    """
    sets = [np.array(s, np.int64) for s in part.column("shingles").to_pylist()]
    size = np.array([len(s) for s in sets])
    left, right = sides(part)
    flat = np.concatenate([sets[r] for r in right])
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    forest = Forest(np.arange(len(part)))
    for row in left.tolist():
        low, high = np.searchsorted(flat, sets[row], "left"), np.searchsorted(flat, sets[row], "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(right))
        yield from forest.join(row, right[100 * common >= 80 * (size[row] + size[right] - common)])


def links_in_blocks(members: DataFrame, key: str, weight: int | str, most: int, compare: Callable) -> DataFrame:
    """Links (a, b) of classes that `compare` finds among the rows of each `key`."""

    def found(part: pa.Table) -> Iterator[pa.RecordBatch]:
        if pairs := list(compare(part)):
            ids = part.column("set_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(x)) for x in zip(*pairs, strict=True)], names=["a", "b"])

    return in_blocks(members, key, "set_id", weight, most, found, "a binary, b binary")


def near_duplicates(documents: DataFrame, words: int = 2) -> DataFrame:
    """Every row of `documents` (doc_id, text) with n_shingles, component_id and kept.  doc_id may be of any type that sorts."""
    sets = staged(summaries(documents, words), "summaries")
    classes = staged(sets.where("n_shingles > 0").groupBy("set_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.first("posted").alias("posted"),
        F.first("signature").alias("signature"), F.min(F.struct("doc_id", "digest")).alias("source")), "classes")
    postings = classes.select("set_id", "copies", F.posexplode("posted").alias("coordinate", "key"))
    shared = postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("copies", "set_id")).alias("pivot")).where("n > 1")
    prefixes = postings.join(shared, "key").groupBy("set_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "key", "coordinate", F.col("pivot.set_id").alias("pivot")))).alias("found")
    ).where(F.size("found") >= LEAST_POSTED).select("set_id", F.slice("found", 1, F.size("found") - (LEAST_POSTED - 1)).alias("found"))
    prefixes = staged(prefixes, "prefixes")
    stars = prefixes.select(F.col("set_id").alias("a"), F.explode(F.array_distinct("found.pivot")).alias("b")).where("a != b").join(
        prefixes.select(F.col("set_id").alias("b")), "b", "left_semi")
    star_pairs = staged(alike(stars, classes), "pairs")
    near = components(star_pairs)
    rooted = prefixes.join(near.withColumnRenamed("id", "set_id"), "set_id", "left")
    members = rooted.select("set_id", F.coalesce("root", "set_id").alias("root"), F.explode("found.key").alias("key"))
    # signatures travel only with members of postings that still hold several groups
    mixed = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    left_over = members.join(mixed, "key", "left_semi").join(classes.select("set_id", "signature"), "set_id")
    families = components(star_pairs.unionByName(links_in_blocks(left_over, "key", 1, BLOCK, colliding)))
    discard(prefixes, star_pairs)
    related = classes.select("set_id", "source").join(families.withColumnRenamed("id", "set_id"), "set_id")
    found = full_sets(documents, related, words)
    if not sets.groupBy("doc_id", "digest").count().where("count > 1").isEmpty():  # repeated rows
        found = found.dropDuplicates(["set_id"])
    found = found.withColumn("n", F.size("shingles"))
    roots = components(links_in_blocks(found, "root", "n", BLOCK_SHINGLES, similar))
    linked = classes.select("set_id", "least_id").join(roots.withColumnRenamed("id", "set_id"), "set_id")
    lowest = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    grouped = classes.select("set_id", "least_id").join(linked.select("set_id", "root"), "set_id", "left").join(
        lowest, "root", "left").select("set_id", F.coalesce("component_id", "least_id").alias("component_id"))
    result = sets.select("doc_id", "n_shingles", "set_id").join(grouped, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


#: All pairs of sets that share a shingle and have like sizes; two-word shingles.
ORACLE = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), s as (
  select doc_id, case when len(words) < 2 then words
    else list_distinct(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) end as shingles from w
), e as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
links as (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.shingle = b.shingle and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
  select doc_id as id, doc_id as there from documents union select id, b from reach join links on there = a
)
select doc_id, len(shingles) as n_shingles, low as component_id, doc_id = low as kept
from s join (select id, min(there) as low from reach group by id) on id = doc_id
"""
