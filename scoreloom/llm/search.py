"""Ranked lexical search with geometric blocks of posting lists.

1. One pass over the texts counts terms; of each document stay its length and the counts of terms that some item has.  Document
   counts of these terms, and lengths, are summed by Spark over all documents.
2. A document becomes a vector of impacts, what each term adds to a score.  Vectors are dealt by ranges of their leading terms (the
   three of most impact, then a hash), so that similar documents lie together and copies may still be parted.
3. A task takes its documents in chunks.  In a chunk the documents are clustered around leaders by inner product; every term's
   posting list is cut along the clusters into blocks, and a block's summary is the coordinatewise maximum of its documents' vectors.
4. For an item, the blocks of its terms' lists are visited from the highest bound down.  A block's bound is the sum of its summary
   over the item's terms, in whole numbers, so no document in it scores more; a block is skipped only if its bound lies
   below the tenth score found so far.  Documents of the other blocks are scored in full.  Scores found go on from chunk to chunk.
5. Every task gives the ten best documents of each item, and a window merges them.

Summaries live as long as their chunk: written out they would take many times the room of the vectors.  Items are taken in parts of
bounded size, each a pass over the documents; within a part, groups of items with a bounded vocabulary share an index.

Null texts, and texts without a term, have no score and do not count; items without a term have no result.  Repeated rows are
documents or items of their own.  Of equal scores the least doc_id is first, null ids come last.  Terms are compared as whole bytes.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.session import staged

BEST = 10
PART_BYTES = 16 << 20  # terms of the items of one part
GROUP_TERMS = 2048  # distinct terms of the items that share an index; one item may have more
CHUNK_DOCUMENTS, CHUNK_POSTINGS = 512, 32_768
CELLS = 8 << 20  # of the summaries of a chunk
BLOCK, LEADER = 16, 16
TOGETHER = 4  # blocks visited between two looks at the tenth score
BATCH_BYTES, PIECE = 1 << 20, 1 << 20

NO_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
FOLD = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c
             for c in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term; a long text is split piece by piece."""
    flat, counts, at = text.translate(FOLD), Counter(), 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE)
        end = len(flat) if end < 0 else end
        counts.update(flat[at:end].split())
        at = end
    return counts


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and distinct terms of every item."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select("item_id", F.array_distinct(F.regexp_extract_all(
        F.coalesce(lower, F.lit("")), F.lit(f"([^{NO_TERM}]+)"), F.lit(1))).alias("terms"))


def in_parts(items: DataFrame) -> Iterator[list[Row]]:
    """The items in parts of about PART_BYTES."""
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t))
    parts = -(-(items.agg(F.sum(size)).first()[0] or 0) // PART_BYTES)
    for part in range(parts):
        yield items.where((F.pmod(F.xxhash64("item_id", "terms"), F.lit(parts)) == part) & (F.size("terms") > 0)).collect()


def term_vectors(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), and the terms (by number) of `vocabulary` with their counts."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            lengths, terms, times = [], [], []
            for text in arrow.utf8(batch.column("text")):
                counts = term_counts(text)
                lengths.append(counts.total())
                found = sorted((known[t], n) for t, n in counts.items() if t in known)
                terms.append(np.array([t for t, _ in found], np.int32))
                times.append(np.array([n for _, n in found], np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(lengths, pa.int64()), arrow.int_lists(terms, pa.int32()), arrow.int_lists(times, pa.int64())
            ], names=["doc_id", "n", "terms", "times"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out = staged(documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<long>"), "terms")
    shared.destroy()
    return out


def impacts(vectors: DataFrame, size: int) -> DataFrame:
    """doc_id, terms, impacts and leading terms of the documents that hold a term of the vocabulary (`size` terms)."""
    total = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # as many rows as terms at most
    weight = np.zeros(size, np.int64)
    for term, count in held:
        weight[term] = math.floor(1000 * math.log((2 * total.documents + 2) / (2 * count + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column("terms").offsets.to_numpy()
            terms, times = (batch.column(c).flatten().to_numpy() for c in ("terms", "times"))
            n = batch.column("n").to_numpy()
            share = 10 + 90 * n * total.documents // max(total.terms or 0, 1)
            value = weight[terms] * (1_000_000_000 * times // (1000 * times + 8 * np.repeat(share, np.diff(ends))))
            leads = []
            for start, end in zip(ends[:-1] - ends[0], ends[1:] - ends[0], strict=True):
                leads.append(terms[start:end][np.argsort(-value[start:end], kind="stable")[:3]])
            lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("terms"), lists, arrow.int_lists(leads, pa.int32())],
                                             names=["doc_id", "terms", "impacts", "leads"])

    kind = vectors.schema["doc_id"].dataType.simpleString()
    return vectors.where(F.size("terms") > 0).mapInArrow(run, f"doc_id {kind}, terms array<int>, impacts array<long>, leads array<int>")


class Top:
    """The best documents of an item so far."""

    def __init__(self):
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.least = 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        fit = scores >= self.least
        scores, ids, nulls = (np.append(x, y[fit]) for x, y in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        order = np.lexsort((ids, nulls, -scores))[:BEST]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]
        if len(order) == BEST:
            self.least = int(self.scores[-1])


def clusters(values: np.ndarray) -> np.ndarray:
    """The rows in order of their nearest leader, by inner product; every LEADER-th row is one."""
    leaders = values[::LEADER].astype(np.float32)
    leaders /= np.maximum(np.linalg.norm(leaders, axis=1, keepdims=True), 1)
    return np.argsort(np.argmax(values.astype(np.float32) @ leaders.T, axis=1), kind="stable")


class Index:
    """The posting lists of a chunk in blocks; `rows` and `columns` name the cells of the impacts `value`."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, value: np.ndarray, count: int, width: int):
        self.values = np.zeros((count, width), np.int64)
        self.values[rows, columns] = value
        self.highest = self.values.max(axis=0)
        rank = np.empty(count, np.int64)
        rank[clusters(self.values)] = np.arange(count)
        order = np.lexsort((rank[rows], columns))
        self.members, lists = rows[order], columns[order]
        sizes = np.bincount(lists, minlength=width)
        blocks = -(-sizes // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])  # of each list's blocks
        place = np.arange(len(lists)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        block = self.first[lists] + place // BLOCK
        self.start = np.append(np.flatnonzero(place % BLOCK == 0), len(lists))  # of each block's members
        self.summary = np.zeros((self.first[-1], width), np.int64)
        own = np.argsort(self.members, kind="stable")
        bounds = np.searchsorted(self.members[own], np.arange(count + 1))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            cells = np.ix_(block[own[low:high]], lists[own[low:high]])
            self.summary[cells] = np.maximum(self.summary[cells], self.values[self.members[own[low]]][cells[1]] if high > low else 0)

    def search(self, wanted: np.ndarray, top: Top, ids: np.ndarray, nulls: np.ndarray) -> None:
        if self.highest[wanted].sum() < top.least:
            return
        counts = self.first[wanted + 1] - self.first[wanted]
        blocks = np.repeat(self.first[wanted] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        bounds = self.summary[blocks[:, None], wanted].sum(axis=1)
        order = np.argsort(-bounds, kind="stable")
        order = order[:np.searchsorted(-bounds[order], -top.least, "right")]
        seen = np.zeros(len(self.values), bool)
        for k in range(0, len(order), TOGETHER):
            if bounds[order[k]] < top.least:
                return
            fresh = np.zeros(len(self.values), bool)
            for b in blocks[order[k:k + TOGETHER]]:
                fresh[self.members[self.start[b]:self.start[b + 1]]] = True
            rows = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            top.add(self.values[rows[:, None], wanted].sum(axis=1), ids[rows], nulls[rows])


class Group:
    """Items that share an index: their terms, numbered anew."""

    def __init__(self, items: list[tuple[int, np.ndarray]], size: int):
        self.terms = np.unique(np.concatenate([t for _, t in items]))
        self.column = np.full(size, -1, np.int64)
        self.column[self.terms] = np.arange(len(self.terms))
        self.items = items

    def search(self, ends: np.ndarray, terms: np.ndarray, value: np.ndarray, tops: list[Top], ids: np.ndarray, nulls: np.ndarray) -> None:
        """The chunk's documents lie between `ends` of `terms` and `value`."""
        column = self.column[terms]
        inside = np.flatnonzero(column >= 0)
        rows = (np.searchsorted(ends, inside, "right") - 1)
        documents, rows = np.unique(rows, return_inverse=True)
        if not len(documents):
            return
        present, columns = np.unique(column[inside], return_inverse=True)
        blocks = int((-(-np.bincount(columns) // BLOCK)).sum())
        if blocks * len(present) > CELLS and len(documents) > 1:  # too large an index: two of half the documents
            half = documents[len(documents) // 2]
            for part in (slice(0, half), slice(half, len(ids))):
                low, high = ends[part.start], ends[part.stop]
                self.search(ends[part.start:part.stop + 1] - low, terms[low:high], value[low:high], tops, ids[part], nulls[part])
            return
        here = np.full(len(self.terms), -1, np.int64)
        here[present] = np.arange(len(present))
        ids, nulls = ids[documents], nulls[documents]
        if len(documents) == 1:  # every block is this document
            for item, wanted in self.items:
                at = here[self.column[wanted]]
                tops[item].add(np.array([value[inside][at[at >= 0]].sum()]), ids, nulls)
            return
        index = Index(rows, columns, value[inside], len(documents), len(present))
        for item, wanted in self.items:
            at = here[self.column[wanted]]
            index.search(at[at >= 0], tops[item], ids, nulls)


def grouped(items: list[np.ndarray], size: int) -> list[Group]:
    """The items, each a list of term numbers, in groups of GROUP_TERMS terms or one item."""
    groups, held, terms = [], [], set()
    for k, wanted in enumerate(items):
        if held and len(terms.union(wanted.tolist())) > GROUP_TERMS:
            groups.append(Group(held, size))
            held, terms = [], set()
        held.append((k, wanted))
        terms.update(wanted.tolist())
    return groups + ([Group(held, size)] if held else [])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ends, terms, impacts, ids and null marks of some documents at a time."""
    for batch in batches:
        ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        terms, value = (batch.column(c).flatten().to_numpy() for c in ("terms", "impacts"))
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        low = 0
        while low < len(ids):
            high = min(low + CHUNK_DOCUMENTS, max(low + 1, int(np.searchsorted(ends, ends[low] + CHUNK_POSTINGS, "right")) - 1))
            part = slice(ends[low], ends[high])
            yield ends[low:high + 1] - ends[low], terms[part], value[part], ids[low:high], nulls[low:high]
            low = high


def best_documents(vectors: DataFrame, items: list[Row], number: dict[str, int]) -> DataFrame:
    """item (its place), item_id, doc_id and score: the best documents of each task."""
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(([i.item_id for i in items], [np.array(sorted(number[t] for t in i.terms), np.int64) for i in items], len(number)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted, size = shared.value
        groups = grouped(wanted, size)
        tops = [Top() for _ in names]
        for ends, terms, value, ids, nulls in chunks(batches):
            for group in groups:
                group.search(ends, terms, value, tops, ids, nulls)
        for start in range(0, len(tops), 4096):
            some = tops[start:start + 4096]
            counts = [len(t.ids) for t in some]
            if sum(counts):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(start, start + len(some), dtype=np.int32), counts)),
                    pa.array([names[start + k] for k, n in enumerate(counts) for _ in range(n)], pa.int64()),
                    pa.array(np.concatenate([t.ids for t in some]), mask=np.concatenate([t.nulls for t in some])),
                    pa.array(np.concatenate([t.scores for t in some])),
                ], names=["item", "item_id", "doc_id", "score"])

    laid = vectors.repartitionByRange("leads", F.xxhash64("doc_id", "impacts")).sortWithinPartitions("leads")
    return laid.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score of the best documents (doc_id, text) for every item (item_id, text)."""
    found = None
    for part in in_parts(item_terms(items)):
        number = {t: k for k, t in enumerate(sorted({t for i in part for t in i.terms}))}
        vectors = impacts(term_vectors(documents, list(number)), len(number))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best_documents(vectors, part, number).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
        best = best.select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), size as (select count(*) as docs, sum(len(terms))::bigint as total from d where len(terms) > 0),
t as (
  select doc_id, term, count(*) as tf from (select doc_id, unnest(terms) as term from d) group by all
), w as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from t, size group by term, docs
), m as (select doc_id, 10 + (90 * len(terms) * docs) // total as m from d, size where len(terms) > 0),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), s as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from q join t using (term) join w using (term) join m using (doc_id) group by item_id, doc_id
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from s where score > 0 qualify rank <= 10
"""
