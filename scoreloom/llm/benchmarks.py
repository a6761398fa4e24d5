"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

1. Every run of GRAM words of a test item is a seed.  One pass over the documents finds the places where seeds occur, and takes
   the words around them, far enough for the whole item to align.  A copy that keeps GRAM words in a row is found, however often
   those words occur elsewhere.
2. A passage that lacks more words of the item than an alignment of SIMILAR could miss is dropped: only words that match add to a
   score, so no score is lost.
3. The other passages are aligned with the item, word by word: 1 for a match, -0.25 for a word replaced, left out or put in.
   The score is the best local alignment's, divided by the item's words, so 1 is a verbatim copy.

Items shorter than GRAM words are one seed of their own length; items without words match nothing, as do null and empty texts.
Repeated items and documents are rows of their own; a null doc_id or item_id is kept as such.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.llm.words import grams, word_hashes

GRAM = 5
SIMILAR = 0.8
PENALTY = 0.25
#: Test items travel to every task in parts of at most so many bytes of text; more parts mean more passes over the documents.
PART_BYTES = 16 << 20
BATCH_BYTES = 2 << 20
FILTER_BITS = 22
PAIRS = 256  # passages aligned at once

PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum() and not chr(c).isspace())


def plain(texts: list[bytes]) -> list[bytes]:
    """Without ASCII punctuation, so that commas and marks don't hide a copy."""
    return [t.translate(None, PUNCTUATION) for t in texts]


class Seeds:
    """The seeds of some items, for finding them in texts."""

    def __init__(self, items: list[tuple[int, str | None]]):
        flat, counts = word_hashes(plain([(t or "").encode() for _, t in items]))
        ends = np.cumsum(counts)
        self.item = [i for i, _ in items]
        self.words = [flat[e - n:e] for e, n in zip(ends, counts, strict=True)]
        self.tables = {}
        for size in sorted({min(GRAM, n) for n in counts.tolist() if n}):
            value, item = [], []
            for k, words in enumerate(self.words):
                if min(GRAM, len(words)) == size:
                    g = grams(words, size)[:len(words) - size + 1]
                    value.append(g)
                    item.append(np.full(len(g), k))
            value, item = map(np.concatenate, (value, item))
            order = np.argsort(value, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[value >> np.uint64(64 - FILTER_BITS)] = True
            self.tables[size] = (value[order], item[order], bits)

    def places(self, flat: np.ndarray, doc: np.ndarray) -> Iterator[np.ndarray]:
        """(place in the texts, item) of every seed found."""
        for size, (value, item, bits) in self.tables.items():
            g = grams(flat, size)
            whole = np.zeros(len(flat), bool)
            whole[:max(0, len(flat) - size + 1)] = doc[size - 1:] == doc[:max(0, len(flat) - size + 1)]
            at = np.flatnonzero(bits[g >> np.uint64(64 - FILTER_BITS)] & whole)
            low, high = np.searchsorted(value, g[at], "left"), np.searchsorted(value, g[at], "right")
            n = high - low
            which = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.stack([np.repeat(at, n), item[which]])


PASSAGE = "item long, first long, words array<long>, wanted array<long>"


def enough(words: np.ndarray, wanted: np.ndarray) -> bool:
    """Whether so many words of the item are in the passage that a score of SIMILAR is possible."""
    return np.isin(wanted, words).sum() >= SIMILAR * len(wanted) - 1e-9


def passages(documents: DataFrame, seeds: Seeds) -> DataFrame:
    """row, doc_id and the fields of PASSAGE: the words around the seeds of one item that lie close together in one text."""
    shared = documents.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        reach = np.array([len(w) for w in known.words])
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            flat, counts = word_hashes(plain(arrow.utf8(batch.column("text"))))
            doc, ends = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts)
            at, item = np.concatenate([np.zeros((2, 0), np.int64), *known.places(flat, doc)], axis=1).astype(np.int64)
            if not len(at):
                continue
            order = np.lexsort((at, item, doc[at]))
            at, item = at[order], item[order]
            fresh = np.append(True, (doc[at[1:]] != doc[at[:-1]]) | (item[1:] != item[:-1]) | (np.diff(at) > reach[item[1:]]))
            starts = np.flatnonzero(fresh)
            stops = np.append(starts[1:], len(at))
            of, item = doc[at[starts]], item[starts]
            low = np.maximum(at[starts] - 2 * reach[item], (ends - counts)[of])
            high = np.minimum(at[stops - 1] + 2 * reach[item], ends[of])
            some = [k for k in range(len(starts)) if enough(flat[low[k]:high[k]], known.words[item[k]])]
            if not some:
                continue
            of, item, low, high = of[some], item[some], low[some], high[some]
            yield pa.RecordBatch.from_arrays([
                batch.column("row").take(pa.array(of)), batch.column("doc_id").take(pa.array(of)),
                pa.array(item), pa.array(low - (ends - counts)[of]),
                arrow.int_lists([flat[a:b].view(np.int64) for a, b in zip(low, high, strict=True)], pa.int64()),
                arrow.int_lists([known.words[i].view(np.int64) for i in item], pa.int64()),
            ], names=["row", "doc_id", *[f.split()[0] for f in PASSAGE.split(", ")]])

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, f"row long, doc_id {documents.schema['doc_id'].dataType.simpleString()}, {PASSAGE}")


def align(words: list[np.ndarray], wanted: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of word runs with items, and the word behind each one's end."""
    m, n = max(map(len, words)), max(map(len, wanted))
    text, item = np.zeros((len(words), m), np.int64), np.zeros((len(words), n), np.int64)
    inside = np.zeros((len(words), m), bool)
    there = np.zeros((len(words), n), bool)
    for k, (a, b) in enumerate(zip(words, wanted, strict=True)):
        text[k, :len(a)], item[k, :len(b)] = a, b
        inside[k, :len(a)], there[k, :len(b)] = True, True
    row = np.zeros((len(words), n + 1))
    best, end = np.zeros(len(words)), np.zeros(len(words), np.int64)
    slope = PENALTY * np.arange(n + 1)
    for i in range(m):
        same = (text[:, i, None] == item) & there & inside[:, i, None]
        now = np.maximum(row - PENALTY, 0)
        now[:, 1:] = np.maximum(now[:, 1:], row[:, :-1] + np.where(same, 1.0, -PENALTY))
        row = np.maximum.accumulate(now + slope, axis=1) - slope  # words of the item left out
        top = row.max(axis=1)
        end = np.where(top > best, i + 1, end)
        best = np.maximum(best, top)
    return best, end


def scored(found: DataFrame) -> DataFrame:
    """row, doc_id, item, first, score, last_word of every passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAIRS):
                batch = whole.slice(start, PAIRS)
                words = [np.array(x, np.int64) for x in batch.column("words").to_pylist()]
                wanted = [np.array(x, np.int64) for x in batch.column("wanted").to_pylist()]
                order = np.argsort([len(w) for w in words])
                score, end = np.zeros(len(words)), np.zeros(len(words), np.int64)
                for part in np.array_split(order, 8):
                    if len(part):
                        score[part], end[part] = align([words[k] for k in part], [wanted[k] for k in part])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("row", "doc_id", "item")], pa.array(score / np.array([len(w) for w in wanted])),
                     pa.array(batch.column("first").to_numpy() + end)], names=["row", "doc_id", "item", "score", "last_word"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("row", "doc_id", "item", "first", "words", "wanted").mapInArrow(
        run, f"row long, doc_id {kind}, item long, score double, last_word long")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """row, doc_id, item_id, score, last_word: the passages of documents that copy an item with a score of SIMILAR or more.

    One row for each document row and item, its best passage.
    """
    spark = documents.sparkSession
    parts = benchmark.agg(F.ceil(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)) / PART_BYTES).cast("int")).first()[0]
    out = None
    for part in range(parts):
        mine = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).select("item_id", "text")
        items = [(r.item_id, r.text) for r in mine.collect()]  # PART_BYTES or so
        seeds = Seeds(items)
        if not seeds.tables:
            continue
        names = spark.createDataFrame(
            [(k, i) for k, i in enumerate(seeds.item)], f"item long, item_id {benchmark.schema['item_id'].dataType.simpleString()}")
        best = scored(passages(documents, seeds)).where(F.col("score") >= SIMILAR - 1e-9).groupBy("row", "item").agg(
            F.first("doc_id").alias("doc_id"), F.max(F.struct("score", "last_word")).alias("best"))
        result = best.join(names, "item").select("row", "doc_id", "item_id", "best.score", "best.last_word")
        out = result if out is None else out.unionByName(result)
    if out is None:
        return documents.select(F.lit(0).cast("long").alias("row"), "doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
                                F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("last_word")).where(F.lit(False))
    return out
