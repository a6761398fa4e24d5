"""Removal of passages that occur more than once, by a distributed merge sort of suffixes.

A byte goes if a string of WIDTH bytes that covers it starts at two places or more.  Not every suffix needs sorting:

1. Each window of WIDTH bytes is named after the least k-mer hash in it (leftmost on ties).  Equal windows have equal k-mers at
   equal offsets, and neighbours mostly share theirs, so a text falls into ranges of windows, about one for each 75 bytes.
2. Ranges whose k-mer occurs once hold no repeated window.  Ranges with the same bytes elsewhere are repeated whole.
3. What is left (of equal ranges one) is cut into parts of PART windows at fixed offsets from the k-mer.  Parts are told
   apart in the same way: by the bytes that all their windows share, and by all their bytes.
4. The windows of parts that are still undecided are sorted as suffixes: every task sorts its own into runs, writes them front-coded
   (shared prefix length and rest), and sends each slice of a run to the task of its key range.  There a loser tree merges the
   runs without comparing known prefixes again; strings that share all WIDTH bytes with their neighbour are repeated.

Steps 2 and 3 compare 64-bit hashes.  Counts are combined before each exchange, so a passage that a third of the texts hold is one
row a task.  Texts shorter than WIDTH bytes and nulls (empty) keep everything.  Rows that are equal in doc_id and text are copies of
each other.  Matches never cross texts.
"""

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.llm.loser import front_code, merge
from scoreloom.llm.substrings import ROOT, Hasher, mix
from scoreloom.session import staged as written

WIDTH = 200
KMER = 32
PART = 16
BATCH_BYTES = 1 << 20
PACKED_BYTES = 1 << 18  # of compressed texts
RUN_STRINGS = 20_000  # strings in a sorted run
SLICE_STRINGS = 40_000  # strings that one merging task gets, about
SAMPLED = 20_000  # strings that are looked at for choosing key ranges, at most
PREFIX = 48  # bytes of a string that decide its key range


def lowest(values: np.ndarray, window: int) -> np.ndarray:
    """The least value among each `window` consecutive ones."""
    n = len(values) - window + 1
    blocks = -(-len(values) // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    table = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1:window - 1 + n])


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes `df`, and lets Spark drop the shuffle files of the finished step, which otherwise stay until the driver collects garbage."""
    out = written(df, label)
    gc.collect()
    if (jvm := getattr(df.sparkSession, "_jvm", None)) is not None:  # not on a Connect session
        jvm.System.gc()
    return out


def packed(rows: DataFrame) -> DataFrame:
    """doc_id, digest and the compressed text of `rows`: what the joins move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            texts = pa.array([press.compress(t) for t in arrow.utf8(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), texts], names=["doc_id", "digest", "text"])

    return rows.mapInArrow(run, f"{key_fields(rows)}, text binary")


def unpacked(values: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(t) for t in values.to_pylist()]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes end to end, and where each text starts and ends."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends - np.array([len(t) for t in texts], np.int64), ends


RANGE = "at int, low int, high int, kmer long, context long"


def ranges(rows: DataFrame) -> DataFrame:
    """The ranges of windows of every text (doc_id, digest, text): place of the k-mer, first and last window, hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            data, starts, ends = laid_out(arrow.utf8(batch.column("text")))
            if len(data) < WIDTH:
                continue
            doc = np.repeat(np.arange(len(ends)), ends - starts)
            hashes = Hasher(data)
            place = np.arange(len(data) - KMER + 1)
            kmers = hashes(place, place + KMER)
            low_bits = np.uint64((1 << 24) - 1) if len(data) < 1 << 24 else np.uint64((1 << 32) - 1)
            least = lowest(kmers & ~low_bits | place.astype(np.uint64), WIDTH - KMER + 1)
            at = (least & low_bits).astype(np.int64)
            window = np.flatnonzero(np.arange(len(at)) + WIDTH <= ends[doc[:len(at)]])
            at = at[window]
            if not len(at):
                continue
            fresh = np.append(True, (at[1:] != at[:-1]) | (np.diff(window) != 1))
            first = np.flatnonzero(fresh)
            low, high, at = window[first], window[np.append(first[1:], len(at)) - 1], at[first]
            context = mix(hashes(low, high + WIDTH) + (at - low).astype(np.uint64) * np.uint64(ROOT))
            of = doc[low]
            begin = starts[of]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(of)) for c in ("doc_id", "digest")], *[pa.array((x - begin).astype(np.int32)) for x in (at, low, high)],
                 pa.array(kmers[at].view(np.int64)), pa.array(context.view(np.int64))],
                names=["doc_id", "digest", *[f.split()[0] for f in RANGE.split(", ")]])

    return rows.mapInArrow(run, f"{key_fields(rows)}, {RANGE}")


def key_fields(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest long"


def same_row(left: DataFrame, right: DataFrame) -> list[Column]:
    return [left["digest"] == right["digest"], left["doc_id"].eqNullSafe(right["doc_id"])]


def told_apart(items: DataFrame, shared: str, whole: str) -> tuple[DataFrame, DataFrame]:
    """Items whose `whole` occurs again, and those left to decide: one for each `whole` of a `shared` that has several.

    The latter carry n, the number of items they stand for.
    """
    counts = items.groupBy(shared).agg(F.count(F.lit(1)).alias("n"), F.min(whole).alias("least"), F.max(whole).alias("most")).where("n > 1")
    again = staged(items.join(counts.drop("n"), shared), "shared")
    alike = F.col("least") == F.col("most")
    fields = [c for c in items.columns if c not in (shared, whole)]
    wholes = staged(again.where(~alike).groupBy(shared, whole).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*fields)).alias("one")), "wholes")
    repeated = again.where(~alike).join(wholes.where("n > 1").select(shared, whole), [shared, whole], "left_semi")
    return (again.where(alike).select(*items.columns).unionByName(repeated.select(*items.columns)),
            wholes.select("one.*", shared, whole, "n"))


PIECE = "at int, part int, low int, high int, shared long, whole long"


def parts(undecided: DataFrame) -> DataFrame:
    """The parts of undecided ranges (doc_id, digest, text, ranges): place of the k-mer, number, windows, hash of the bytes all windows share, of all bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "text", PACKED_BYTES):
            data, starts, ends = laid_out(unpacked(batch.column("text")))
            nested = batch.column("ranges")
            n = np.diff(nested.offsets.to_numpy())
            flat = nested.flatten()
            of = np.repeat(np.arange(len(n)), n)
            at, low, high, kmer = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("at", "low", "high", "kmer"))
            first, last = (at - high) // PART, (at - low) // PART
            count = last - first + 1
            each = np.repeat(np.arange(len(at)), count)
            part = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            of, at, low, high, kmer = of[each], at[each], low[each], high[each], kmer[each]
            center = at - PART * part  # the last window of the part
            low, high = np.maximum(low, center - PART + 1), np.minimum(high, center)
            hashes, begin, size = Hasher(data), starts[of], (ends - starts)[of]
            salt = mix(kmer.view(np.uint64) + part.astype(np.uint64))
            # without a whole part inside the text, the part's own place stands for its bytes
            inside = (center - PART + 1 >= 0) & (center + WIDTH <= size)
            core_from, core_to = np.clip(center, 0, size), np.clip(center - PART + 1 + WIDTH, 0, size)
            shared = mix(hashes(begin + core_from, begin + np.maximum(core_from, core_to)) ^ salt)
            own = mix(batch.column("digest").to_numpy().view(np.uint64)[of] + center.astype(np.uint64) * np.uint64(ROOT))
            whole_from = begin + np.maximum(center - PART + 1, 0)
            whole = np.where(inside, mix(hashes(whole_from, np.minimum(begin + center + WIDTH, begin + size)) ^ salt), own)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(of)) for c in ("doc_id", "digest")],
                 *[pa.array(x.astype(np.int32)) for x in (at, part, low, high)], pa.array(shared.view(np.int64)), pa.array(whole.view(np.int64))],
                names=["doc_id", "digest", *[f.split()[0] for f in PIECE.split(", ")]])

    return undecided.mapInArrow(run, f"{key_fields(undecided)}, {PIECE}")


def windows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """(row of the batch, start, string) of the windows from low to high of each of its pieces."""
    raw = unpacked(batch.column("text"))
    for k, pieces in enumerate(batch.column("pieces").to_pylist()):
        for low, high in sorted({(p["low"], p["high"]) for p in pieces}):
            for s in range(low, high + 1):
                yield k, s, raw[k][s:s + WIDTH]


def sorted_runs(texts: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Front-coded slices of sorted runs: slice number, shared lengths, rests, and how many places each string has, and which."""
    shared = texts.sparkSession.sparkContext.broadcast(splitters)

    def coded(held: list[tuple[bytes, int, int]], ids: list, digests: list) -> pa.RecordBatch:
        held.sort()
        strings = [held[0][0]] + [b[0] for a, b in zip(held, held[1:]) if a[0] != b[0]]  # noqa: B905, RUF007
        places: dict[bytes, list[tuple[int, int]]] = {}
        for string, k, s in held:
            places.setdefault(string, []).append((k, s))
        cuts = shared.value
        target = np.searchsorted(np.array([*cuts, b""], object)[:-1], np.array([s[:PREFIX] for s in strings], object), "right") if cuts else np.zeros(len(strings), int)
        columns: list[list] = [[], [], [], [], [], [], []]
        for part in np.unique(target):
            own = [strings[i] for i in np.flatnonzero(target == part)]
            lengths, rests = front_code(own)
            spots = [p for s in own for p in places[s]]
            for column, value in zip(columns, (int(part), lengths, rests, [len(places[s]) for s in own], [ids[k] for k, _ in spots],
                                               [digests[k] for k, _ in spots], [s for _, s in spots]), strict=True):
                column.append(value)
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(id_kind), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=RUN_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, digests = [], [], []
        for batch in arrow.slices(batches, "text", PACKED_BYTES):
            base = len(ids)
            ids += batch.column("doc_id").to_pylist()
            digests += batch.column("digest").to_pylist()
            for k, s, string in windows_of(batch):
                held.append((string, base + k, s))
                if len(held) == RUN_STRINGS:
                    yield coded(held, ids, digests)
                    held = []
        if held:
            yield coded(held, ids, digests)

    id_kind = pa.from_numpy_dtype(np.int64) if texts.schema["doc_id"].dataType.simpleString() == "bigint" else pa.string()
    kind = "long" if id_kind == pa.int64() else "string"
    return texts.mapInArrow(run, f"slice int, lengths array<int>, rests binary, places array<int>, ids array<{kind}>, digests array<long>, starts array<int>")


RUN_NAMES = ["slice", "lengths", "rests", "places", "ids", "digests", "starts"]


def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first PREFIX bytes of every PART-th window."""
    for batch in arrow.slices(batches, "text", PACKED_BYTES):
        yield pa.RecordBatch.from_arrays([pa.array([w[:PREFIX] for _, s, w in windows_of(batch) if s % PART == 0], pa.binary())], names=["prefix"])


def repeated_windows(texts: DataFrame) -> DataFrame:
    """doc_id, digest, start, end of windows of `texts` (doc_id, digest, text, pieces) that occur at two places or more."""
    total = texts.agg(F.sum(F.aggregate("pieces", F.lit(0).cast("long"), lambda acc, p: acc + p.high - p.low + 1))).first()[0] or 0
    share = min(1.0, SAMPLED / max(1, total / PART))
    sample = sorted(bytes(r.prefix) for r in texts.sample(share / 2, 7).mapInArrow(prefixes, "prefix binary").limit(SAMPLED).collect())
    slices = -(-total // SLICE_STRINGS)
    cuts = sorted({sample[len(sample) * k // slices] for k in range(1, slices)}) if sample else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in arrow.groups(batches, ["slice"]):
            for start, end in arrow.runs(table, ["slice"]):
                part = table.slice(start, end - start)
                coded = [(np.array(a), b) for a, b in zip(part.column("lengths").to_pylist(), part.column("rests").to_pylist(), strict=True)]
                counts = part.column("places").to_pylist()
                spots = [list(zip(a, b, c, strict=True)) for a, b, c in zip(*[part.column(n).to_pylist() for n in RUN_NAMES[4:]], strict=True)]
                place, used = [0] * len(coded), [0] * len(coded)
                out, group = [], []
                for common, k in merge(coded, WIDTH):
                    if common < WIDTH:
                        if len(group) > 1:
                            out += group
                        group = []
                    n = counts[k][place[k]]
                    group += spots[k][used[k]:used[k] + n]
                    place[k] += 1
                    used[k] += n
                if len(group) > 1:
                    out += group
                if out:
                    ids, digests, begins = zip(*out, strict=True)
                    at = pa.array(begins, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, table.schema.field("ids").type.value_type), pa.array(digests, pa.int64()), at,
                         pa.array(np.array(begins, np.int32) + WIDTH)], names=["doc_id", "digest", "low", "high"])

    runs_table = sorted_runs(texts, cuts)
    kind = runs_table.schema["ids"].dataType.elementType.simpleString()
    return runs_table.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, f"doc_id {kind}, digest long, low int, high int")


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, digest of the text, low, high: byte spans whose windows all occur elsewhere too; spans may overlap."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    whole_ranges, open_ranges = told_apart(ranges(rows), "kmer", "context")  # made twice rather than written: they are many
    lists = open_ranges.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("at", "low", "high", "kmer")).alias("ranges"))
    store = packed(rows)
    found = store.join(lists, same_row(store, lists)).select(store.doc_id, store.digest, "text", "ranges")
    repeated = not rows.groupBy("doc_id", "digest").count().where("count > 1").isEmpty()
    if repeated:  # one of equal rows stands for all
        found = found.dropDuplicates(["doc_id", "digest"])
    whole_parts, open_parts = told_apart(staged(parts(found), "parts"), "shared", "whole")
    pieces = open_parts.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("low", "high")).alias("pieces"))
    held = store.join(pieces, same_row(store, pieces)).select(store.doc_id, store.digest, "text", "pieces")
    texts = staged(held.dropDuplicates(["doc_id", "digest"]) if repeated else held, "open")
    windows = repeated_windows(texts)
    span = lambda df: df.select("doc_id", "digest", "low", (F.col("high") + WIDTH).alias("high"))
    return span(whole_ranges).unionByName(span(whole_parts)).unionByName(windows.select("doc_id", "digest", "low", "high"))


def without_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (spans: low, high, ascending and apart), kept (binary) of every row of `documents` (doc_id, text)."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    spans = repeated_spans(documents).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    store = packed(rows)
    joined = store.join(spans, same_row(store, spans), "left").select(store.doc_id, "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow.slices(batches, "text", PACKED_BYTES):
            raw = unpacked(batch.column("text"))
            removed, kept = [], []
            for text, found in zip(raw, batch.column("spans").to_pylist(), strict=True):
                apart: list[list[int]] = []
                for low, high in sorted((s["low"], s["high"]) for s in found or []):
                    if apart and low <= apart[-1][1]:
                        apart[-1][1] = max(apart[-1][1], high)
                    else:
                        apart.append([low, high])
                removed.append([{"low": a, "high": b} for a, b in apart])
                borders = [0, *[x for pair in apart for x in pair], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, removed array<struct<low:int,high:int>>, kept binary")


def digest(documents: DataFrame) -> DataFrame:
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s.high - s.low)
    return without_repeats(documents).select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
