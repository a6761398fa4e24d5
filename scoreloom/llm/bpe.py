"""BPE encoding and decoding with a public word-level vocabulary, by batched numpy merge rounds.

The words of a batch that no earlier batch had are laid end to end in one flat array of symbols.  In each round every word
merges all places of its lowest-ranked pair; ranks are found by binary search over the sorted pair keys.  A word is done
when none of its pairs is in the merge list, and leaves the array.

Nulls and empty texts encode to no ids.  Texts are encoded whole, whatever their length.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import arrow

BATCH_BYTES = 4 << 20
#: Words remembered per task; the memory starts anew beyond it.
REMEMBERED = 200_000
#: Texts without these are split by the file's own pattern; Unicode versions differ only among the others.
BEYOND = regex.compile("[\u0558-\U0010ffff]")
SHIFT = 20  # a pair key is left * 2^20 + right


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """The vocabulary file of a word-end BPE in the JSON form of the `tokenizers` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.common, self.rare = regex.compile(self.pattern), None
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.final = np.array([vocab[c + self.suffix] for c in letters])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << SHIFT | vocab[b] for a, b in pairs])
        merged = np.array([vocab[a + b] for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        names = vocab | self.special
        strings = [""] * (max(names.values()) + 1)
        for token, i in names.items():
            strings[i] = token
        self.strings = pa.array(strings)
        self.forget()

    def words(self, text: str) -> list[str]:
        """Words of a normalised text; code points that this Python has no name for are neither letters nor digits."""
        if not BEYOND.search(text):
            return self.common.findall(text)
        if self.rare is None:
            unnamed = "".join(f"\\U{c:08x}" for c in range(0x558, 0x110000)
                              if unicodedata.category(chr(c)) == "Cn" and regex.match(r"[\p{L}\p{N}]", chr(c)))
            pattern = self.pattern
            for kind in ("L", "N"):
                pattern = pattern.replace(f"[^\\s\\p{{L}}\\p{{N}}]", "(?:[^\\s\\p{L}\\p{N}]|[UNNAMED])")
                pattern = pattern.replace(f"[\\p{{{kind}}}]", f"(?:(?![UNNAMED])\\p{{{kind}}})")
            self.rare = regex.compile(pattern.replace("UNNAMED", unnamed))
        return self.rare.findall(text)

    def normalise(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # sigma has one lower-case form here, at a word's end too

    def pieces(self, text: str) -> Iterator[str | int]:
        """The words of a text, and ids where it spells out a special token."""
        start = 0
        for found in self.splitter.finditer(text):
            yield from self.words(self.normalise(text[start:found.start()]))
            yield self.special[found[0]]
            start = found.end()
        yield from self.words(self.normalise(text[start:] if start else text))

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols, word = self.inner[flat], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.final[flat[ends]]
        done_symbols, done_word = [], []
        never = len(self.keys)
        while len(symbols):
            pair = np.where(word[:-1] == word[1:], symbols[:-1] << SHIFT | symbols[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, pair), never - 1)
            rank = np.append(np.where(self.keys[at] == pair, self.ranks[at], never), never)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(word)))
            alive = np.repeat(best < never, counts)
            if not alive.all():
                done_symbols.append(symbols[~alive])
                done_word.append(word[~alive])
            hit = (rank == np.repeat(best, counts)) & alive
            # in a run of overlapping places (x x x) every other one merges, from the left
            first = hit & ~np.append(False, hit[:-1])
            index = np.arange(len(hit))
            since = index - np.maximum.accumulate(np.where(first, index, 0))
            hit &= since % 2 == 0
            symbols = symbols.copy()
            places = np.flatnonzero(hit)
            symbols[places] = self.merged[at[places]]
            alive[places + 1] = False
            symbols, word = symbols[alive], word[alive]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.split(symbols[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each text has."""
        split = [list(self.pieces(t)) for t in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        new = list({p for pieces in split for p in pieces}.difference(self.known))
        words = [p for p in new if not isinstance(p, int)]
        numbers = [p for p in new if isinstance(p, int)]
        found = self.merge(words) + [np.array([p]) for p in numbers]
        self.known.update(zip(words + numbers, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.sizes = np.concatenate([self.sizes, np.array([len(f) for f in found], np.int64)])
        self.store = np.concatenate([self.store, *found])
        firsts = np.cumsum(self.sizes) - self.sizes
        pieces = np.array([len(x) for x in split], np.int64)
        which = np.fromiter((self.known[p] for x in split for p in x), np.int64, pieces.sum())
        sizes = self.sizes[which]
        offsets = np.cumsum(sizes) - sizes
        ids = self.store[np.repeat(firsts[which] - offsets, sizes) + np.arange(sizes.sum())]
        per_text = np.add.reduceat(np.append(sizes, 0), np.cumsum(pieces) - pieces) if len(texts) else sizes
        return ids, np.where(pieces > 0, per_text, 0)

    def forget(self) -> None:
        self.known: dict[str | int, int] = {}
        self.sizes, self.store = np.zeros(0, np.int64), np.zeros(0, np.int64)


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids` (array<int>), the whole text's token ids; `path` is the vocabulary file, present on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in arrow.slices(batches, text, BATCH_BYTES):
            found, sizes = tokenizer.encode(arrow.texts(batch.column(text)))
            offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            yield arrow.with_columns(batch, [ids], [pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32()))])

    kept = df.drop(ids)
    return kept.mapInArrow(run, kept.withColumn(ids, F.lit(None).cast("array<int>")).schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds `text`: the tokens of `ids` joined by spaces, as the library does for a vocabulary without a decoder; null: ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = load(path).strings
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                lists = pc.fill_null(batch.column(ids), pa.scalar([], batch.column(ids).type))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy())), pa.int32()),
                    strings.take(pc.list_flatten(lists)))
                yield arrow.with_columns(batch, [text], [pc.binary_join(lists, " ")])

    kept = df.drop(text)
    return kept.mapInArrow(run, kept.withColumn(text, F.lit(None).cast("string")).schema)


def round_trip_digest(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""
    kept = df.select("doc_id", "text")
    return decode(encode(kept, path).drop("text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
