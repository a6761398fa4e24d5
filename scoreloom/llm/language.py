"""Language identification by cross-parsing.

For each language a suffix automaton is built over a bounded sample of labelled text.  A text is parsed greedily against
every automaton: a phrase is the longest match that occurs in the sample, and the next phrase starts behind it.  The language
that needs the fewest phrases, each weighted by the bits that name a place in its sample, wins.

The automata are dense tables, so a batch of texts is parsed in lockstep: texts are cut into segments of SEGMENT symbols, and
each step moves all segments one symbol forward against all languages.  Whole texts are parsed; every language restarts
its phrase at the same segment borders.  Letters from CODES up (kana, Han, Hangul) are spelled in DIGITS symbols each, so that
tables stay narrow in scripts of many letters.

Texts that are null, empty or without a letter are `und` with score 0.  A text of letters that no sample has counts one phrase
a letter in every language; equal costs go to the language first in order of name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm import arrow

#: Bounds of the sample that the automata learn from: texts a language, characters from the start of each, and characters a language
#: once runs of other characters are one space.
SAMPLE_TEXTS, SAMPLE_CHARACTERS, SAMPLE_SYMBOLS = 64, 500, 24_000
#: No more languages than this are learned in one run.
MOST_LANGUAGES = 500
SEGMENT = 256
BATCH_BYTES = 1 << 20
SPACE, OTHER = 1, 0  # symbol codes; OTHER never matches
CODES = 0x3000  # code points with a symbol of their own at most; letters above are spelled
DIGITS, DIGIT_BITS = 3, 6  # symbols of a spelled letter, leading one first; each place has symbols of its own.  No letter needs more bits
SPELLED = CODES + (DIGITS << DIGIT_BITS)

held_out_fold = 5


def fold(doc_id: F.Column | str, folds: int) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def letter_codes() -> np.ndarray:
    """For each code point below CODES: itself in lower case where it is a letter, else a space."""
    lowered = np.full(CODES, ord(" "), np.uint32)
    for c in range(CODES):
        if chr(c).isalpha():
            low = chr(c).lower()
            lowered[c] = ord(low[0])
    return lowered


LETTERS = letter_codes()


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end: lower-case letters as code points, runs of anything else as one space; and each text's length."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lens)
    low = points < CODES
    points = np.where(low, LETTERS[np.where(low, points, 0)], points)
    if not low.all():  # above the table
        values, which = np.unique(points[~low], return_inverse=True)
        points[~low] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else ord(" ") for c in values], np.uint32)[which]
    blank = points == ord(" ")
    first = np.append(True, owner[1:] != owner[:-1]) if len(owner) else np.zeros(0, bool)
    keep = ~(blank & (np.append(True, blank[:-1]) | first)) if len(owner) else first
    return points[keep], np.bincount(owner[keep], minlength=len(texts))


def spelled(points: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters from CODES up as DIGITS codes each, all codes below SPELLED; and each text's new length."""
    high = points >= CODES
    if not high.any():
        return points, lens
    times = np.where(high, DIGITS, 1)
    out = np.repeat(points, times)
    first = (np.cumsum(times) - times)[high]
    for k in range(DIGITS):
        digit = points[high] >> np.uint32(DIGIT_BITS * (DIGITS - 1 - k)) & np.uint32((1 << DIGIT_BITS) - 1)
        out[first + k] = CODES + (k << DIGIT_BITS) + digit
    return out, np.bincount(np.repeat(np.arange(len(lens)), lens), times, len(lens)).astype(np.int64)


def automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """The suffix automaton's transitions as a dense table (state, symbol) -> state; 0, the start, means none."""
    size = 2 * len(symbols) + 2
    moves: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.zeros((min(size, len(moves)), alphabet), np.int32)
    for state, out in enumerate(moves):
        for s, to in out.items():
            table[state, s] = to
    return table


class Languages:
    """The learned automata; small enough to travel with the task."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        sample = {n: code_points([t + " " for t in samples[n]])[0][:SAMPLE_SYMBOLS] for n in self.names}
        points = {n: spelled(p, np.array([len(p)]))[0] for n, p in sample.items()}
        seen = np.unique(np.concatenate([*points.values(), np.array([ord(" ")], np.uint32)]))
        seen = seen[seen != ord(" ")]
        self.symbol = np.zeros(SPELLED, np.uint8 if len(seen) < 250 else np.uint16)
        self.symbol[ord(" ")] = SPACE
        self.symbol[seen] = np.arange(len(seen)) + 2
        self.width = len(seen) + 2
        tables = [automaton(self.symbol[points[n]].tolist(), self.width) for n in self.names]
        self.starts = np.cumsum([0, *[len(t) for t in tables[:-1]]])
        self.table = np.concatenate([np.where(t > 0, t + s, 0) for t, s in zip(tables, self.starts, strict=True)]).astype(np.int32)
        self.table[:, OTHER] = 0
        self.bits = np.log2([max(2, len(points[n])) for n in self.names])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and each text's symbols."""
        points, lens = spelled(*code_points(texts))
        symbols = np.append(self.symbol[points].astype(np.int32), 0)
        pieces = -(-lens // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(lens) - lens, pieces) + number * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(lens, pieces) - number * SEGMENT)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # segments longer than the step
        root = (self.starts * self.width).astype(np.int64)[:, None]
        state = np.repeat(root, len(owner), axis=1)
        count = np.zeros(state.shape, np.int32)
        flat = self.table.ravel()
        for step in range(int(size.max(initial=0))):
            n = active[step]
            now = symbols[begin[:n] + step]
            at = state[:, :n]
            to = flat[at + now]
            fresh = (to == 0) | (at == root)
            count[:, :n] += fresh
            again = flat[root + now]
            to = np.where(to == 0, again, to).astype(np.int64) * self.width
            state[:, :n] = np.where(to == 0, root, to)
        total = np.stack([np.bincount(owner, c, minlength=len(texts)) for c in count], axis=1)
        return total, lens

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and a score from 0 to 1: by how much its cost is below the next one's, and 1 if alone."""
        total, lens = self.phrases(texts)
        cost = total * self.bits
        best = cost.argmin(axis=1)
        ordered = np.sort(cost, axis=1)
        second = ordered[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        letters = np.array([any(map(str.isalpha, t)) for t in texts], bool) if len(texts) else np.zeros(0, bool)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(letters, 1 - ordered[:, 0] / second, 0.0)
        return [self.names[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.nan_to_num(score)


def learn(labelled: DataFrame, id_column: str = "doc_id") -> Languages | None:
    """The automata of the languages in `labelled` (text, lang), from its rows with the smallest digests of their ids.

    The sample is bounded by SAMPLE_TEXTS and SAMPLE_SYMBOLS for each language; rows that are equal in id sort by their text.
    None without a labelled text.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.col(id_column).alias("id"), F.xxhash64("text").alias("digest"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id", "digest")
    keys = rows.select("lang", "id", "digest")
    # ids and digests only are ranked; each task keeps SAMPLE_TEXTS of a language before the exchange
    chosen = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_TEXTS)
    picked = chosen.limit(SAMPLE_TEXTS * MOST_LANGUAGES + 1).collect()
    if len({r.lang for r in picked}) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not picked:
        return None
    spark = labelled.sparkSession
    bounded = spark.createDataFrame(picked, chosen.schema).groupBy("lang", "id", "digest").agg(F.min("place").alias("place"))
    pair = [rows.lang == bounded.lang, rows.id.eqNullSafe(bounded.id), rows.digest == bounded.digest]
    sample = rows.join(F.broadcast(bounded), pair).groupBy(rows.lang, bounded.place).agg(
        F.first(F.substring(rows.text, 1, SAMPLE_CHARACTERS)).alias("text"))
    samples: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.lang, r.place)):
        samples.setdefault(row.lang, []).append(row.text)
    return Languages(samples)


def identify(df: DataFrame, languages: Languages | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row.  Columns of these names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in arrow.slices(batches, text, BATCH_BYTES):
            texts = arrow.texts(batch.column(text))
            names, score = model.predict(texts) if model else (["und"] * len(texts), np.zeros(len(texts)))
            yield arrow.with_columns(batch, ["lang_pred", "score"], [pa.array(names, pa.string()), pa.array(score, pa.float64())])

    kept = df.drop("lang_pred", "score")
    schema = kept.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}).schema
    return kept.mapInArrow(run, schema)


def training_rows(documents: DataFrame) -> DataFrame:
    """The labelled rows outside the held-out fold."""
    return documents.where(F.coalesce(fold("doc_id", held_out_fold) != 0, F.lit(True)))


def predict_languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; rows without an id are not held out."""
    found = identify(documents.select("doc_id", "text"), learn(training_rows(documents)))
    held_out = F.coalesce(fold("doc_id", held_out_fold) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
