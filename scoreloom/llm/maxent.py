"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Words are counted over all training texts.  The CLASSES * MEMBERS most frequent make up classes by rank; all other words, and words
never seen, are one further class.  A token's probability is P(class | context) * P(word | class, context): both are softmaxes over
a bias, taken from the counts, and weights of hashed context features: the word before, the two words before, and the word
before that one with a gap.  Within the class of other words a word's hash names a leaf of a tree of MEMBERS branches a node: each
branch on the way is a softmax of the same kind, over the node and the context, so context weighs for every word, known or not.
Within its leaf, of LEAF_WORDS words or so while LEVELS suffice, a word has its smoothed share of the counts.

Training runs in ROUNDS rounds, each over its share of the texts: every task starts from the shared weights, takes gradient steps
over the texts of its partition, for all context features, and returns its change; changes are averaged by tokens.  Weights have a fixed size,
so partitions of little text are joined until a task has TASK_TOKENS tokens or so: what the tasks send grows with the text, not with the files.

Counts of the HEAD most frequent words travel to the tasks; rarer words of a text are looked up by a join.  A null or empty text is
its end token alone.  Repeated rows are rows of their own.  Without training texts every probability is that of an unseen word.
"""

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm import arrow
from scoreloom.llm.substrings import mix
from scoreloom.llm.words import Words
from scoreloom.session import staged

HEAD = 200_000  # words whose counts travel to the tasks, at most
CLASSES, MEMBERS = 32, 32
OTHER = CLASSES  # the class of all other words
ROUNDS = 2
CLASS_ROWS, MEMBER_ROWS = 1 << 12, 1 << 13  # hashed feature rows of the two softmaxes
LEAF_WORDS, LEVELS, BRANCH_BITS = 32, 3, 5  # words in a leaf, levels of the tree at most, bits of the hash that name a branch
DIGIT_BITS = 13, 16  # bits of the hashed feature rows of branches: at least, at most; in between they grow with the vocabulary
RATE = 0.5
STEP = 4096  # tokens in a gradient step, and scored at once
END = b"\n"  # no word holds a line break
BATCH_BYTES = 1 << 20
COUNTED = 1 << 24  # bytes of text whose words a task counts before it passes them on
BLOCK = 1024  # tokens whose scores are worked on at once, so that they stay in the cache
SMALL = 1e-8  # sums of products below which single precision could lose a share
FEW = 4  # occurrences of a row in a step up to which they are added one by one
TASK_TOKENS = 1_000_000  # tokens of all training texts for each task that trains
TOGETHER = 32  # tasks whose changes are added in the first of two sums
PIECE = 2048  # rows of weights that are added at once
SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
END_HASH = np.uint64(0x632BE59BD9B4E019)
fold, held_out_fold = 7, 2


def remainder(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(fold))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows without an id are trained on."""
    return F.coalesce(remainder(doc_id) == held_out_fold, F.lit(False))


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def out() -> pa.RecordBatch:
            texts = pc.fill_null(pa.chunked_array(held, pa.string()), "")
            found = pc.value_counts(pc.list_flatten(pc.ascii_split_whitespace(pc.ascii_lower(texts))))
            found = found.filter(pc.not_equal(found.field("values"), ""))  # what stands before leading white space
            return pa.RecordBatch.from_arrays([pa.concat_arrays([found.field("values"), pa.array([END.decode()])]),
                                               pa.concat_arrays([found.field("counts"), pa.array([len(texts)], pa.int64())])], names=["word", "n"])

        size = 0
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            held.append(batch.column("text").cast(pa.string()))
            size += int(arrow.lengths(held[-1]).sum())
            if size > COUNTED:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return documents.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hashes_of(words: list[bytes]) -> np.ndarray:
    hashes = np.full(len(words), END_HASH)
    hashes[[w != END for w in words]] = Words([b" ".join(w for w in words if w != END)]).hashes
    return hashes


def levels_for(words: int) -> int:
    """Levels of the tree for so many words."""
    return next((k for k in range(LEVELS) if MEMBERS**k * LEAF_WORDS >= words), LEVELS)


def leaves(hashes: np.ndarray, levels: int) -> np.ndarray:
    return (mix(hashes) >> np.uint64(40)).astype(np.int64) & ((1 << BRANCH_BITS * levels) - 1)


def leaf_counts(counts: DataFrame, levels: int) -> DataFrame:
    """(leaf, n, words) over all words; the tree bounds its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(leaves(hashes_of(arrow.utf8(batch.column("word"))), levels)), batch.column("n")], names=["leaf", "n"])

    return counts.select("word", "n").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))


class Vocabulary:
    """The most frequent words with their counts, and the sums over all words and over those of each leaf (leaf, n, words)."""

    def __init__(self, head: list[tuple[str, int]], total: int, distinct: int, levels: int, by_leaf: list[tuple[int, int, int]]):
        ordered = sorted(head, key=lambda x: (-x[1], x[0]))
        self.words = [w.encode() for w, _ in ordered]
        self.counts = np.array([n for _, n in ordered], np.int64)
        self.total, self.distinct = total, distinct
        model = self.counts[:CLASSES * MEMBERS]
        self.other_total, self.other_distinct = total - int(model.sum()), distinct - len(model)
        share = np.zeros(CLASSES * MEMBERS)
        share[:len(model)] = model
        by_class = share.reshape(CLASSES, MEMBERS)
        # a word that fills no place has no share; classes without words neither
        self.class_bias = np.log((np.append(by_class.sum(axis=1), self.other_total + 1) + 1e-9) / (total + 1)).astype(np.float32)
        self.member_bias = np.log((by_class + 1e-9) / (by_class.sum(axis=1, keepdims=True) + 1e-9)).astype(np.float32)
        self.levels, self.leaf_mass = levels, np.ones(MEMBERS**levels)
        for leaf, n, words in by_leaf:
            self.leaf_mass[leaf] += n + words
        # the words with a class of their own are no others
        np.subtract.at(self.leaf_mass, leaves(hashes_of(self.words[:len(model)]), levels), model + 1)
        self.branch_bias = []
        for k in range(levels):
            mass = self.leaf_mass.reshape(MEMBERS**k, MEMBERS, -1).sum(axis=2)
            self.branch_bias.append(np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32))
        self.digit_bits = int(np.clip((self.other_distinct // MEMBERS).bit_length(), *DIGIT_BITS))
        self._ranks: Ranks | None = None

    def ranks(self) -> "Ranks":
        """Made once in a worker, not for every task."""
        if self._ranks is None:
            self._ranks = Ranks(self)
        return self._ranks

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))

    def others_in(self, leaf: np.ndarray) -> np.ndarray:
        """What a word of the other class, counted once more than it occurs, is a share of."""
        return np.log10(self.leaf_mass[leaf])


class Ranks:
    """Ranks of words among the head, by their hashes: a table by leading bits, and a sorted list for the words it has no room for."""

    BITS = 20

    def __init__(self, vocabulary: Vocabulary):
        hashes = hashes_of(vocabulary.words)
        self.levels = vocabulary.levels
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        _, first = np.unique(slot, return_index=True)
        self.hash, self.rank = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
        self.hash[slot[first]], self.rank[slot[first]] = hashes[first], first
        rest = np.setdiff1d(np.arange(len(hashes)), first)
        rest = rest[np.argsort(hashes[rest])]
        self.crowded = np.zeros(1 << self.BITS, bool)
        self.crowded[slot[rest]] = True
        self.rest_hash, self.rest_rank = hashes[rest], rest.astype(np.int32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        rank = np.where(self.hash[slot] == hashes, self.rank[slot], -1)
        open_ = np.flatnonzero((rank < 0) & self.crowded[slot])
        at = np.minimum(np.searchsorted(self.rest_hash, hashes[open_]), max(0, len(self.rest_hash) - 1))
        if len(open_):
            rank[open_] = np.where(self.rest_hash[at] == hashes[open_], self.rest_rank[at], -1)
        return rank


def features(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(3, tokens) hashes of the contexts; `first` marks the first token of each text, before which there is nothing."""
    nothing = np.uint64(1)
    one, two = np.empty_like(hashes), np.empty_like(hashes)
    one[1:], one[:1] = hashes[:-1], nothing
    one[first] = nothing
    two[1:], two[:1] = one[:-1], nothing
    two[first] = nothing
    return np.stack([one * SALTS[0], (one * SALTS[1]) ^ (two * SALTS[0] << np.uint64(1)) * SALTS[2], two * SALTS[2]])


class Model:
    """Weights of the two softmaxes."""

    def __init__(self, vocabulary: Vocabulary):
        self.class_bias, self.member_bias = vocabulary.class_bias, vocabulary.member_bias
        self.by_class = np.zeros((CLASS_ROWS, CLASSES + 1), np.float32)
        self.by_member = np.zeros((MEMBER_ROWS, MEMBERS), np.float32)
        self.branch_bias, self.digit_bits = vocabulary.branch_bias, vocabulary.digit_bits
        self.by_branch = np.zeros((1 << self.digit_bits, MEMBERS), np.float32)
        self.factors: dict[str, list[np.ndarray]] | None = None

    @staticmethod
    def softmax(scores: np.ndarray) -> np.ndarray:
        """Biases are log shares and weights stay small, so exp cannot overflow within the bound."""
        np.minimum(scores, np.float32(60), out=scores)
        np.exp(scores, out=scores)
        scores /= (scores @ np.ones(scores.shape[1], np.float32))[:, None]
        return scores

    @classmethod
    def shares(cls, bias: np.ndarray, weights: np.ndarray, rows: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        """The softmax of every token over its rows' weights and the bias, its node's if there are nodes; some tokens after the other."""
        out = np.empty((rows.shape[1], weights.shape[1]), np.float32)
        for k in range(0, len(out), BLOCK):
            scores, row = out[k:k + BLOCK], rows[:, k:k + BLOCK]
            np.add(weights.take(row[0], axis=0), weights.take(row[1], axis=0), out=scores)
            scores += weights.take(row[2], axis=0)
            scores += bias if node is None else bias.take(node[k:k + BLOCK], axis=0)
            cls.softmax(scores)
        return out

    @staticmethod
    def class_rows(context: np.ndarray) -> np.ndarray:
        return (context >> np.uint64(64 - 12)).astype(np.uint16)

    @staticmethod
    def member_rows(context: np.ndarray, group: np.ndarray) -> np.ndarray:
        mixed = (context ^ ((group.astype(np.uint64) + np.uint64(1)) * SALTS[1])) * SALTS[0]
        return (mixed >> np.uint64(64 - 13)).astype(np.uint16)

    def branch_rows(self, context: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level: rows, the node, and the branch towards the leaf."""
        for level in range(len(self.branch_bias)):
            below = BRANCH_BITS * (len(self.branch_bias) - 1 - level)
            node = leaf >> (below + BRANCH_BITS)
            mixed = mix(context ^ ((node * LEVELS + level + 1).astype(np.uint64) * SALTS[1]))
            yield (mixed >> np.uint64(64 - self.digit_bits)).astype(np.uint16), node, leaf >> below & (MEMBERS - 1)

    def classes(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.class_rows(context)
        return rows, self.shares(self.class_bias, self.by_class, rows)

    def members(self, context: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.member_rows(context, group)
        return rows, self.shares(self.member_bias, self.by_member, rows, group)

    def branches(self, context: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level: rows, probabilities of the branches, and the branch towards the leaf."""
        for bias, (rows, node, branch) in zip(self.branch_bias, self.branch_rows(context, leaf), strict=True):
            yield rows, self.shares(bias, self.by_branch, rows, node), branch

    def tables(self) -> dict[str, list[np.ndarray]]:
        """Weights and then the bias, or that of every level, of the softmaxes."""
        return {"class": [self.by_class, self.class_bias], "member": [self.by_member, self.member_bias], "branch": [self.by_branch, *self.branch_bias]}

    def share(self, name: str, rows: np.ndarray, wanted: np.ndarray, node: np.ndarray | None = None, level: int = 0) -> np.ndarray:
        """The probability of every token's wanted column, as a share of products: the exponentials are made once while the weights stay.
        A row's greatest factor is 1, which changes no share, so that products cannot overflow; where they get small, the softmax is taken."""
        if self.factors is None:
            self.factors = {k: [np.exp(x - x.max(axis=-1, keepdims=True)) for x in tables] for k, tables in self.tables().items()}
        weights, bias = self.factors[name][0], self.factors[name][1 + level]
        product = weights.take(rows[0], axis=0)
        product *= weights.take(rows[1], axis=0)
        product *= weights.take(rows[2], axis=0)
        product *= bias if node is None else bias.take(node, axis=0)
        total = product @ np.ones(product.shape[1], np.float32)
        out = product[np.arange(len(wanted)), wanted] / np.maximum(total, np.finfo(np.float32).tiny)
        small = np.flatnonzero(total < SMALL)
        if len(small):
            tables = self.tables()[name]
            exact = self.shares(tables[1 + level], tables[0], rows[:, small], None if node is None else node[small])
            out[small] = exact[np.arange(len(small)), wanted[small]]
        return out

    @staticmethod
    def ascend(weights: np.ndarray, row: np.ndarray, gradient: np.ndarray) -> None:
        """A gradient step for one context feature; a row's gradients are averaged, with one more that is zero."""
        order = np.argsort(row, kind="stable")  # a radix sort, as rows are 16 bits wide
        ordered = row[order]
        starts = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
        times = np.diff(starts, append=len(row))
        fall = np.argsort((STEP - times).astype(np.uint16), kind="stable")  # the most frequent rows first
        starts, times = starts[fall], times[fall]
        more = np.searchsorted(-times, -np.arange(FEW + 1))  # how many rows occur more than 0, 1, ... FEW times
        often = more[FEW]
        total = gradient.take(order[starts], axis=0)
        if often:
            ends = np.cumsum(times[:often])
            begins = ends - times[:often]
            own = order[np.arange(ends[-1]) + np.repeat(starts[:often] - begins, times[:often])]
            total[:often] = np.add.reduceat(gradient.take(own, axis=0), begins, axis=0)
        for k in range(1, FEW):
            if more[k] == often:
                break
            total[often:more[k]] += gradient.take(order[starts[often:more[k]] + k], axis=0)
        total *= (np.float32(RATE) / (1 + times)).astype(np.float32)[:, None]
        at = ordered[starts]
        total += weights.take(at, axis=0)
        whole = np.dtype((np.void, weights.shape[1] * weights.itemsize))  # a row of weights as one value, which is faster to put
        weights.view(whole)[at, 0] = total.view(whole)[:, 0]

    def learn(self, context: np.ndarray, group: np.ndarray, member: np.ndarray, leaf: np.ndarray) -> None:
        """A gradient step: the weights of every context feature move, for all tokens."""
        self.factors = None
        rows, p = self.classes(context)
        gradient = np.negative(p, out=p)
        gradient[np.arange(len(group)), group] += 1
        for row in rows:
            self.ascend(self.by_class, row, gradient)
        known = np.flatnonzero(group < OTHER)
        if len(known):
            rows, p = self.members(context[:, known], group[known])
            gradient = np.negative(p, out=p)
            gradient[np.arange(len(known)), member[known]] += 1
            for row in rows:
                self.ascend(self.by_member, row, gradient)
        rest = np.flatnonzero(group == OTHER)
        if len(rest):
            for rows, p, branch in self.branches(context[:, rest], leaf[rest]):
                gradient = np.negative(p, out=p)
                gradient[np.arange(len(rest)), branch] += 1
                for row in rows:
                    self.ascend(self.by_branch, row, gradient)

    def log10(self, context: np.ndarray, group: np.ndarray, member: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log10 of P(class) * P(member); of P(class) * P(leaf) for the other class."""
        out = self.share("class", self.class_rows(context), group).astype(np.float64)
        known = np.flatnonzero(group < OTHER)
        if len(known):
            out[known] *= self.share("member", self.member_rows(context[:, known], group[known]), member[known], group[known])
        rest = np.flatnonzero(group == OTHER)
        if len(rest):
            for level, (rows, node, branch) in enumerate(self.branch_rows(context[:, rest], leaf[rest])):
                out[rest] *= self.share("branch", rows, branch, node, level)
        return np.log10(np.maximum(out, 1e-30))


class Coded:
    """The tokens of some texts: ranks (-1: not in the head), contexts, classes, members, and counts by text."""

    def __init__(self, texts: list[bytes], ranks: Ranks):
        self.words = Words(texts)
        self.counts = self.words.counts + 1
        ends = np.cumsum(self.counts)
        is_word = np.ones(int(ends[-1]), bool)
        is_word[ends - 1] = False
        hashes = np.full(len(is_word), END_HASH)
        hashes[is_word] = self.words.hashes
        self.is_word = is_word
        self.place = np.cumsum(is_word) - 1  # a token's number among the words
        self.rank = ranks(hashes)
        self.context = features(hashes, ends - self.counts)
        self.leaf = leaves(hashes, ranks.levels)
        modelled = (self.rank >= 0) & (self.rank < CLASSES * MEMBERS)
        small = np.where(modelled, self.rank, 0)
        self.group, self.member = np.where(modelled, small // MEMBERS, OTHER), small % MEMBERS


def weight_changes(documents: DataFrame, vocabulary, model) -> DataFrame:
    """(part, tokens, change): every task's change of each part of the weights, times its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = pickle.loads(model.value)
        mine, ranks, seen = pickle.loads(model.value), vocabulary.value.ranks(), 0
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            c = Coded(arrow.utf8(batch.column("text")), ranks)
            for k in range(0, len(c.rank), STEP):
                mine.learn(c.context[:, k:k + STEP], c.group[k:k + STEP], c.member[k:k + STEP], c.leaf[k:k + STEP])
            seen += len(c.rank)
        if seen:
            task = TaskContext.get().partitionId() // TOGETHER
            for w in ("by_class", "by_member", "by_branch"):
                for i in range(0, len(getattr(mine, w)), PIECE):
                    change = (getattr(mine, w)[i:i + PIECE] - getattr(start, w)[i:i + PIECE]) * np.float32(seen)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{w} {i}"]), pa.array([task], pa.int32()), pa.array([float(seen)]), pa.array([change.tobytes()], pa.binary())],
                        names=["part", "task", "tokens", "change"])

    return documents.select("text").mapInArrow(run, "part string, task int, tokens double, change binary")


def summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["change"].iloc[0]) // 4)
    for change in rows["change"]:
        total += np.frombuffer(change, np.float32)
    return pd.DataFrame({"part": [key[0]], "tokens": [rows["tokens"].sum()], "change": [total.astype(np.float32).tobytes()]})


def train(documents: DataFrame, vocabulary: Vocabulary) -> Model:
    spark = documents.sparkSession
    model = Model(vocabulary)
    words = spark.sparkContext.broadcast(vocabulary)
    turn = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(ROUNDS))
    documents = documents.coalesce(max(1, -(-vocabulary.total // TASK_TOKENS)))  # never more tasks than before
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(pickle.dumps(model))
        changes = weight_changes(documents.where(turn == k), words, shared)
        schema = "part string, tokens double, change binary"
        total = changes.groupBy("part", "task").applyInPandas(summed, schema).groupBy("part").applyInPandas(summed, schema)
        for row in total.collect():  # one row for each PIECE rows of weights
            name, start = row.part.split()
            weights = getattr(model, name)[int(start):int(start) + PIECE]
            weights += np.frombuffer(row.change, np.float32).reshape(weights.shape) / np.float32(row.tokens)
    return model


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # the least count whose words, and all more frequent ones, are HEAD at most
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    running = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = sizes.withColumn("running", running).where(F.col("running") <= HEAD).agg(F.min("n")).first()[0]
    head = counts.where(F.col("n") >= least).collect() if least is not None else []
    levels = levels_for(distinct - min(len(head), CLASSES * MEMBERS))
    return Vocabulary([(r.word, r.n) for r in head], total, distinct, levels, [tuple(r) for r in leaf_counts(counts, levels).collect()])


PARTIAL = "n_tokens long, n_known long, base_score double, score double, rare array<struct<word:string,times:long>>"


def partly_scored(documents: DataFrame, vocabulary, model) -> DataFrame:
    """doc_id and PARTIAL: sums over the head's words, and the words that are to be looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = vocabulary.value, pickle.loads(model.value)
        ranks = known.ranks()
        counts_of = np.append(known.counts, 0)
        base, other = known.base(counts_of), np.log10(counts_of + 1)
        base[-1] = 0  # not in the head; as for others, a rare word's count comes by the join
        for batch in arrow.slices(batches, "text", BATCH_BYTES):
            c = Coded(arrow.utf8(batch.column("text")), ranks)
            rank, counts = c.rank, c.counts
            score = np.concatenate([weights.log10(c.context[:, k:k + STEP], c.group[k:k + STEP], c.member[k:k + STEP], c.leaf[k:k + STEP])
                                    for k in range(0, len(rank), STEP)])
            score += np.where(c.group == OTHER, other[rank] - known.others_in(c.leaf), 0)
            starts = np.cumsum(counts) - counts
            unknown = np.flatnonzero((rank < 0) & c.is_word)
            owner = np.repeat(np.arange(len(counts)), counts)[unknown]
            rare: list[Counter] = [Counter() for _ in counts]
            for row, place in zip(owner.tolist(), c.place[unknown].tolist(), strict=True):
                rare[row][c.words[place]] += 1
            for row in np.flatnonzero(rank[starts + counts - 1] < 0).tolist():  # end tokens, where the head is empty
                rare[row][END] += 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts), pa.array(np.add.reduceat((rank >= 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(base[rank], starts)), pa.array(np.add.reduceat(score, starts)),
                pa.array([[{"word": w.decode(), "times": n} for w, n in times.items()] for times in rare],
                         pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))),
            ], names=["doc_id", *[f.split()[0] for f in PARTIAL.split(", ")]])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, {PARTIAL}")


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = documents.sparkSession
    training = documents.where(~held_out())
    counts = staged(word_counts(training), "words")
    vocabulary = learn_vocabulary(counts)
    model = train(training, vocabulary)
    shared = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(pickle.dumps(model))
    partial = staged(partly_scored(documents, *shared).withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = partial.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    n = F.coalesce("n", F.lit(0))
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(vocabulary.total + vocabulary.distinct + 1))).alias("base"),
        F.sum(F.col("times") * F.log10((n + 1).cast("double"))).alias("other"))
    zero = F.lit(0)
    return partial.drop("rare").join(found, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("other", zero)).alias("score"))
