"""Ranked search next to scores of every document and item."""

import math
import random
import re
from collections import Counter

import pytest

from scoreloom.llm import search

random.seed(3)
DOCUMENTS = "doc_id long, text string, item_id long, terms string, score int"
ITEMS = "item_id long, text string, doc_id long, rank string"
WORDS = ["w%d" % n for n in range(300)] + ["é", "Straße", "日本", "a"]


def prose(n):
    return random.choice(" ,-\n_").join(random.choice(WORDS[:random.choice([10, 80, 304])]) for _ in range(n))


BASE = prose(60)
DOCS = [(n, prose(random.choice([3, 20, 90, 400]))) for n in range(260)] + [(1000 + n, BASE) for n in range(14)]
DOCS += [(2000, None), (2001, ""), (2002, "!? --"), (2003, "W1 w1 É é STRASSE"), (2004, "w7 " * 60_000), (None, BASE), (3, BASE), (None, None), (3, BASE)]
QUERIES = [(n, prose(random.choice([1, 5, 30]))) for n in range(30)]
QUERIES += [(50, BASE), (50, BASE), (51, None), (52, ""), (53, "unknown ..."), (54, "w7 W7 w7"), (None, "w1 w2"), (55, " ".join(WORDS))]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items):
    counted = [(i, Counter(terms(t))) for i, t in documents]
    counted = [(i, c) for i, c in counted if c]
    size, total = len(counted), sum(c.total() for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * size + 2) / (2 * n + 1))) for t, n in held.items()}
    out = []
    for item, text in items:
        wanted, scored = set(terms(text)), []
        for i, c in counted:
            m = 10 + 90 * c.total() * size // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_scores(spark, small, monkeypatch):
    if small:  # parts, groups, chunks and halves of chunks
        for name, value in (("PART_BYTES", 900), ("GROUP_TERMS", 40), ("CHUNK_DOCUMENTS", 40), ("CELLS", 2000), ("PIECE", 10)):
            monkeypatch.setattr(search, name, value)
    documents = spark.createDataFrame([(*d, 1, "x", 2) for d in DOCS], DOCUMENTS).repartition(4)
    items = spark.createDataFrame([(*q, 1, "x") for q in (QUERIES[::5] if small else QUERIES)], ITEMS).repartition(2)
    found = search.ranked(documents, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(DOCS, QUERIES[::5] if small else QUERIES)


def test_empty(spark):
    documents, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(QUERIES, "item_id long, text string")
    assert search.ranked(documents.where("false"), items).collect() == []
    assert search.ranked(documents, items.where("false")).collect() == []
    assert search.ranked(documents.where("text is null"), items.where("text is null")).collect() == []


def test_blocks_are_skipped():
    """The bound leaves out blocks, and no document above it is lost."""
    import numpy as np

    generator = np.random.default_rng(1)
    topic = np.arange(60)[None, :] // 6 == generator.integers(0, 10, 2000)[:, None]
    rows, columns = np.nonzero(generator.random((2000, 60)) < np.where(topic, 0.8, 0.02))
    value = generator.integers(1, 1000, len(rows)) ** 2
    index = search.Index(rows, columns, value, 2000, 60)
    for block in range(len(index.summary)):
        members = index.members[index.start[block]:index.start[block + 1]]
        assert (index.summary[block] == index.values[members].max(axis=0)).all()
    visited = []
    top = search.Top()
    add, top.add = top.add, lambda s, i, n: (visited.append(len(i)), add(s, i, n))
    wanted = np.array([0, 1, 2, 3, 4, 5, 13, 44])
    index.search(wanted, top, np.arange(2000), np.zeros(2000, bool))
    scores = index.values[:, wanted].sum(axis=1)
    assert top.ids.tolist() == np.lexsort((np.arange(2000), -scores))[:10].tolist()
    assert sum(visited) < 0.7 * (scores > 0).sum()
