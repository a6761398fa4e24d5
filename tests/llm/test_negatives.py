"""Hard negatives next to all inner products."""

import math
import random

import numpy as np
import pytest

from scoreloom.llm import negatives

random.seed(11)
DDL = "vec_id long, embedding array<double>, label int, chunk string, block int"


def vector(n=20, scale=1.0):
    return [random.gauss(0, 1) * scale for _ in range(n)]


BASE = vector()
CLOSE = [[x + random.gauss(0, 0.1) for x in BASE] for _ in range(60)]
ROWS = [(i, v, i % 3) for i, v in enumerate(CLOSE)]
ROWS += [(100 * i, [x + random.gauss(0, 0.2) for x in BASE], i % 4) for i in range(1, 9)]
ROWS += [(1000 + i, BASE, 5 + i % 2) for i in range(15)] + [(1100, BASE, 5)]  # ties
ROWS += [(900, BASE, 5), (900, BASE, 5), (900, CLOSE[0], 5), (None, BASE, 5), (None, BASE, 1)]
ROWS += [(4900 + 7 * i, [x * 2 for x in BASE], label) for i, label in enumerate((-1, -10, -11, 9, 2**31 - 1))]
ROWS += [(2000, None, 1), (2001, BASE, None), (2002, [None, *BASE[1:]], 1), (2003, [math.nan, *BASE[1:]], 1), (2004, [math.inf, *BASE[1:]], 1)]
ROWS += [(3000, [], 1), (3001, [], 1), (3002, [], 2), (3100, BASE[:9], 1), (3101, BASE[:9], 1), (3102, CLOSE[1][:9], 2)]
ROWS += [(3200 + i, [3e14 * (i + 1), -7e13, 1.0], i % 3) for i in range(6)]


def brute(rows):
    """All answers as sorted tuples."""
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        part.append((i, [math.floor(256 * x) for x in v], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (anchor, a, label) in enumerate(part):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, c, strict=True)), i, other) for j, (i, c, other) in enumerate(part) if j != k and len(c) == len(a)]
        positives = sorted((s for s in scored if s[2] == label), key=order)[:5]
        for p, i, _ in positives:
            fit = sorted((s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:5]
            out += [(anchor, i, n, s[1], p, s[0]) for n, s in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [None, 64])
def test_equals_all_inner_products(spark, parts, monkeypatch):
    if parts:  # many blocks and chunks
        monkeypatch.setattr(negatives, "BLOCK_PARTS", parts)
        monkeypatch.setattr(negatives, "CHUNK_PARTS", parts)
    table = spark.createDataFrame([(*r, "x", 1) for r in ROWS], DDL).repartition(3)
    found = negatives.hard_negatives(table)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(ROWS)
    assert len(want) > 100 and sorted(map(tuple, found.collect()), key=str) == want


def test_several_blocks_and_chunks_a_task(spark, monkeypatch):
    for name, value in (("BLOCK_PARTS", 64), ("CHUNK_PARTS", 64), ("BLOCK_TASKS", 1), ("CHUNK_TASKS", 2)):
        monkeypatch.setattr(negatives, name, value, raising=False)
    table = spark.createDataFrame([(*r, "x", 1) for r in ROWS], DDL).repartition(3)
    assert sorted(map(tuple, negatives.hard_negatives(table).collect()), key=str) == brute(ROWS)


def test_nothing_is_broadcast(spark, monkeypatch):
    """Spark takes anchors x blocks, by the file of the anchors, for a table that the driver can hold."""
    plans, staged = [], negatives.staged

    def seen(df, *label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df if not label else staged(df, *label)

    monkeypatch.setattr(negatives, "staged", seen)
    seen(negatives.hard_negatives(spark.createDataFrame([(*r, "x", 1) for r in ROWS], DDL)))
    assert len(plans) > 1 and not any("Broadcast" in plan for plan in plans)


def test_products_of_any_size():
    generator = np.random.default_rng(5)
    for size, most in ((1, 3), (8, 200), (13, 40_000), (24, 2**40), (64, 160)):
        a, c = (generator.integers(-most, most, (n, size), endpoint=True) for n in (5, 70))
        assert (negatives.inner_products(negatives.subset_sums(a), negatives.planes_of(c)) == c @ a.T).all()  # both wrap alike


def test_empty(spark):
    table = spark.createDataFrame([], DDL)
    assert negatives.hard_negatives(table).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(None, None, None, None, None)], DDL)).collect() == []
