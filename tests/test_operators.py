
import contextlib
import dataclasses

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scoreloom.operators import keyed, quality, ranking
from scoreloom.operators.joins import lookup
from scoreloom.operators.ranking import exact_percentiles, percent_rank
from scoreloom.session import staged


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the values alike, some NULL, the rest spread over many magnitudes and signs."""
    u = F.rand(3)
    value = F.when(F.col("id") % 3 == 0, 1.5).when(F.col("id") % 50 == 1, None).otherwise(
        F.randn(4) * F.pow(F.lit(10.0), F.floor(u * 12) - 6))
    return staged(spark.range(30000).select("id", value.alias("v"), (u * u).alias("u")))


def test_distributed_percent_rank_equals_the_window(skewed):
    got = percent_rank(skewed, "v", "share")
    plain = got.withColumn("x", F.percent_rank().over(Window.orderBy("v")))
    assert got.count() == 30000
    assert plain.where("x <> share or share is null").count() == 0


def test_distributed_percentiles_equal_percentile(skewed):
    at = {"a": 0.05, "b": 0.5, "c": 0.95}
    got = exact_percentiles(skewed, ["v", "u"], at).first()
    want = skewed.agg(*[F.percentile(c, p).alias(f"{n}_{c}") for c in ("v", "u") for n, p in at.items()]).first()
    assert got.asDict() == pytest.approx(want.asDict(), rel=1e-12)


@pytest.fixture
def close_brackets(monkeypatch):
    """Brackets close although the table is small; how often they were narrowed."""
    rounds = []
    narrowed = ranking._narrowed
    monkeypatch.setattr(ranking, "MOST_INSIDE", 20)
    monkeypatch.setattr(ranking, "ACCURACY", 100)
    monkeypatch.setattr(ranking, "MARGIN", 0.02)
    monkeypatch.setattr(ranking, "_narrowed", lambda rows, brackets: (rounds.append(len(brackets)), narrowed(rows, brackets))[1])
    return rounds


AT = {"min": 0.0, "a": 0.05, "b": 0.5, "c": 0.95, "max": 1.0}


def percentiles_by_sorting(rows, columns, at=AT):
    return rows.agg(*[F.percentile(c, p).alias(f"{n}_{c}") for c in columns for n, p in at.items()]).first().asDict()


def test_brackets_close_around_the_position(skewed, close_brackets):
    got = ranking.percentile_values(skewed, ["v", "u"], AT)
    assert got == pytest.approx(percentiles_by_sorting(skewed, ["v", "u"]), rel=1e-12)
    assert len(close_brackets) >= 2 and close_brackets[0] == 10


def test_a_bracket_that_misses_is_widened(skewed, close_brackets, monkeypatch):
    honest, missed = ranking._narrowed, []

    def erring(rows, brackets):
        out = honest(rows, brackets)
        if len(missed) < 2:
            missed.append(True)
            return [dataclasses.replace(b, low=9e9, high=9.1e9) for b in out]
        return out

    monkeypatch.setattr(ranking, "_narrowed", erring)
    assert ranking.percentile_values(skewed, ["v", "u"], AT) == pytest.approx(percentiles_by_sorting(skewed, ["v", "u"]), rel=1e-12)
    assert len(missed) == 2


def test_percentiles_with_nan_infinities_and_few_values(spark, close_brackets):
    n = F.col("id")
    rows = staged(spark.range(3000).select(
        F.when(n % 5 == 0, float("nan")).when(n % 97 == 0, float("inf")).when(n % 89 == 0, float("-inf")).otherwise(n * 1.0).alias("x"),
        (n % 2).cast("int").alias("two"), F.lit(None).cast("double").alias("none"), F.lit(4.5).alias("one")))
    got = ranking.percentile_values(rows, ["x", "two", "none", "one"], {"a": 0.05, "b": 0.5, "z": 0.9})
    want = sorted(r.x for r in rows.collect() if r.x == r.x)
    assert [got["a_x"], got["b_x"]] == pytest.approx([want[149] + 0.95 * (want[150] - want[149]), (want[1499] + want[1500]) / 2])
    assert got["z_x"] != got["z_x"] and (got["a_two"], got["b_two"], got["z_two"]) == (0.0, 0.5, 1.0)
    assert got["b_none"] is None and got["a_one"] == 4.5


@contextlib.contextmanager
def shuffled_to(spark, n):
    """As many partitions, which stay as many."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in names]
    for k, v in zip(names, (n, "false")):
        spark.conf.set(k, v)
    yield
    for k, v in zip(names, before):
        spark.conf.set(k, v)


@pytest.mark.parametrize("partitions", [64, 4096])
def test_ranks_for_any_number_of_partitions(spark, partitions):
    """Values crowded at one end of an octave, beside one far outlier and one value of a third of the rows."""
    crowded = staged(spark.range(40000).select(
        F.when(F.col("id") == 0, 1.9).when(F.col("id") % 3 == 1, 1.5).otherwise(1.0 + F.pow(F.rand(5), F.lit(9)) * 1e-9).alias("v")))
    want = staged(crowded.withColumn("x", F.percent_rank().over(Window.orderBy("v"))))
    with shuffled_to(spark, partitions):
        got = percent_rank(crowded, "v", "share")
    assert got.count() == 40000
    assert got.groupBy("v").agg(F.min("share").alias("low"), F.max("share").alias("high")).join(
        want.groupBy("v").agg(F.max("x").alias("x")), "v").where("low = x and high = x").count() == want.select("v").distinct().count()


def test_a_frequent_value_fills_no_partition(spark, monkeypatch):
    laid = []
    monkeypatch.setattr(ranking, "staged", lambda df, label: laid.append(staged(df, label)) or laid[-1])
    rows = staged(spark.range(40000).select(F.when(F.col("id") % 3 == 0, 1.5).when(F.col("id") % 3 == 1, F.rand(1)).alias("v"), "id"))
    with shuffled_to(spark, 16):
        ranking.percent_rank(rows, "v", "share")
    placed = laid[0].groupBy("_part").count().agg(F.max("count"), F.count("*")).first()
    assert placed[1] == 16 and placed[0] < 2 * 40000 / 16


def test_percentiles_of_nothing_and_one(rows):
    one = exact_percentiles(rows("v double, w double", [(7.0, None)]), ["v", "w"], {"p": 0.05}).first()
    assert (one.p_v, one.p_w) == (7.0, None)
    assert percent_rank(rows("v double", [(7.0,)]), "v", "s").first().s == 0.0


def test_infinities_and_nan_rank_at_the_ends(rows):
    values = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 5e-324, -1.7e308, 1.7e308, None, 3.0, 3.0]
    got = percent_rank(rows("n int, v double", list(enumerate(values))), "v", "share")
    assert got.withColumn("x", F.percent_rank().over(Window.orderBy("v"))).where("x <> share or share is null").count() == 0
    assert got.count() == len(values)


def test_rank_plan_has_no_single_partition_sort_of_rows(skewed, monkeypatch):
    plans = []
    monkeypatch.setattr(ranking, "staged", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, label))
    plan = percent_rank(skewed, "v", "share")._jdf.queryExecution().executedPlan().toString()
    assert plans[0].count("Exchange") == 2 and plans[0].count("rangepartitioning") == 1 and "SinglePartition" not in plans[0]
    for line in plan.split("\n"):
        assert not ("Exchange SinglePartition" in line and "share" in line)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lookup_with_hot_and_null_keys(spark):
    left = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"))
    table = left.where("k is not null").select("k").distinct().where("k <> 'k1'").withColumn("n", F.length("k"))
    got = lookup(left, table, ["k"])
    want = left.join(table, "k", "left")
    assert got.count() == 20000
    assert got.select("id", "k", "n").exceptAll(want.select("id", "k", "n")).count() == 0


def test_first_per_key_limits_rows_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = keyed.newest_per_key(df, ["k"], "id")
    assert sorted(r.id for r in out.collect()) == [997, 998, 999]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_merge(rows):
    target = rows("k string, a int, keep string", [("x", 1, "p"), ("y", 2, "q"), (None, 3, "r")])
    source = rows("k string, a int", [("x", 10), ("z", 30), (None, 40)])
    both = {tuple(r) for r in keyed.merge(target, source, ["k"], ["a"]).collect()}
    assert both == {("x", 10, "p"), ("y", 2, "q"), (None, 3, "r"), ("z", 30, None), (None, 40, None)}
    known = {tuple(r) for r in keyed.merge(target, source, ["k"], ["a"], insert=False).collect()}
    assert known == {("x", 10, "p"), ("y", 2, "q"), (None, 3, "r")}


def test_merge_refuses_a_source_key_that_comes_twice(rows):
    target = rows("k string, a int", [("x", 1), (None, 2)])
    twice = rows("k string, a int", [("x", 5), ("x", 6)])
    with pytest.raises(Exception, match="comes twice"):
        keyed.merge(target, twice, ["k"], ["a"]).collect()
    fresh = rows("k string, a int", [("n", 5), ("n", 6), (None, 7), (None, 7)])  # nothing to match
    assert keyed.merge(target, fresh, ["k"], ["a"]).count() == 6


def test_merge_and_without_read_each_input_once(spark, rows, tmp_path):
    for name in ("target", "source"):
        rows("k string, a int", [("x", 1), (None, 2)]).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    for out in (keyed.merge(target, source, ["k"], ["a"]), keyed.without(target, source, ["k"])):
        assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2


def test_merge_overwrites_with_null(rows):
    target, source = rows("k string, a int", [("x", 1)]), rows("k string, a int", [("x", None)])
    assert keyed.merge(target, source, ["k"], ["a"]).first().a is None


def test_without_and_upsert_keep_null_keys(rows):
    df = rows("k string, v int", [("x", 1), ("y", 2), (None, 3)])
    seen = rows("k string", [("x",), ("x",), (None,)])
    assert {tuple(r) for r in keyed.without(df, seen, ["k"]).collect()} == {("y", 2), (None, 3)}
    assert {tuple(r) for r in keyed.without(df, seen, ["k"], uneven=True).collect()} == {("y", 2), (None, 3)}
    new = rows("k string, v int", [("y", 9), ("z", 8)])
    assert {tuple(r) for r in keyed.upsert(df, new, ["k"]).collect()} == {("x", 1), (None, 3), ("y", 9), ("z", 8)}


def test_quality_report(rows):
    df = rows("k string, s string, v double", [("a", "x", 1.0), ("a", "y", None), (None, None, 99.0)])
    rules = [quality.not_null("k"), quality.accepted_values("s", ["x"]), quality.accepted_range("v", 0, 10)]
    report = quality.check(df, rules, grain=["k"], floor=5)
    assert [tuple(r) for r in report.collect()] == [
        ("not_null(k)", "error", 1), ("accepted_values(s)", "error", 1), ("accepted_range(v)", "warn", 1),
        ("unique(k)", "error", 1), ("min_rows(5)", "error", 2)]
