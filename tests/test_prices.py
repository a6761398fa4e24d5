import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators.indicators import INDICATORS, indicators, latest_indicators
from scoreloom.plans import prices
from tests.conftest import AS_OF


def walk(n, seed=42):
    close = np.abs(100 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))) + 1
    return close


def frame(series):
    parts = [pd.DataFrame({"isin": k, "Date": pd.date_range("1950-01-02", periods=len(v)).date, "Close": v}) for k, v in series.items()]
    return pd.concat(parts, ignore_index=True)


def expected(close):
    out = pd.DataFrame({"Close": close})
    mean = lambda s, n: s.ewm(span=n, min_periods=n, adjust=False).mean()
    out["EMA_20"], out["MACD"] = mean(out.Close, 20), mean(out.Close, 12) - mean(out.Close, 26)
    out["MACD_signal"] = mean(out.MACD, 9)
    change = out.Close.diff()
    up = change.where(change > 0, 0.0).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    down = (-change.where(change < 0, 0.0)).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    out["RSI_14"] = pd.Series(np.where(down == 0, 100, 100 - 100 / (1 + up / down))).where(down.notna())
    middle, sd = out.Close.rolling(20).mean(), out.Close.rolling(20).std(ddof=0)
    out["BB_upper"], out["BB_lower"] = middle + 2 * sd, middle - 2 * sd
    out["SMA_50"], out["SMA_200"] = out.Close.rolling(50).mean(), out.Close.rolling(200).mean()
    return out


def flat_then_moving(n):
    close = walk(n)
    close[300:3000] = close[300]
    return close


@pytest.fixture(scope="module")
def computed(spark):
    """Short series, one over several blocks, one that stands still for longer than a block."""
    series = {"A30": walk(30), "B250": walk(250), "C5000": walk(5000, 7), "D3500": flat_then_moving(3500), "E1": walk(1)}
    got = indicators(spark.createDataFrame(frame(series)), AS_OF).toPandas()
    return series, got.sort_values(["isin", "Date"])


@pytest.mark.parametrize("name", INDICATORS)
def test_indicators_equal_their_definition(computed, name):
    series, got = computed
    for isin, close in series.items():
        have, want = got[got["isin"] == isin][name].astype(float).to_numpy(), expected(close)[name].to_numpy()
        assert len(have) == len(close)
        assert (np.isnan(have) == np.isnan(want)).all()
        np.testing.assert_allclose(have, want, rtol=1e-9, atol=1e-9)


def test_bounds_and_flat_stretch(computed):
    _, got = computed
    assert got["RSI_14"].dropna().between(0, 100).all()
    assert (got["BB_upper"].dropna() >= got["BB_lower"].dropna()).all()
    assert (got["computed_at"] == AS_OF).all()
    still = got[got["isin"] == "D3500"].iloc[600:2900]
    assert (still["SMA_50"] == still["SMA_200"]).all() and (still["BB_upper"] == still["BB_lower"]).all()
    assert still["RSI_14"].nunique() < 60 and (still["RSI_14"].iloc[-1] < 99)  # the ratio survives the blocks


def test_one_exchange_and_no_python(spark):
    plan = indicators(spark.createDataFrame(frame({"A": walk(5)})).repartition(2), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_last_day_alone_equals_the_full_path(spark):
    """Series of every length around the indicators' lengths, one flat, one with bars out of order and a bad tick."""
    lengths = [1, 13, 14, 19, 20, 25, 26, 33, 34, 35, 49, 50, 199, 200, 201, 900]
    series = {f"S{n}": walk(n, n) for n in lengths} | {"FLAT": np.full(300, 7.7), "HALF": np.r_[walk(300), np.full(60, 7.7)]}
    pdf = frame(series).sample(frac=1.0, random_state=1)
    pdf.loc[pdf.index[pdf["isin"] == "S900"][5], "Close"] = float("nan")
    bars = spark.createDataFrame(pdf).repartition(5)
    last = bars.groupBy("isin").agg(F.max("Date").alias("Date"))
    want = {r.isin: r for r in indicators(bars, AS_OF).join(last, ["isin", "Date"], "left_semi").collect()}
    plan = latest_indicators(bars, AS_OF)
    got = {r.isin: r for r in plan.collect()}
    assert set(got) == set(series) and plan.columns == [*bars.columns, *INDICATORS, "computed_at"]
    for isin, row in got.items():
        for name in ("Date", "Close", *INDICATORS):
            assert row[name] == (pytest.approx(want[isin][name], rel=1e-9, abs=1e-9) if isinstance(want[isin][name], float) else want[isin][name]), (isin, name)
    assert "Window" not in plan._jdf.queryExecution().executedPlan().toString()


NEUTRAL = dict(Close=100.0, RSI_14=50.0, MACD=1.0, MACD_signal=1.0, BB_upper=110.0, BB_lower=90.0, SMA_50=100.0, SMA_200=100.0, EMA_20=100.0)
CASES = [
    ("rsi_signal", dict(RSI_14=34.99), 2), ("rsi_signal", dict(RSI_14=35.0), 1), ("rsi_signal", dict(RSI_14=64.99), 1),
    ("rsi_signal", dict(RSI_14=65.0), 0), ("rsi_signal", dict(RSI_14=None), 1), ("rsi_signal", dict(RSI_14=float("nan")), 1),
    ("macd_signal", dict(MACD=1.1), 2), ("macd_signal", dict(), 0), ("macd_signal", dict(MACD=0.9), 0),
    ("macd_signal", dict(MACD=None), 1), ("macd_signal", dict(MACD_signal=float("nan")), 1),
    ("golden_cross_signal", dict(SMA_50=101.0), 2), ("golden_cross_signal", dict(), 0), ("golden_cross_signal", dict(SMA_200=None), 1),
    ("bollinger_signal", dict(Close=93.9), 2), ("bollinger_signal", dict(Close=94.0), 1), ("bollinger_signal", dict(Close=106.0), 1),
    ("bollinger_signal", dict(Close=106.1), 0), ("bollinger_signal", dict(BB_upper=90.0), 1), ("bollinger_signal", dict(BB_lower=None), 1),
    ("bollinger_signal", dict(BB_upper=float("nan")), 1),
    ("trend_signal", dict(Close=100.1), 2), ("trend_signal", dict(), 0), ("trend_signal", dict(EMA_20=None), 1), ("trend_signal", dict(EMA_20=float("nan")), 1),
]


def test_signal_limits(spark):
    data = [(n, *[{**NEUTRAL, **change}[c] for c in NEUTRAL]) for n, (_, change, _) in enumerate(CASES)]
    ddl = "n int, " + ", ".join(f"{c} double" for c in NEUTRAL)
    got = {r.n: r for r in prices.signals(spark.createDataFrame(data, ddl)).collect()}
    for n, (signal, change, points) in enumerate(CASES):
        assert got[n][signal] == points, (signal, change)


def scored(spark, changes):
    data = [("I", "T", dt.date(2024, 1, 1) + dt.timedelta(days=n), *[{**NEUTRAL, **c}[k] for k in NEUTRAL]) for n, c in enumerate(changes)]
    ddl = "isin string, yf_ticker string, Date date, " + ", ".join(f"{c} double" for c in NEUTRAL)
    snapshots = spark.createDataFrame([("Other", "X", "t", dt.date(2024, 1, 1))], "name string, isin string, ticker_bourso string, snapshot_date date")
    return prices.stocks_score(spark.createDataFrame(data, ddl), snapshots).orderBy("date").collect()


def test_score_extremes_and_means(spark):
    best = dict(RSI_14=20.0, MACD=2.0, SMA_50=101.0, BB_upper=200.0, BB_lower=99.0, EMA_20=90.0)
    nothing = {k: None for k in NEUTRAL if k != "Close"}
    got = scored(spark, [best] * 7 + [nothing] * 8)
    assert [r.score_technique for r in got] == [10.0] * 7 + [5.0] * 8
    assert got[7].score_7d_avg == 9.3 and got[13].score_7d_avg == 5.0 and got[13].score_14d_avg == 7.5
    assert [r.is_latest for r in got] == [False] * 14 + [True]
    assert got[0].company_name == "T"


def test_clean_and_only_newer(rows):
    ddl = "isin string, Date date, Open double, High double, Low double, Close double, Volume long, yf_ticker string, ingested_at timestamp_ntz"
    day, later = dt.date(2024, 1, 30), dt.datetime(2024, 2, 1)
    bar = lambda isin, date, close, at: (isin, date, 1.0, 1.0, 1.0, close, 1, "t", at)
    raw = rows(ddl, [bar("A", day, 5.0, later), bar("A", day, 6.0, later + dt.timedelta(1)), bar("A", dt.date(2024, 2, 1), 7.0, later),
                     bar(None, day, 5.0, later), bar("B", day, 0.0, later), bar("C", dt.date(2023, 12, 31), 5.0, later)])
    got = {(r.isin, r.Close) for r in prices.clean_bars(raw, AS_OF).collect()}
    assert got == {("A", 6.0), ("C", 5.0)}
    assert {r.isin for r in prices.clean_bars(raw, AS_OF, incremental=True).collect()} == {"A"}
    stored = rows("isin string, Date date", [("A", day)])
    assert {(r.isin, r.Close) for r in prices.only_newer(raw, stored).collect()} == {("A", 7.0), (None, 5.0), ("B", 0.0), ("C", 5.0)}


def test_bad_ticks_stay_out_of_a_series(spark):
    import datetime as dt

    from scoreloom.operators.indicators import indicators
    from scoreloom.plans.prices import valid_price

    day = dt.date(2023, 1, 1)
    prices = [float("nan") if n == 5 else float("inf") if n == 7 else 100.0 + n % 7 for n in range(300)]
    bars = spark.createDataFrame([("A", day + dt.timedelta(n), p, p) for n, p in enumerate(prices)], "isin string, Date date, Open double, Close double")
    assert bars.where(valid_price()).count() == 298
    for rows in (bars, bars.where(valid_price())):
        last = indicators(rows, dt.datetime(2024, 1, 1)).orderBy("Date", ascending=False).first()
        assert all(abs(last[c]) < 1000 for c in ("SMA_50", "SMA_200", "EMA_20", "MACD", "RSI_14", "BB_upper"))
