"""Technical indicators of daily price series.

A series has at most one row per company and day, 366 a year, so a window over one company is
bounded by the calendar however uneven the raw data were.  All indicators share the exchange on
`isin`: moving averages are differences of running totals (constant work per row for any window
length), and exponential averages are decayed running totals cut into blocks, so that no step
needs a row-by-row loop outside the JVM.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions import clock

# The lengths the indicators are defined with.
RSI_DAYS, BAND_DAYS, BAND_WIDTH = 14, 20, 2
FAST_DAYS, SLOW_DAYS, SIGNAL_DAYS, TREND_DAYS = 12, 26, 9, 20
SHORT_MEAN, LONG_MEAN = 50, 200

INDICATORS = ["RSI_14", "MACD", "MACD_signal", "BB_upper", "BB_lower", "SMA_50", "SMA_200", "EMA_20"]

# 0.8 ** -BLOCK and its inverse are doubles; five blocks of the slowest average underflow, so older
# blocks cannot change a result.
BLOCK = 2048
BLOCKS_BACK = 5


def _series():
    return Window.partitionBy("isin").orderBy("Date")


def _span_decay(days: int) -> float:
    return 1 - 2 / (days + 1)


def decayed_sums(rows: DataFrame, inputs: dict[str, tuple[Column, float]]) -> DataFrame:
    """y(t) = decay * y(t-1) + input(t) along each series, for several inputs at once.

    Inside a block y = decay^k * sum(input / decay^k), a running total.  A block takes over the
    ends of the blocks before it, folded in order.  Rows need `Date`, `_n` (0, 1, ... per series),
    `_block`, `_k` (place in the block) and `_end` (last row of a full block).
    """
    so_far = Window.partitionBy("isin", "_block").orderBy("Date").rowsBetween(Window.unboundedPreceding, 0)
    earlier_blocks = Window.partitionBy("isin").orderBy("_block").rangeBetween(-BLOCKS_BACK, -1)
    local = {
        name: F.sum(term * F.pow(F.lit(1 / decay), F.col("_k"))).over(so_far) * F.pow(F.lit(decay), F.col("_k"))
        for name, (term, decay) in inputs.items()
    }
    inside = rows.withColumns({f"_{name}": c for name, c in local.items()})
    ends = F.collect_list(F.when(F.col("_end"), F.struct("_block", *[f"_{name}" for name in inputs])))
    inside = inside.withColumn("_ends", F.array_sort(ends.over(earlier_blocks)))

    def taken_over(name: str, decay: float) -> Column:
        carry = F.aggregate("_ends", F.lit(0.0), lambda y, end: y * F.lit(decay**BLOCK) + end[f"_{name}"])
        return F.col(f"_{name}") + carry * F.pow(F.lit(decay), F.col("_k") + 1)

    return inside.withColumns({name: taken_over(name, decay) for name, (_, decay) in inputs.items()}).drop(
        "_ends", *[f"_{name}" for name in inputs]
    )


def _average(value: Column, days: int, first_row: int = 0) -> tuple[Column, float]:
    """Input and decay of an exponential average whose first value is the series' own."""
    alpha = 2 / (days + 1)
    term = F.when(F.col("_n") == first_row, value).when(F.col("_n") > first_row, value * alpha).otherwise(0.0)
    return term, _span_decay(days)


def _once_seen(value: Column, rows: int) -> Column:
    return F.when(F.col("_n") >= rows - 1, value)


def _mean(days: int) -> Column:
    """Mean of the last `days` closes from running totals; a flat stretch gives its price exactly."""
    before = F.coalesce(F.lag("_total", days).over(_series()), F.lit(0.0))
    mean = F.col("_start") + (F.col("_total") - before) / F.lit(float(days))
    return _once_seen(F.when(F.col("_flat") >= days, F.col("Close")).otherwise(mean), days)


def indicators(bars: DataFrame, as_of: dt.datetime, tasks: int | None = None) -> DataFrame:
    """Add the eight indicators and `computed_at`; NULL until a series is long enough.

    `bars` holds one row per (isin, Date).  Rows whose close is NaN or infinite are left out.  `tasks`
    (see `session.tasks_for`) sets the tasks of the exchange on `isin`: several sorts of a task's rows are open at
    once, so a number that does not grow with the rows fills a task's memory.
    """
    running = _series().rowsBetween(Window.unboundedPreceding, 0)
    # a running total would carry one NaN or infinite price to the end of the series
    finite = bars.where(F.col("Close").isNull() | (F.abs("Close") < F.lit(float("inf"))))
    if tasks:
        finite = finite.repartition(tasks, "isin")
    rows = (
        finite.withColumn("_n", F.row_number().over(_series()) - 1)
        .withColumn("_last_close", F.lag("Close").over(_series()))
        .withColumn("_start", F.first("Close").over(running))
        .withColumn("_total", F.sum(F.col("Close") - F.col("_start")).over(running))
        .withColumn(
            "_flat",
            F.col("_n") + 1
            - F.max(F.when(F.col("_last_close").eqNullSafe(F.col("Close")), F.lit(0)).otherwise(F.col("_n"))).over(running),
        )
    )
    band = _series().rowsBetween(1 - BAND_DAYS, 0)
    flat_band = F.col("_flat") >= BAND_DAYS
    rows = rows.withColumns(
        {
            "SMA_50": _mean(SHORT_MEAN),
            "SMA_200": _mean(LONG_MEAN),
            "_middle": _mean(BAND_DAYS),
            "_spread": F.when(flat_band, F.lit(0.0)).otherwise(F.stddev_pop("Close").over(band)),
        }
    ).withColumns(
        {
            "BB_upper": _once_seen(F.col("_middle") + BAND_WIDTH * F.col("_spread"), BAND_DAYS),
            "BB_lower": _once_seen(F.col("_middle") - BAND_WIDTH * F.col("_spread"), BAND_DAYS),
            "_block": F.floor(F.col("_n") / BLOCK).cast("int"),
            "_k": F.col("_n") % BLOCK,
            "_end": F.col("_n") % BLOCK == BLOCK - 1,
        }
    )
    change = F.coalesce(F.col("Close") - F.col("_last_close"), F.lit(0.0))
    gain, loss = F.greatest(change, F.lit(0.0)), F.greatest(-change, F.lit(0.0))
    wilder = 1 / RSI_DAYS
    rows = decayed_sums(
        rows,
        {
            "fast": _average(F.col("Close"), FAST_DAYS),
            "slow": _average(F.col("Close"), SLOW_DAYS),
            "trend": _average(F.col("Close"), TREND_DAYS),
            "gains": (gain * wilder, 1 - wilder),
            "losses": (loss * wilder, 1 - wilder),
        },
    )
    rows = decayed_sums(rows, {"signal": _average(F.col("fast") - F.col("slow"), SIGNAL_DAYS, SLOW_DAYS - 1)})
    strength = F.when(F.col("losses") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.col("gains") / F.col("losses")))
    return rows.select(
        *bars.columns,
        _once_seen(strength, RSI_DAYS).alias("RSI_14"),
        _once_seen(F.col("fast") - F.col("slow"), SLOW_DAYS).alias("MACD"),
        _once_seen(F.col("signal"), SLOW_DAYS + SIGNAL_DAYS - 1).alias("MACD_signal"),
        "BB_upper",
        "BB_lower",
        "SMA_50",
        "SMA_200",
        _once_seen(F.col("trend"), TREND_DAYS).alias("EMA_20"),
        clock.at(as_of).alias("computed_at"),
    )


def latest_indicators(bars: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The last row of each company as `indicators` gives it, from one aggregation per company.

    Closes are gathered per company, partly on each map task, as an array in the order of days (the
    calendar bounds it) and folded once: no sort of rows and no windows.  Rows without a finite close
    are left out.
    """
    days = F.array_sort(F.collect_list(F.struct("Date", "Close")))
    finite = bars.where(F.abs("Close") < F.lit(float("inf")))
    others = [c for c in bars.columns if c not in ("isin", "Date", "Close")]
    rows = finite.groupBy("isin").agg(days.alias("_days"), F.max_by(F.struct(*bars.columns), "Date").alias("_bar"))
    closes, n = F.col("_closes"), F.size("_closes")
    wilder = 1 / RSI_DAYS

    def step(state: Column, close: Column) -> Column:
        def average(name: str, days: int) -> Column:
            return F.when(state["n"] == 0, close).otherwise(state[name] + (close - state[name]) * (2 / (days + 1)))

        change = F.when(state["n"] == 0, 0.0).otherwise(close - state["last"])
        spread = average("fast", FAST_DAYS) - average("slow", SLOW_DAYS)
        signal = F.when(state["n"] < SLOW_DAYS - 1, 0.0).when(state["n"] == SLOW_DAYS - 1, spread).otherwise(
            state["signal"] + (spread - state["signal"]) * (2 / (SIGNAL_DAYS + 1)))
        return F.struct(
            (state["n"] + 1).alias("n"), close.alias("last"),
            average("fast", FAST_DAYS).alias("fast"), average("slow", SLOW_DAYS).alias("slow"), average("trend", TREND_DAYS).alias("trend"),
            (state["gains"] * (1 - wilder) + F.greatest(change, F.lit(0.0)) * wilder).alias("gains"),
            (state["losses"] * (1 - wilder) + F.greatest(-change, F.lit(0.0)) * wilder).alias("losses"), signal.alias("signal"),
        )

    begin = F.struct(F.lit(0).alias("n"), *[F.lit(0.0).alias(k) for k in ("last", "fast", "slow", "trend", "gains", "losses", "signal")])
    rows = rows.withColumn("_closes", F.transform("_days", lambda d: d["Close"].cast("double"))).withColumn(
        "_end", F.aggregate("_closes", begin, step))
    end = {k: F.col(f"_end.{k}") for k in ("fast", "slow", "trend", "gains", "losses", "signal")}

    def since(value: Column, days: int) -> Column:
        return F.when(n >= days, value)

    def mean(days: int) -> Column:
        last = F.slice(closes, F.greatest(n - days + 1, F.lit(1)), days)
        flat = F.array_max(last) == F.array_min(last)
        return since(F.when(flat, F.element_at(closes, -1)).otherwise(F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / float(days)), days)

    band = F.slice(closes, F.greatest(n - BAND_DAYS + 1, F.lit(1)), BAND_DAYS)
    rows = rows.withColumn("_middle", mean(BAND_DAYS))
    squares = F.aggregate(band, F.lit(0.0), lambda a, x: a + (x - F.col("_middle")) * (x - F.col("_middle")))
    spread = F.when(F.array_max(band) == F.array_min(band), 0.0).otherwise(F.sqrt(squares / float(BAND_DAYS)))
    strength = F.when(end["losses"] == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + end["gains"] / end["losses"]))
    return rows.select(
        "isin", F.col("_bar.Date").alias("Date"), F.col("_bar.Close").alias("Close"), *[F.col(f"_bar.{c}").alias(c) for c in others],
        since(strength, RSI_DAYS).alias("RSI_14"),
        since(end["fast"] - end["slow"], SLOW_DAYS).alias("MACD"),
        since(end["signal"], SLOW_DAYS + SIGNAL_DAYS - 1).alias("MACD_signal"),
        (F.col("_middle") + BAND_WIDTH * spread).alias("BB_upper"),
        (F.col("_middle") - BAND_WIDTH * spread).alias("BB_lower"),
        mean(SHORT_MEAN).alias("SMA_50"),
        mean(LONG_MEAN).alias("SMA_200"),
        since(end["trend"], TREND_DAYS).alias("EMA_20"),
        clock.at(as_of).alias("computed_at"),
    ).select(*bars.columns, *INDICATORS, "computed_at")
