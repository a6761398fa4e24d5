"""Price streams: daily bars from ticks, and running averages that follow bars as they arrive."""

import datetime as dt

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scoreloom.functions import clock
from scoreloom.operators.indicators import FAST_DAYS, RSI_DAYS, SIGNAL_DAYS, SLOW_DAYS, TREND_DAYS

FOLLOWED = ["Close", "RSI_14", "MACD", "MACD_signal", "EMA_20"]
EPOCH, NO_DAY = dt.date(1970, 1, 1), -(2**31)  # NO_DAY: a bar without a day
PACKED = 200_000  # bars a task packs at once
#: One row per company and batch; the elements of the arrays are its bars, and at the end, if `dropped` is above 0, what was left out.
FOLLOWED_PACKED = f"isin string, day array<int>, {', '.join(f'{c} array<double>' for c in FOLLOWED)}, dropped array<long>"
RUNNING = f"kind string, isin string, Date date, {', '.join(f'{c} double' for c in FOLLOWED)}, dropped long"
STATE = (
    "n long, day date, last double, fast double, slow double, trend double, signal double, gains double, losses double"
)


def daily_bars(ticks: DataFrame, order: list | None = None) -> DataFrame:
    """OHLCV bars of one UTC day from ticks (isin, ts, price, quantity); batch or stream.

    `order` breaks ties of `ts`.  Ticks shrink to one partial bar per company and day on each map
    task before the exchange, so a company with a third of the ticks is no hot spot.  In a batch
    `ts` is a naive UTC time; a stream needs an instant with a watermark, and counts ticks that
    are late within it.
    """
    place = F.struct("ts", *(order or []))
    if ticks.isStreaming:
        day, date = F.window("ts", "1 day").alias("_day"), clock.utc_date(F.col("_day.start"))
    else:
        day, date = F.to_date("ts").alias("_day"), F.col("_day")
    grouped = ticks.groupBy("isin", day).agg(
        F.min_by("price", place).alias("Open"),
        F.max("price").alias("High"),
        F.min("price").alias("Low"),
        F.max_by("price", place).alias("Close"),
        F.sum("quantity").cast("bigint").alias("Volume"),
    )
    return grouped.select("isin", date.alias("Date"), "Open", "High", "Low", "Close", "Volume")


def with_open_days(written: DataFrame, ticks: DataFrame, order: list | None = None) -> DataFrame:
    """`written`, the bars a stream has closed, and the bars of the days after them from `ticks` (a batch).

    A stream writes a day once its watermark has passed it, so a run that ends keeps the last days in its state.
    """
    date = F.to_date("ts")
    closed = written.agg(F.max("Date")).scalar()
    return written.unionByName(daily_bars(ticks.where(date > F.coalesce(closed, F.lit("0001-01-01").cast("date"))), order))


def packed(bars: DataFrame) -> DataFrame:
    """(isin, days, closes): a company's bars of one partition as one row, or one for every PACKED bars; days since 1970 and closes as bytes.

    Spark hands the rows of a stateful step to Python one by one, so a row for each bar costs far more than the work on it.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows(held):
            table = pa.Table.from_batches(held)
            coded = table.column("isin").combine_chunks().dictionary_encode(null_encoding="encode")
            code = coded.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            days = table.column("Date").cast(pa.int32()).fill_null(NO_DAY).to_numpy().astype("<i4")[order]
            closes = table.column("Close").to_numpy().astype("<f8")[order]
            cuts = np.append(0, np.cumsum(np.bincount(code, minlength=len(coded.dictionary))))
            packs = [pa.array([v[i:k].tobytes() for i, k in zip(cuts[:-1], cuts[1:])], pa.binary()) for v in (days, closes)]
            return pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), *packs], names=["isin", "days", "closes"])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= PACKED:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return bars.repartition("isin").mapInArrow(run, "isin string, days binary, closes binary")


class RunningIndicators(StatefulProcessor):
    """Nine values of state per company; see `running_indicators`."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("running", STATE)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, the names Spark calls
        import numpy as np

        n, day, last, *carried = self.state.get() or (0, None, 0.0) + (0.0,) * 6
        days, closes = zip(*((row.days, row.closes) for row in rows))
        days, closes = np.frombuffer(b"".join(days), "<i4"), np.frombuffer(b"".join(closes), "<f8")
        order = np.lexsort((closes, days))
        given, newest, days = len(days), days.max(), days[order]
        kept = np.append(True, days[1:] != days[:-1]) & (days > ((day - EPOCH).days if n else NO_DAY))
        days, closes = days[kept], closes[order][kept]
        out, dropped = {c: np.zeros(0) for c in FOLLOWED}, np.zeros(len(days), np.int64)
        if len(days):
            out, state = _followed(n, last, carried, closes)
            self.state.update((n + len(days), EPOCH + dt.timedelta(int(days[-1])), *state))
        if given > len(days):  # one element for what this batch brought in vain
            days, dropped = np.append(days, newest), np.append(dropped, given - len(days))
            out = {c: np.append(out[c], np.nan) for c in FOLLOWED}
        yield Row(isin=key[0], day=days, **{c: out[c] for c in FOLLOWED}, dropped=dropped)

    def close(self) -> None:
        pass


def _followed(n: int, last: float, carried: list[float], close: "np.ndarray") -> tuple[dict, tuple]:
    """The indicators of further closes, and the state after them; `n` closes came before, the last one was `last`."""
    import numpy as np

    fast, slow, trend, signal, gains, losses = carried

    def average(values, alpha, before, begun):
        """Exponential averages; the one before, if any, counts as the first value."""
        out, held = np.empty(len(values)), before
        for k, value in enumerate(values.tolist()):
            held = held + alpha * (value - held) if begun or k else value
            out[k] = held
        return out

    number = n + np.arange(1, len(close) + 1)
    change = np.diff(close, prepend=last if n else close[0])
    fast, slow, trend = (average(close, 2 / (days + 1), before, n > 0) for days, before in
                         ((FAST_DAYS, fast), (SLOW_DAYS, slow), (TREND_DAYS, trend)))
    gains, losses = (average(np.maximum(part, 0), 1 / RSI_DAYS, before, n > 0) for part, before in ((change, gains), (-change, losses)))
    known = number >= SLOW_DAYS
    signals = np.full(len(close), signal)
    if known.any():
        signals[known] = average((fast - slow)[known], 2 / (SIGNAL_DAYS + 1), signal, n >= SLOW_DAYS)
    flat = losses == 0
    strength = np.where(flat, 100.0, 100 - 100 / (1 + gains / np.where(flat, 1.0, losses)))
    since = lambda days, values: np.where(number >= days, values, np.nan)
    values = {"Close": close, "RSI_14": since(RSI_DAYS, strength), "MACD": since(SLOW_DAYS, fast - slow),
              "MACD_signal": since(SLOW_DAYS + SIGNAL_DAYS - 1, signals), "EMA_20": since(TREND_DAYS, trend)}
    return values, tuple(float(x[-1]) for x in (close, fast, slow, trend, signals, gains, losses))


def running_indicators(bars: DataFrame) -> DataFrame:
    """RSI, MACD, its signal and EMA per bar, as bars stream in; nine values of state per company.

    A bar whose day is not after the company's last one is left out: a bar delivered again, or too
    late, would be counted as a new day.  Of bars of one day in one batch the lowest close stays.
    Rows of kind "bar" are those that count; a row of kind "dropped" says how many bars of a company
    a batch left out, with the newest day of that batch.  A bar without a day is left out.

    The state lives in RocksDB, which this kind of stream needs: the session setting is made here.
    """
    bars.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    followed = packed(bars.select("isin", "Date", "Close")).groupBy("isin").transformWithState(
        RunningIndicators(), FOLLOWED_PACKED, "append", "None")
    rows = followed.select("isin", F.inline(F.arrays_zip("day", *FOLLOWED, "dropped")))
    return rows.select(
        F.when(F.col("dropped") > 0, "dropped").otherwise("bar").alias("kind"), "isin",
        F.when(F.col("day") > NO_DAY, F.date_from_unix_date("day")).alias("Date"),
        *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in FOLLOWED), "dropped")
