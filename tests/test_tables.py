import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom import schemas
from scoreloom.functions import clock
from scoreloom.plans import companies, filings
from scoreloom.sources import readers, writers
from scoreloom.streaming import bars as bar_streams
from scoreloom.streaming import incremental
from tests.conftest import AS_OF


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_referential(spark, tmp_path):
    path = write(tmp_path / "ref.csv", "name,ticker_bourso,isin\nA,1rPA,FR0010557264\nB,1rPB,\nC,1rPC,TOOSHORT\nD,1rPD,TOOLONGXXXXXXXXXXXXX\nA BIS,x,FR0010557264\n")
    assert [(r.name, r.isin) for r in readers.read_referential(spark, path).collect()] == [("A", "FR0010557264")]


def test_targets(spark, tmp_path):
    path = write(tmp_path / "t.csv", "isin,ticker_bourso,name\nFR0000120271,,A\nfr0000120271,1rPAAA,A\nFR0000120271,LATER,A\nUS0378331005,AAPL,B\nINVALID,BAD,C\n,EMPTY,D\nGB0002634946,,E\n")
    got = {r.isin: r.ticker for r in readers.read_targets(spark, path).collect()}
    assert got == {"FR0000120271": "1rPAAA", "US0378331005": "AAPL", "GB0002634946": None}


@pytest.mark.parametrize("header, missing", [("foo,ticker_bourso", "isin"), ("isin,name", "ticker_bourso")])
def test_targets_need_their_columns(spark, tmp_path, header, missing):
    with pytest.raises(ValueError, match=f"CSV must contain an '{missing}' column"):
        readers.read_targets(spark, write(tmp_path / "t.csv", f"{header}\na,b\n"))


def test_company_list_and_overrides(spark, tmp_path):
    assert readers.read_company_list(spark, str(tmp_path / "none.csv")).count() == 0
    got = readers.read_company_list(spark, write(tmp_path / "c.csv", " Name ,ISIN\nA,B\n"))
    assert got.select("name", "isin").first() == ("A", "B")
    assert readers.read_overrides(spark, str(tmp_path / "none.json")).count() == 0
    found = readers.read_overrides(spark, write(tmp_path / "o.json", '{\n "FR0013295789": "TFF.PA"\n}\n'))
    rows = spark.createDataFrame([("FR0013295789",), ("FR0014005HJ9",), ("FR0000000000",)], "isin string")
    resolver = spark.createDataFrame([("FR0014005HJ9", "OVH.PA"), ("FR0013295789", "no"), ("FR0000000000", "")], "isin string, ticker string")
    resolved = {r.isin: r.yf_ticker for r in companies.resolve_ticker(rows, found, resolver).collect()}
    assert resolved == {"FR0013295789": "TFF.PA", "FR0014005HJ9": "OVH.PA", "FR0000000000": None}


def test_filings_from_json_lines(spark, tmp_path):
    record = lambda i, isin, name: json.dumps({"recordid": i, "identificationsociete_iso_nom_soc": name, "identificationsociete_iso_cd_isi": isin, "uin_dat_amf": "2025-01-31"})
    lines = [record("id-1", "FR0000120271", "ACME"), record("id-1", "FR0000120271", "ACME DUP"), "{broken", record("id-2", "us0378331005", "APPLE"),
             record("id-3", "BE0000000001", "OUT"), record(" ", "FR0000120271", "BLANK"), record(None, "FR0000120271", "BLANK")]
    path = write(tmp_path / "f.jsonl", "\n".join(lines))
    targets = spark.createDataFrame([("FR0000120271", "1rPACME"), ("US0378331005", "AAPL")], "isin string, ticker string")
    raw, clean = readers.read_filings(spark, path, targets, "run-1", AS_OF)
    got = sorted((r.record_id or "", r.societe, r.ticker, r.publication_ts) for r in clean.collect())
    day = dt.datetime(2025, 1, 31)
    assert got == [("", "BLANK", "1rPACME", day), (" ", "BLANK", "1rPACME", day), ("id-1", "ACME", "1rPACME", day), ("id-2", "APPLE", "AAPL", day)]
    assert raw.count() == 4 and clean.first().source == "amf"
    assert readers.filing_line_counts(readers.read_raw_filings(spark, path)).first() == (7, 1, 5)
    assert set(clean.columns) <= set(schemas.schema("bronze", "filings").names)


def test_listing(spark):
    html = ("<table><tr><td>no</td></tr><tr data-ist='1rPA' class=x data-ist-init='{&quot;last&quot;: 3}'><td><a href='/other'>o</a>"
            "<a class=l href=\"/cours/1rPA/\"><b>Caf&eacute;</b>\n SA</a></td></tr><tr data-ist-init=\"\"><td> Alone </td></tr>"
            "<tr data-ist='' data-ist-init='x'><td><a href='https://x.example/cours/z'> </a></td></tr></table>")
    pages = spark.createDataFrame([("p", html)], "url string, html string")
    got = [(r.name, r.ticker_bourso, r.detail_url, r.last) for r in readers.parse_listing(pages, "https://l.example/a/").orderBy("position").collect()]
    assert got == [("Café SA", "1rPA", "https://l.example/cours/1rPA/", "3"), ("Alone", None, None, None), (None, None, "https://x.example/cours/z", None)]


def test_download_candidates(rows):
    ddl = "record_id string, isin string, publication_ts timestamp_ntz, pdf_url string, source string, run_id string, pdf_download_status string, pdf_http_status int"
    make = lambda i, status, code=None, isin="I", url="u", ts=dt.datetime(2024, 1, 1): (i, isin, ts, url, "s", "r", status, code)
    data = [make("a", None), make("b", "failed", ts=None), make("c", "empty_file", ts=dt.datetime(2024, 2, 1)), make("d", "http_error"), make("e", "http_error", 500),
            make("f", "http_error", 404), make("g", "http_error", 410), make("h", "success"), make("i", "invalid_content_type"), make("j", None, isin=None), make("k", None, url=None)]
    got = [r.record_id for r in filings.download_candidates(rows(ddl, data)).collect()]
    assert got == ["c", "a", "d", "e", "b"]
    assert filings.download_candidates(rows(ddl, data), limit=2).count() == 2


def test_conform(rows):
    df, wanted = rows("a int, b string", [(1, "x")]), T.StructType.fromDDL("b string, a bigint, c double")
    assert writers.conform(df, wanted).collect()[0].asDict() == {"b": "x", "a": 1, "c": None}
    with pytest.raises(ValueError, match="missing"):
        writers.conform(df, wanted, "fail")
    assert writers.conform(df, T.StructType.fromDDL("a int, b string"), "fail").count() == 1


def test_month_rewrite_leaves_other_months(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "months"), "isin string, Date date, v int"
    old = [("A", dt.date(2023, 12, 5), 1), ("A", dt.date(2024, 1, 5), 1), ("B", dt.date(2024, 1, 6), 1)]
    writers.overwrite_months(rows(ddl, old), path, "Date", ["isin"])
    writers.overwrite_months(rows(ddl, [("A", dt.date(2024, 1, 5), 2)]), path, "Date", ["isin"])
    assert sorted((r.isin, r.Date, r.v) for r in spark.read.parquet(path).collect()) == [("A", dt.date(2023, 12, 5), 1), ("A", dt.date(2024, 1, 5), 2)]


KEYED = "k string, v int"


def files_of(path):
    """bucket -> its data files, by name"""
    return {f.name: sorted(x.name for x in f.glob("*.parquet")) for f in path.glob("_bucket=*")}


def test_a_merge_touches_only_the_folders_of_its_keys(spark, rows, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(KEYED), ["k"], buckets=16)
    assert table.read().count() == 0
    table.upsert(rows(KEYED, [(f"k{n}", n) for n in range(200)]))
    before = files_of(tmp_path / "t")
    assert len(before) == 16
    table.upsert(rows(KEYED, [("k7", -7), ("new", 1)]))
    after = files_of(tmp_path / "t")
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and set(before) <= set(after)
    want = {f"k{n}": n for n in range(200)} | {"k7": -7, "new": 1}
    assert dict(map(tuple, table.read().collect())) == want
    table.merge(rows("k string, v int", [("k8", -8), ("newer", 2)]), ["v"], insert=False)
    table.upsert(rows(KEYED, []))
    assert dict(map(tuple, table.read().collect())) == want | {"k8": -8}
    near = table.rows_near(rows(KEYED, [("k9", 0)]))
    assert 1 <= near.count() < 60 and near.where("k = 'k9'").count() == 1
    scan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "_bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
    table.write(rows(KEYED, [("only", 1)]))
    assert [tuple(r) for r in table.read().collect()] == [("only", 1)]


def test_keyed_table_with_null_keys_and_other_columns(spark, rows, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL("a string, b int, v int"), ["a", "b"], buckets=4)
    table.upsert(rows("b int, a string, extra int", [(1, "x", 0), (None, "x", 0), (None, "x", 0)]))
    table.upsert(rows("a string, b int, v int", [("x", 1, 5), ("x", None, 6), (None, None, 7)]))
    got = sorted(map(str, table.read().collect()))
    assert got == sorted(map(str, rows("a string, b int, v int", [("x", 1, 5), ("x", None, None), ("x", None, None), ("x", None, 6), (None, None, 7)]).collect()))


def test_append_unseen_rewrites_no_file(spark, rows, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(KEYED), ["k"], buckets=4)
    table.write(rows(KEYED, [(f"k{n}", n) for n in range(50)]))
    before = files_of(tmp_path / "t")
    rows(KEYED, [("k1", 99), ("new", 1), ("new", 1), (None, 3)]).write.parquet(str(tmp_path / "in"))
    for checkpoint in ("cp", "again"):  # the second run finds its keys
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL(KEYED))
        incremental.append_unseen(stream, table, str(tmp_path / checkpoint), lambda df: df.where("k is not null").distinct())
    after = files_of(tmp_path / "t")
    assert all(set(before[b]) <= set(after[b]) for b in before)
    assert sorted(map(tuple, table.read().where("k = 'new' or k = 'k1'").collect())) == [("k1", 1), ("new", 1)] and table.read().count() == 51


def test_lookback_stream(spark, rows, tmp_path):
    """A record that arrives twice, one that lies beyond the lookback, a better and a worse version, and a batch run again."""
    ddl, at = "k string, version int, ts timestamp_ntz", lambda d: dt.datetime(2024, 1, d)
    table = writers.KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(ddl), ["k"], buckets=4)
    batches = [
        [("a", 1, at(10)), ("b", 5, at(20)), ("a", 1, at(10))],
        [("b", 5, at(20)), ("b", 4, at(21)), ("late", 1, at(12)), ("within", 1, at(14)), ("a", 2, at(15))],
        [("a", 9, at(2)), ("within", 1, at(14)), ("c", 1, at(22)), ("c", 2, at(19))],
    ]
    prepared = []
    for batch in batches:
        rows(ddl, batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL(ddl)).withColumn("event", clock.instant(F.col("ts")))
        incremental.lookback_stream(stream, table, str(tmp_path / "cp"), "event", "7 days", ["version", "ts"],
                                    lambda df: prepared.extend((r.k, r.version) for r in df.collect()) or df)
    got = {r.k: (r.version, r.ts.day) for r in table.read().collect()}
    assert got == {"a": (2, 15), "b": (5, 20), "within": (1, 14), "c": (2, 19)}
    assert prepared.count(("b", 5)) == 1 and prepared.count(("within", 1)) == 1 and ("late", 1) not in prepared and ("a", 9) not in prepared


def test_newest_snapshot_scans_one_folder(spark, rows, tmp_path):
    from scoreloom.plans import serving

    columns = "isin string, matched_name string, ticker_bourso string, mention_count_45d long, avg_sentiment_45d double, investment_score long, score_date date"
    row = lambda isin, score, day: (isin, "n", "t", 1, 5.0, score, dt.date(2024, 1, day))
    for day, score in ((1, 3), (2, 4), (2, 5), (1, 9)):  # a day is written again
        writers.write_snapshots(rows(columns, [row("A", score, day), row("B", score + 1, day)]), str(tmp_path / "s"), "score_date")
    got = serving.latest_news(spark.read.parquet(str(tmp_path / "s")))
    assert [(r.isin, r.investment_score, r.score_date.day) for r in got.collect()] == [("B", 6, 2), ("A", 5, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subqueries")[0]
    assert "score_date" in main.split("PartitionFilters: [")[1].split("]")[0] and "subquery" in main.split("PartitionFilters: [")[1].lower()


def test_counters_come_from_the_job_that_writes(spark, rows, tmp_path):
    from scoreloom.plans import reports

    status = ["success", "no_financial_data", "llm_error", None, "success"]
    batch = rows("run string, status string", [(f"r{n % 2}", s) for n, s in enumerate(status)] + [("other", "success")])
    got = reports.counted_write(batch, "run", "status", ["r0", "r1", "none"], str(tmp_path / "t"))
    want = reports.run_counters(batch.where("run <> 'other'"), "run", "status")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_catalog(spark, rows, tmp_path):
    writers.ensure_table(spark, "loom_catalog", T.StructType.fromDDL("a int"))
    writers.ensure_table(spark, "loom_catalog", T.StructType.fromDDL("a int, ticker string"))
    assert spark.table("loom_catalog").columns == ["a", "ticker"]
    assert ("default", "loom_catalog") in {tuple(r) for r in writers.overview(spark).collect()}
    spark.sql("DROP TABLE loom_catalog")


def test_paths_and_schemas():
    assert schemas.table_path("s3://root/", "gold", "score_news") == "s3://root/gold/score_news"
    for layer, tables in schemas.TABLES.items():
        for name in tables:
            assert schemas.schema(layer, name).fields


def test_running_indicators_over_batches_equal_the_batch_ones(spark, tmp_path):
    from scoreloom.operators.indicators import indicators
    from tests.test_prices import frame, walk

    pdf = frame({"A": walk(120, 1), "B": walk(70, 2)})
    for n, cut in enumerate([(0, 30), (30, 31), (31, 200)]):
        part = pdf[pdf.groupby("isin").cumcount().between(cut[0], cut[1] - 1)]
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL("isin string, Date date, Close double"))
        incremental.run_to_table(bar_streams.running_indicators(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("kind <> 'bar' or dropped <> 0").count() == 0
    want = indicators(spark.createDataFrame(pdf), AS_OF)
    both = got.alias("g").join(want.alias("w"), ["isin", "Date"])
    assert both.count() == len(pdf) == got.count()
    for name in ("RSI_14", "MACD", "MACD_signal", "EMA_20"):
        off = both.where((F.col(f"g.{name}").isNull() != F.col(f"w.{name}").isNull()) | (F.abs(F.col(f"g.{name}") - F.col(f"w.{name}")) > 1e-9))
        assert off.count() == 0, name


def test_running_indicators_leave_out_bars_delivered_again_or_late(spark, tmp_path):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    ddl = "isin string, Date date, Close double"
    clean = [("A", day(n), 10.0 + n % 7) for n in range(40)]
    batches = [clean[:30] + clean[5:6], clean[29:30] + [("A", day(3), 99.0)], [("A", day(12), 99.0)] + clean[30:]]

    dropped = []

    def streamed(parts, name):
        for part in parts:
            spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            stream = incremental.new_files(spark, str(tmp_path / name / "in"), T.StructType.fromDDL(ddl))
            incremental.run_to_table(bar_streams.running_indicators(stream), str(tmp_path / name / "out"), str(tmp_path / name / "cp"))
        rows = spark.read.schema(bar_streams.RUNNING).parquet(str(tmp_path / name / "out"))
        dropped.append([r.dropped for r in rows.where("kind = 'dropped'").orderBy("Date").collect()])
        rows = rows.where("kind = 'bar'").drop("kind", "dropped").orderBy("Date").collect()
        return [tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]

    got = streamed(batches, "dirty")
    assert len(got) == 40 and got == streamed([clean], "clean")
    assert got[-1][-1] is not None and got[0][-1] is None
    assert sorted(dropped[0]) == [1, 1, 2] and dropped[1] == []


def test_a_company_reaches_the_stateful_step_as_one_row(spark, monkeypatch):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    bars = [(name, day(n), float(n) if n % 5 else None) for n in range(50) for name in ("A", "B", None)] + [("A", None, 1.0)]
    rows = spark.createDataFrame(bars, "isin string, Date date, Close double").repartition(7)
    got = bar_streams.packed(rows).collect()
    assert sorted(str(r.isin) for r in got) == ["A", "B", "None"]
    assert sorted(len(r.days) for r in got) == [200, 200, 204] and all(len(r.closes) == 2 * len(r.days) for r in got)
    monkeypatch.setattr(bar_streams, "PACKED", 20)
    assert sum(len(r.days) for r in bar_streams.packed(rows).collect()) == 604


def test_bars_without_a_day_are_counted_not_followed(spark, tmp_path):
    ddl = "isin string, Date date, Close double"
    for part in ([("A", dt.date(2024, 1, 1), 1.0), ("A", None, 2.0)], [("A", None, 3.0), ("A", dt.date(2024, 1, 2), 4.0), ("B", None, 5.0)]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL(ddl))
        incremental.run_to_table(bar_streams.running_indicators(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    rows = spark.read.schema(bar_streams.RUNNING).parquet(str(tmp_path / "out")).collect()
    got = sorted((r.kind, r.isin, str(r.Date), r.Close, r.dropped) for r in rows)
    assert [g for g in got if g[0] == "bar"] == [("bar", "A", "2024-01-01", 1.0, 0), ("bar", "A", "2024-01-02", 4.0, 0)]
    assert [g for g in got if g[0] != "bar"] == [
        ("dropped", "A", "2024-01-01", None, 1), ("dropped", "A", "2024-01-02", None, 1), ("dropped", "B", "None", None, 1)]


def test_streamed_bars_wait_for_the_watermark_and_take_late_ticks(spark, tmp_path):
    ddl, at = "isin string, ts timestamp_ntz, price double, quantity long", lambda d, h: dt.datetime(2024, 1, d, h)
    batches = [[("A", at(1, 9), 1.0, 1), ("A", at(1, 23), 5.0, 1)], [("A", at(1, 22), 9.0, 1), ("A", at(2, 0), 2.0, 1)], [("A", at(3, 12), 3.0, 1)], [("A", at(1, 1), 99.0, 1)]]
    for batch in batches:
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL(ddl))
        ticks = stream.withColumn("ts", clock.instant(F.col("ts"))).withWatermark("ts", "2 hours")
        incremental.run_to_table(bar_streams.daily_bars(ticks), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = [(r.Date.day, r.Open, r.High, r.Low, r.Close, r.Volume) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("Date").collect()]
    assert got == [(1, 1.0, 9.0, 1.0, 5.0, 3), (2, 2.0, 2.0, 2.0, 2.0, 1)]
    everything = bar_streams.with_open_days(spark.read.parquet(str(tmp_path / "out")), spark.read.schema(ddl).parquet(str(tmp_path / "in")))
    assert [(r.Date.day, r.Close) for r in everything.orderBy("Date").collect()] == [(1, 5.0), (2, 2.0), (3, 3.0)]


def test_upsert_stream_is_repeatable(spark, rows, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL("k string, v int"), ["k"], buckets=4)
    for batch in ([("a", 1), ("b", 1)], [("b", 2)]):
        rows("k string, v int", batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL("k string, v int"))
        incremental.upsert_stream(stream, table, str(tmp_path / "cp"))
    again = incremental.new_files(spark, str(tmp_path / "in"), T.StructType.fromDDL("k string, v int"))
    incremental.upsert_stream(again, table, str(tmp_path / "cp"))
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]
