import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scoreloom.plans import companies, composite, fundamentals, insiders, news, reports, serving
from scoreloom.session import staged
from tests.conftest import AS_OF


def financial_rows(spark, n=400):
    k = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("R"), k.cast("string")).alias("record_id"), F.concat(F.lit("I"), (k % 90).cast("string")).alias("isin"),
        F.concat(F.lit("T"), (k % 90).cast("string")).alias("ticker"), F.date_add(F.lit("2020-12-31").cast("date"), (k % 7 * 365).cast("int")).alias("date_cloture_exercice"),
        F.when(k % 5 != 0, (k * 37 % 101) / 3.0).alias("ca_growth"), F.when(k % 3 != 0, F.lit(8.0)).alias("marge_op"),
        ((k % 50 - 5) * 1000).cast("decimal(38,9)").alias("ca"), (k % 40 - 10).cast("decimal(38,9)").alias("ebitda"),
        F.when(k % 4 != 0, k % 333).cast("decimal(38,9)").alias("dette_nette"), (k % 77).cast("decimal(38,9)").alias("fcf"),
        F.lit("s").alias("source"), F.lit("f").alias("financial_signal_run_id"), F.lit(1).alias("llm_prompt_version_num"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=k)).alias("extracted_at"),
    )


def scored_rows(spark):
    ratios = staged(fundamentals.ratios(financial_rows(spark)))
    return staged(fundamentals.z_scores(fundamentals.winsorised(ratios, 0.05, 0.95)))


def test_financials_rank_as_the_window_does(spark):
    got = staged(fundamentals.financials_score(scored_rows(spark), AS_OF))
    assert got.count() > 100
    # ranks by the rounded composite: equal but for values that rounding ties
    plain = got.withColumn("x", F.percent_rank().over(Window.orderBy("z_composite")) * 10)
    assert plain.where("abs(x - score_fondamental) > 0.2").count() == 0
    scores = got.agg(F.min("score_fondamental"), F.max("score_fondamental")).first()
    assert scores[0] == 0.0 and scores[1] <= 10.0


def test_no_spread_means_no_z_score(spark):
    got = fundamentals.financials_score(scored_rows(spark), AS_OF)
    assert got.where("z_marge_op is not null").count() == 0  # the margin never varies
    assert got.where("nb_metrics < 2").count() == 0


def test_newer_prompt_survives_a_late_older_run(rows):
    ddl = "record_id string, llm_prompt_version string, extracted_at timestamp_ntz, extraction_status string"
    full = {"isin": "I", "ticker": "T", "source_url": "u", "pdf_gcs_uri": "p", "date_cloture_exercice_raw": "2023-12-31", "ca_raw": "1 EUR", "ca_growth_raw": "2 %",
            "ebitda_raw": None, "marge_op_raw": None, "dette_nette_raw": None, "fcf_raw": None, "parser_used": "p", "llm_model": "m", "source": "s", "source_run_id": "r", "financial_signal_run_id": "f"}

    def staging(data):
        df = rows(ddl, data).withColumn("document_publication_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
        return df.withColumns({k: F.lit(v).cast("string") for k, v in full.items()})

    target = fundamentals.financial_signal(staging([("R1", "v10", dt.datetime(2024, 1, 10), "success")]), AS_OF)
    late = staging([("R1", "v9", dt.datetime(2024, 1, 11), "success"), ("R2", "v1", dt.datetime(2024, 1, 2), "success"), ("R3", "v1", dt.datetime(2024, 1, 4), "success"),
                    ("R4", "v1", dt.datetime(2024, 1, 9), "empty_text")])
    got = {r.record_id: r.llm_prompt_version_num for r in fundamentals.financial_signal(late, AS_OF, target=target).collect()}
    assert got == {"R1": 10, "R3": 1}  # R2 lies before the week that is read again


def test_insider_score(rows):
    ddl = "isin string, societe string, date_signal string, type_operation string, dirigeant string, source_record_id string, montant double"
    data = [("I", "S", "2024-01-05", "Achat", "B", "r1", 999.0), ("I", "S", "2024-01-05", "Achat", "A", "r1", 0.0), ("I", "S", "2024-01-05", "Achat", "B", "r2", 9000.0),
            ("I", "S", "2024-01-05", "Vente", "C", "r3", 5.0), ("J", "S", "2024-01-05", "Achat", "A", "r4", 0.0), ("K", "S", "2024-01-05", "Achat", "A", "r5", -1.0), ("L", "S", "2024-01-05", "Achat", "A", "r6", 1e12)]
    got = {r.isin: r for r in insiders.score_insider(rows(ddl, data)).collect()}
    assert (got["I"].insider_names, got["I"].num_operations, got["I"].total_amount) == ("A, B", 2, 9999.0)
    assert got["I"].raw_score == pytest.approx(math.log10(10000) * 1.5) and got["I"].score_1_10 == 10.0
    assert got["J"].score_1_10 == 1.0 and got["L"].score_1_10 == 10.0
    assert got["K"].raw_score is None and got["K"].score_1_10 is None


def test_news_score(rows):
    ddl = "isin string, ticker_bourso string, matched_name string, published_at timestamp_ntz, sentiment_score long"
    data = [(f"I{n}", "t", "m", AS_OF - dt.timedelta(days=d), s) for n, d, s in [(0, 1, 2), (0, 2, 3), (1, 45, 9), (2, 46, 0), (3, 3, 9), (4, 1, 5)]]
    got = {r.isin: (r.mention_count_45d, r.avg_sentiment_45d, r.investment_score) for r in news.score_news(rows(ddl, data), AS_OF).collect()}
    assert got == {"I0": (2, 2.5, 1), "I4": (1, 5.0, 4), "I1": (1, 9.0, 7), "I3": (1, 9.0, 7)}


def test_composite_defaults_and_windows(rows):
    day = dt.date(2024, 1, 31)
    snapshots = rows("name string, isin string, ticker_bourso string, snapshot_date date", [("Old", "A", "a", dt.date(2023, 1, 1)), ("New", "A", "a", day), ("B", "B", "b", day)])
    n = rows("isin string, investment_score long, score_date date", [("A", 10, day), ("A", 1, dt.date(2023, 1, 1))])
    s = rows("isin string, score_technique double, is_latest boolean, date date", [("A", 8.0, True, day), ("A", 1.0, False, day)])
    i = rows("isin string, score_1_10 double, signal_date date", [("A", 10.0, dt.date(2023, 12, 17)), ("B", 10.0, dt.date(2023, 12, 16))])
    f = rows("isin string, score_fondamental double, date_cloture_exercice date", [("A", 2.0, day), ("A", 9.0, dt.date(2020, 1, 1))])
    got = {r.isin: r for r in composite.company_scores(snapshots, n, s, i, f, AS_OF).collect()}
    assert (got["A"].name, got["A"].score_news, got["A"].score_stock, got["A"].score_insider, got["A"].score_financials) == ("New", 10.0, 8.0, 10.0, 2.0)
    assert got["A"].composite_score == 7.5 and got["B"].composite_score == 5.0 and got["B"].score_date == day


def test_companies(rows):
    raw = rows("name string, isin string, ticker_bourso string", [(" B ", " fr1 ", " t "), ("A", "FR1", "u"), ("C", " ", "x"), ("D", None, "x")])
    assert [tuple(r) for r in companies.companies(raw, AS_OF).collect()] == [("A", "FR1", "u", dt.date(2024, 1, 31))]


def test_serving_arguments(rows):
    stocks = rows("isin string, date date, company_name string, score_technique double, score_7d_avg double", [("FR0000120271", dt.date(2024, 1, 30), "A", 1.0, 1.0), ("FR0000120271", dt.date(2023, 12, 1), "A", 1.0, 1.0)])
    assert serving.score_history(stocks, ["FR0000120271"], AS_OF, 30).count() == 1
    for isins, days in ((["fr0000120271"], 30), (["FR0000120271' OR 1=1"], 30), (["FR0000120271"], 0), (["FR0000120271"], 366)):
        with pytest.raises(ValueError):
            serving.score_history(stocks, isins, AS_OF, days)


def test_histogram_and_kpis(rows):
    scores = rows("name string, composite_score double", [("A", 0.0), ("B", 10.0), ("C", 6.0), ("D", 3.99)])
    bins = {r.bin: (r.bin_start, r.zone, r.companies) for r in reports.score_histogram(scores, "composite_score", 6).collect()}
    assert bins == {0: (0.0, "caution", 1), 7: (3.5, "caution", 1), 12: (6.0, "opportunity", 1), 19: (9.5, "opportunity", 1)}
    assert reports.composite_kpis(scores).first()[:] == (4, pytest.approx(4.9975), 2, "B", 10.0)
