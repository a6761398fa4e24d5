"""Registered queries next to their reference SQL; QUERIES=all runs every one."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
FAST = ["jn1_sco14_company_scores", "win2_set1_rss_articles", "snk4_merge_upsert", "snk7_insert_overwrite_month", "ind4_ind5_macd",
        "txt1_jn8_entity_link", "txt6_financial_context", "txt10_txt11_strict_insider_signals", "sc17_sco15_article_sentiment",
        "inc1_newer_than_target", "inc2_lookback_merge", "str1_running_indicators", "str2_stream_daily_bars", "src4_prj1_jn10_read_filings",
        "src6_sc18_extract_listing_rows", "set3_txt12_unseen_entries", "flt7_post_last_date_filter", "agg4_win8_exact_percentiles"]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()) if os.environ.get("QUERIES") == "all" else FAST)
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), FOLDER) == ""


def test_every_reference_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


def test_listing_pages_are_dealt_to_the_tasks(spark):
    """The table is one file, which one task would read; parsing a page costs much."""
    from catalogue import inputs, queries

    pages = queries.listing_pages(inputs.Inputs(spark, "/root/testdata/sf0.001"))
    assert pages.rdd.getNumPartitions() == 8 and pages.count() == pages.select("page").distinct().count()


def test_sorts_and_counts_get_more_tasks_with_more_rows(spark, con, monkeypatch):
    """6,000 price rows and 1,500 filings; eight shuffle partitions would hold 750 rows each."""
    from catalogue import inputs, queries
    from scoreloom import session

    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    i = inputs.Inputs(spark, "/root/testdata/sf0.001")
    rows = i.t("lineitem").count()
    assert i.tasks("lineitem") == -(-rows // 100) and i.tasks("nation") == 8
    assert queries.stocks(i).rdd.getNumPartitions() == i.tasks("lineitem")
    plan = queries.dq2_dq5_unique(i)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {i.tasks('lineitem')}), REPARTITION_BY_NUM") == 2 and f", {i.tasks('orders')}), REPARTITION_BY_NUM" in plan
    for name in ("q13_signal_heatmap", "dq2_dq5_unique"):
        assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == ""
