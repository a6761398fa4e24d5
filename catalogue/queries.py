"""Every operator as a query over the driver's tables.

A query's name starts with the id of the operator it exercises.  Both sides of a merge or an
anti-join are taken from whole tables by a column of the data (status, type, source).
"""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.inputs import AS_OF, Inputs, code, days, pick
from scoreloom import schemas
from scoreloom.functions import clock, numbers, text
from scoreloom.operators import documents, insider_answers, keyed, quality, ranking
from scoreloom.operators.entity_link import entity_link
from scoreloom.operators.indicators import INDICATORS, indicators, latest_indicators
from scoreloom.plans import (
    companies, composite, filings, fundamentals, insiders, news, prices, reports, serving,
)
from scoreloom.session import scratch_path, staged
from scoreloom.sources import readers, writers
from scoreloom.streaming import bars as bar_streams
from scoreloom.streaming import incremental

c = F.col
QUERIES = {}


def query(build):
    """Register `build(inputs)` under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Inputs(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and decimals as doubles, so that both engines print alike."""
    formats = {"date": "yyyy-MM-dd", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    columns = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        value = c(f"`{f.name}`")
        if kind in formats:
            value = F.date_format(value, formats[kind])
        elif kind == "decimal":
            value = value.cast("double")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: numbers.round_half_away(c(n), digits) for n in names})


# Tables several queries build on ----------------------------------------------------------------


def indicator_rows(i: Inputs) -> DataFrame:
    return indicators(i.bars(), AS_OF, tasks=i.tasks("lineitem"))


def stocks(i: Inputs) -> DataFrame:
    return prices.stocks_score(indicator_rows(i), i.snapshots())


def signal(i: Inputs) -> DataFrame:
    return fundamentals.financial_signal(i.staging(), AS_OF)


def financials(i: Inputs) -> DataFrame:
    return fundamentals.financials_score(staged(z_rows(i)), AS_OF)


def insider(i: Inputs) -> DataFrame:
    return insiders.score_insider(i.insider_table())


def news_scores(i: Inputs) -> DataFrame:
    return news.score_news(i.sentiment(), AS_OF)


def scores(i: Inputs) -> DataFrame:
    """Only each company's last day is wanted of the technical scores."""
    latest = prices.latest_stocks_score(latest_indicators(i.bars(), AS_OF))
    return composite.company_scores(i.snapshots(), news_scores(i), latest, insider(i), financials(i), AS_OF)


def kept_snapshots(df: DataFrame, score: str, label: str) -> DataFrame:
    """A table of daily snapshots: `df`, and an older day on which every company scored 1 less."""
    path = scratch_path(df.sparkSession, label)
    writers.write_snapshots(df.withColumns({score: c(score) - 1, "score_date": F.date_sub("score_date", 1)}), path, "score_date")
    writers.write_snapshots(df, path, "score_date")
    return df.sparkSession.read.parquet(path)


def article_parts(i: Inputs) -> list[DataFrame]:
    yahoo, google, site = i.feed_parts()
    tags = news.SOURCES
    return [news.feed_articles(yahoo, tags[0]), news.feed_articles(google, tags[1]), news.site_articles(site, tags[2])]


def articles(i: Inputs) -> DataFrame:
    return news.articles(article_parts(i))


def dealt(i: Inputs, df: DataFrame, key: str) -> DataFrame:
    """Rows by a digest of `key`, to as many tasks as the session shuffles to.

    The driver's tables are single files, which one task would read; what follows costs much per row.
    """
    return df.repartition(int(i.spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(key))


def written_csv(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.csv(path, header=True)
    return path


# Sources ----------------------------------------------------------------------------------------


def company_csv(i: Inputs) -> str:
    key = c("c_custkey")
    rows = i.t("customer").orderBy("c_custkey").select(
        c("c_name").alias("name"), F.concat(F.lit("T"), key.cast("string")).alias("ticker_bourso"),
        F.when(key % 11 == 0, None).when(key % 13 == 0, F.concat(F.lit("X"), key.cast("string")))
        .otherwise(code(F.floor(key / 3))).alias("isin"),
    )
    return written_csv(rows, "companies")


@query
def src1_read_referential(i):
    return readers.read_referential(i.spark, company_csv(i)).select("name", "isin")


@query
def src2_read_targets(i):
    key = c("c_custkey")
    rows = i.t("customer").orderBy("c_custkey").select(
        F.when(key % 2 == 0, F.concat(F.lit(" T"), key.cast("string"))).otherwise("  ").alias("ticker_bourso"),
        F.when(key % 7 == 0, "INVALID").otherwise(F.lower(code(F.floor(key / 3)))).alias("isin"),
    )
    return readers.read_targets(i.spark, written_csv(rows, "targets"))


@query
def src3_read_company_list(i):
    rows = i.t("supplier").select(
        c("s_name").alias(" Name "), code(c("s_suppkey")).alias("ISIN"), c("s_acctbal").cast("string").alias(" Balance")
    )
    return readers.read_company_list(i.spark, written_csv(rows, "list")).select("name", "isin", "balance")


def raw_filing_lines(i: Inputs) -> str:
    """JSON lines: every 97th broken, ids repeated in pairs, some blank, half the companies in scope."""
    k = c("o_orderkey")
    record = F.to_json(
        F.struct(
            F.when(F.floor(k / 2) % 25 == 0, " ").otherwise(F.concat(F.lit("R"), F.floor(k / 2).cast("string")))
            .alias("recordid"),
            F.concat(F.lit("Company "), c("o_custkey").cast("string")).alias("identificationsociete_iso_nom_soc"),
            i.owner(c("o_custkey")).alias("identificationsociete_iso_cd_isi"),
            F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(k % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .otherwise("unknown").alias("uin_dat_amf"),
            F.concat(F.lit("Filing "), k.cast("string")).alias("informationdeposee_inf_tit_inf"),
            c("o_orderpriority").alias("sous_type_d_information"), c("o_orderstatus").alias("type_d_information"),
            F.concat(F.lit("https://filings.example/"), k.cast("string")).alias("url_de_recuperation"),
        )
    )
    path = scratch_path(i.spark, "filings")
    lines = i.t("orders").orderBy("o_orderkey").select(F.when(k % 97 == 5, '{"recordid": ').otherwise(record).alias("value"))
    lines.write.text(path)
    return path


def filing_targets(i: Inputs) -> DataFrame:
    return i.t("supplier").where("s_acctbal > 4000").select(
        code(c("s_suppkey")).alias("isin"), F.concat(F.lit("T"), c("s_suppkey").cast("string")).alias("ticker")
    )


@query
def src4_prj1_jn10_read_filings(i):
    _, clean = readers.read_filings(i.spark, raw_filing_lines(i), filing_targets(i), "run-9", AS_OF)
    return clean


@query
def src4_filing_line_counts(i):
    return readers.filing_line_counts(readers.read_raw_filings(i.spark, raw_filing_lines(i)))


@query
def src5_jn9_resolve_ticker(i):
    """Overrides come from a JSON map file, as a hand-kept list of 25 would."""
    entry = F.struct(code(c("n_nationkey")), F.concat(F.lit("M"), c("n_nationkey").cast("string")))
    path = scratch_path(i.spark, "overrides")
    i.t("nation").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).coalesce(1).write.text(path)
    found = i.t("supplier").select(
        code(c("s_suppkey")).alias("isin"),
        F.when(c("s_acctbal") > 2000, F.concat(F.lit("T"), c("s_suppkey").cast("string"))).otherwise("").alias("ticker"),
    )
    rows = i.t("supplier").select(code(c("s_suppkey")).alias("isin"), c("s_name").alias("name"))
    return companies.resolve_ticker(rows, readers.read_overrides(i.spark, path), found)


def listing_pages(i: Inputs) -> DataFrame:
    """One page per customer: a company row with escaped figures, a repeat, and a row that is none."""
    key = c("c_custkey").cast("string")
    figures = F.when(
        c("c_custkey") % 3 == 0,
        F.format_string('{&quot;quote&quot;:{&quot;lastPrice&quot;:&quot;%s&quot;,&quot;volume&quot;:%s}}', c("c_nationkey"), key),
    ).when(
        c("c_custkey") % 3 == 1,
        F.format_string('x = {&quot;a&quot;:[{&quot;last&quot;:&quot;&quot;,&quot;price&quot;:&quot;%s&quot;}],&quot;high&quot;:%s};', c("c_nationkey"), key),
    ).otherwise("not json")
    ticker = F.when(c("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("1rP"), F.floor(c("c_custkey") / 2).cast("string")))
    row = F.concat(
        F.lit('<tr class="row" data-ist="'), ticker, F.lit('" data-ist-init="'), figures,
        F.lit('"><td><a href="/cours/'), key, F.lit('/"> <b>'), c("c_name"), F.lit("</b> &amp; Co </a></td></tr>"),
    )
    html = F.concat(F.lit("<html><body><table><tr><th>Name</th></tr>"), row, F.lit("<tr><td>none</td></tr>"), row,
                    F.lit("</table></body></html>"))
    rows = dealt(i, i.t("customer").select("c_custkey", "c_nationkey", "c_name"), "c_custkey")
    return rows.select(c("c_custkey").alias("page"), html.alias("html"))


LISTING_URL = "https://listing.example/bourse/actions/"


@query
def src6_sc18_extract_listing_rows(i):
    return readers.parse_listing(listing_pages(i), LISTING_URL)


@query
def set4_dedup_listing(i):
    rows = readers.parse_listing(listing_pages(i), LISTING_URL)
    return readers.first_listed(rows, [c("page"), c("position")]).select("page", "name", "ticker_bourso", "detail_url")


@query
def src7_sc19_isin_from_html(i):
    """The driver's pages, with a tagged heading or a mention in the text added to some."""
    key = code(c("page_id"))
    added = F.when(c("page_id") % 3 == 0, F.concat(F.lit('<p>XX9999999999</p><h2 class="a c-faceplate__isin b">ISIN '), key, F.lit("</h2>"))
                   ).when(c("page_id") % 3 == 1, F.concat(F.lit("<script>var x='ZZ0000000000'</script><p>see "), key, F.lit(".</p>"))
                          ).otherwise("<i>AB12</i>")
    html = F.concat(added, c("html"))
    return readers.isin_from_pages(i.t("pages").select("page_id", html.alias("html")))


# Sinks ------------------------------------------------------------------------------------------


@query
def snk1_append_fixed_schema(i):
    path, schema = scratch_path(i.spark, "append"), schemas.schema("silver", "ohlcv_clean")
    for name, part in (("early", c("Date") < "2020-01-01"), ("late", c("Date") >= "2020-01-01")):
        writers.append(i.bars().where(part).withColumn("batch", F.lit(name)), path, schema)
    stored = i.spark.read.schema(schema).parquet(path)
    return stored.groupBy("isin").agg(F.count(F.lit(1)).alias("days"), F.sum("Volume").alias("volume"))


@query
def snk2_append_by_category(i):
    path = scratch_path(i.spark, "category")
    rows = i.t("events").select("event_id", c("event_type").alias("category"), "value")
    writers.append_by_category(rows.where("value < 50"), path)
    writers.append_by_category(rows.where("value >= 50").withColumn("note", F.lit("high")), path)
    stored = writers.read_by_category(i.spark, path)
    return stored.groupBy("category").agg(F.count(F.lit(1)).alias("entries"), F.count("note").alias("notes"))


@query
def snk3_replace_table(i):
    path = scratch_path(i.spark, "replace")
    rows = i.bars().groupBy("isin").agg(F.count(F.lit(1)).alias("days"))
    writers.replace(rows.withColumn("days", F.lit(0).cast("bigint")), path)
    writers.replace(rows, path)
    return i.spark.read.parquet(path)


def stored_and_new_filings(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Stored: published before 2022 (or undated); new: published after 2020, with changed fields."""
    rows = i.filings()
    stored = rows.where(c("publication_ts").isNull() | (c("publication_ts") < "2022-01-01"))
    new = rows.where(c("publication_ts") >= "2020-01-01").withColumns(
        {"titre": F.concat(F.lit("New "), "titre"), "run_id": F.lit("run-3"), "pdf_download_status": F.lit("ignored")}
    )
    return stored, new


MERGED = ["record_id", "societe", "isin", "titre", "run_id", "pdf_download_status", "pdf_file_size_bytes"]


@query
def snk4_merge_upsert(i):
    return filings.merge_filings(*stored_and_new_filings(i)).select(*MERGED)


@query
def snk5_merge_update_only(i):
    return filings.merge_downloads(*stored_and_new_filings(i)).select(*MERGED)


def stored_and_new_articles(i: Inputs) -> tuple[DataFrame, DataFrame]:
    first, second, third = article_parts(i)
    return news.articles([first, second]), news.articles([second.withColumn("link", F.lit("again")), third])


ARTICLE = ["row_id", "title", "link", "isin", "fetched_at", "source", "published_at"]


@query
def snk6_incremental_merge(i):
    """A keyed table in folders, of which the merge rewrites those that the new articles fall into."""
    stored, new = stored_and_new_articles(i)
    table = writers.KeyedTable(i.spark, scratch_path(i.spark, "articles"), stored.schema, ["row_id"], buckets=16)
    table.write(stored)
    table.upsert(new)
    return table.read().select(*ARTICLE)


@query
def snk7_insert_overwrite_month(i):
    path = scratch_path(i.spark, "months")
    clean = staged(prices.clean_bars(i.raw_bars(), AS_OF, ties=i.bar_ties()))
    writers.overwrite_months(clean, path, "Date", ["isin"])
    latest = clean.where(prices.in_rewrite_months(AS_OF)).withColumn("Volume", c("Volume") + 1000)
    writers.overwrite_months(latest, path, "Date", ["isin"])
    stored = i.spark.read.parquet(path)
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("bars"), F.sum("Volume").alias("volume"))


@query
def snk8_dump_raw_run(i):
    root = scratch_path(i.spark, "dump")
    entries = i.feed_entries().select("event_id", "title", "isin", "link")
    writers.dump_run(entries, entries.where("isin is not null"), root, "2024-01-31T20-00-00Z")
    raw = i.spark.read.schema("event_id bigint, title string, isin string, link string, run_id string").json(f"{root}/raw")
    clean = i.spark.read.schema(raw.schema).json(f"{root}/clean")
    both = raw.withColumn("kind", F.lit("raw")).unionByName(clean.withColumn("kind", F.lit("clean")))
    return both.groupBy("kind", "run_id").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("title").alias("titles"))


@query
def snk9_export_csv_projected(i):
    path = scratch_path(i.spark, "export")
    rows = i.t("supplier").select(c("s_name").alias("name"), code(c("s_suppkey")).alias("isin"), c("s_acctbal").alias("unused"))
    writers.export_csv(rows, path, ["name", "ticker_bourso", "isin"])
    return i.spark.read.csv(path, header=True)


@query
def snk10_layout(i):
    path = scratch_path(i.spark, "layout")
    writers.write_clustered(i.filings().select("record_id", "isin", "run_id", "titre"), path, "run_id", ["isin", "record_id"])
    return i.spark.read.parquet(path)


@query
def snk11_ensure_table(i):
    name, path = f"loom_{uuid.uuid4().hex}", scratch_path(i.spark, "table")
    narrow = schemas.T.StructType.fromDDL("isin string, Date date, Close double")
    wide = schemas.T.StructType.fromDDL("isin string, Date date, Close double, Volume bigint")
    writers.ensure_table(i.spark, name, narrow, path)
    writers.append(i.bars().where("Date < '2020-01-01'"), path, narrow)
    writers.ensure_table(i.spark, name, wide, path)
    writers.append(i.bars().where("Date >= '2020-01-01'"), path, wide)
    i.spark.catalog.refreshTable(name)
    stored = i.spark.table(name)
    return stored.groupBy("isin").agg(F.count(F.lit(1)).alias("days"), F.sum("Volume").alias("volume"))


@query
def snk12_conform_schema(i):
    wanted = schemas.T.StructType.fromDDL("isin string, Date date, Volume double, note string")
    return writers.conform(i.bars(), wanted, "sync")


@query
def snk12_conform_fail(i):
    """The same columns in other types pass; a missing or unknown column raises, which a test covers."""
    wanted = schemas.T.StructType.fromDDL("Date string, isin string, Volume double")
    return writers.conform(i.bars().select("isin", "Date", "Volume"), wanted, "fail")


# Filters and projections ------------------------------------------------------------------------

BAR = ["isin", "Date", "Volume", "l_partkey"]


@query
def flt1_valid_price_filter(i):
    return i.raw_bars().where(prices.valid_price()).select(*BAR)


@query
def flt2_market_close_cutoff(i):
    """Half past five in the market's zone: today's bar is not final."""
    before_close = dt.datetime(2024, 1, 31, 16, 30)
    return i.raw_bars().where(prices.session_closed(before_close)).select(*BAR)


@query
def flt3_rolling_window_days(i):
    return i.sentiment().where(news.within_days("published_at", AS_OF, 20)).select("row_id", "published_at")


@query
def flt4_nonblank_key(i):
    return i.listing().where(text.nonblank(c("isin")))


@query
def flt5_pdf_retry_candidates(i):
    return filings.download_candidates(i.filings())


@query
def flt6_insider_title_filter(i):
    rows = insider_answers.insider_titles(i.filings(), AS_OF, insider_answers.STRICT)
    return rows.select("record_id", "titre", "publication_ts")


@query
def flt6b_jn5_insider_filings(i):
    rows = insider_answers.insider_filings(i.filings(), processed_signals(i), AS_OF, insider_answers.SCHEDULED, 15)
    return rows.select("record_id", "titre", "publication_ts")


def processed_signals(i: Inputs) -> DataFrame:
    return i.t("orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("R"), c("o_orderkey").cast("string")).alias("source_record_id")
    )


@query
def flt7_post_last_date_filter(i):
    rows = i.raw_bars()
    stored = rows.where(c("l_extendedprice") > 50000)
    return prices.only_newer(rows, stored).select(*BAR)


def z_rows(i: Inputs) -> DataFrame:
    return fundamentals.z_scores(fundamentals.winsorised(staged(fundamentals.ratios(signal(i))), 0.05, 0.95))


@query
def flt8_min_metrics(i):
    return z_rows(i).where("nb_metrics >= 2").select("ticker", "date_cloture_exercice", "nb_metrics")


@query
def flt9_active_prompt_version(i):
    return fundamentals.successful(i.staging(), "v3").select("record_id", "llm_prompt_version", "llm_prompt_version_num")


HISTORY = ["FR0000000000", "FR0000000003", "FR0000000007"]


@query
def flt10_q2_score_history(i):
    return serving.score_history(stocks(i), HISTORY, AS_OF, 365)


@query
def prj2_trim_upper_normalise(i):
    return i.listing().select(
        F.trim("name").alias("name"), F.upper(F.trim("isin")).alias("isin"), F.trim("ticker_bourso").alias("ticker_bourso")
    )


# Joins ------------------------------------------------------------------------------------------


@query
def jn1_sco14_company_scores(i):
    return scores(i)


@query
def jn2_label_fallback(i):
    return stocks(i).groupBy("isin", "company_name").agg(F.count(F.lit(1)).alias("days"))


def scored_articles(i: Inputs) -> DataFrame:
    return articles(i).where("source = 'yahoo_rss'").select("row_id")


@query
def jn3_inc6_anti_join_unscored(i):
    return news.unscored(articles(i), scored_articles(i)).select("row_id", "isin", "title", "published_at")


@query
def jn4_txt3_top7_relevant_documents(i):
    done = i.t("orders").select(
        F.concat(F.lit("R"), c("o_orderkey").cast("string")).alias("record_id"),
        F.when(c("o_orderstatus") == "F", "success").when(c("o_orderstatus") == "O", "llm_error")
        .otherwise("no_financial_data").alias("extraction_status"),
    )
    rows = documents.relevant_documents(i.filings(), done, AS_OF, days=400)
    return rows.select("record_id", "titre", "relevance_score", "threshold_score", "publication_ts")


@query
def jn6_sco8_winsorise(i):
    rows = fundamentals.winsorised(staged(fundamentals.ratios(signal(i))), 0.05, 0.95)
    out = rows.select("ticker", "date_cloture_exercice", *[f"{m}_w" for m in fundamentals.WEIGHTS])
    return rounded(out, 6, *[f"{m}_w" for m in fundamentals.WEIGHTS])


@query
def jn7_agg12_latest_run(i):
    rows = i.filings()
    return rows.where(c("run_id") == rows.agg(F.max("run_id")).scalar()).select("record_id", "run_id")


# Aggregations -----------------------------------------------------------------------------------


@query
def agg1_news_45d(i):
    return news.news_45d(i.sentiment(), AS_OF)


@query
def agg2_insider_daily(i):
    rows = insider(i).select("isin", "societe", "signal_date", "insider_names", "num_operations", "total_amount")
    return rounded(rows, 2, "total_amount")


@query
def agg3_last_date_per_isin(i):
    return prices.last_dates(i.bars())


@query
def agg4_win8_exact_percentiles(i):
    """Three columns of every line item."""
    rows = i.t("lineitem")
    columns = ["l_extendedprice", "l_quantity", "l_discount"]
    result = ranking.exact_percentiles(rows, columns, {"p05": 0.05, "p95": 0.95})
    return rounded(result, 6, *result.columns)


@query
def agg5_population_stats(i):
    rows = i.t("lineitem").agg(F.avg("l_quantity").alias("mu"), F.stddev_samp("l_quantity").alias("sd"))
    return rounded(rows, 6, "mu", "sd")


@query
def agg6_distinct_isins(i):
    return i.bars().select("isin").distinct().orderBy("isin")


@query
def agg7_run_counters(i):
    return reports.run_counters(i.staging(), "financial_signal_run_id", "extraction_status")


@query
def agg7_counted_write(i):
    """The counters come from the job that writes the attempts; the runs of a batch are known beforehand."""
    runs = [f"fs-{k}" for k in range(4)]
    return reports.counted_write(i.staging(), "financial_signal_run_id", "extraction_status", runs, scratch_path(i.spark, "attempts"))


@query
def agg8_composite_kpis(i):
    return rounded(reports.composite_kpis(scores(i)), 6, "mean_score")


@query
def agg9_technical_kpis(i):
    return rounded(reports.technical_kpis(serving.latest_scores(stocks(i))), 6, "pct_strong")


@query
def agg10_score_histogram(i):
    return reports.score_histogram(stocks(i), "score_technique", reports.STRONG)


@query
def agg11_freshness(i):
    return reports.freshness(
        {"stocks": (i.bars(), "Date"), "insiders": (insider(i), "signal_date"), "news": (i.sentiment(), "published_at"),
         "fundamentals": (signal(i), "date_cloture_exercice")}
    )


# Windows ----------------------------------------------------------------------------------------


@query
def win1_latest_per_key(i):
    return keyed.newest_per_key(insider(i), ["isin"], "signal_date", [c("societe")]).select("isin", "signal_date", "num_operations")


@query
def win2_clean_bars(i):
    return prices.clean_bars(i.raw_bars(), AS_OF, ties=i.bar_ties())


@query
def win2_set1_rss_articles(i):
    return articles(i)


@query
def win3_dedup_multi_order(i):
    best = fundamentals.best_version(fundamentals.successful(i.staging()))
    return best.select("record_id", "llm_prompt_version_num", "extracted_at", "financial_signal_run_id", "ca_raw")


@query
def win4_companies(i):
    return i.companies()


@query
def win5_sco6_stocks_score(i):
    return stocks(i)


@query
def win6_is_latest_flag(i):
    return stocks(i).where("is_latest").select("isin", "date", "is_latest")


@query
def win7_percent_rank_global(i):
    """Every event, ranked by its value."""
    ranked = ranking.percent_rank(i.t("events").select("event_id", "value"), "value", "share")
    return rounded(ranked, 8, "share")


@query
def win9_rank_column(i):
    return reports.numbered_top(financials(i), [F.desc("score_fondamental"), c("ticker"), c("date_cloture_exercice")], 10).select(
        "rank", "ticker", "date_cloture_exercice", "score_fondamental"
    )


# Rankings ---------------------------------------------------------------------------------------


@query
def top1_q8_top_companies(i):
    return serving.top_companies(scores(i), AS_OF.date(), 25)


@query
def top2_technical_ranking(i):
    latest = stocks(i).where("is_latest")
    columns = ["kind", "rank", "isin", "score_technique", "score_7d_avg"]
    best = reports.technical_ranking(latest).withColumn("kind", F.lit("top"))
    worst = reports.technical_ranking(latest, flop=True).withColumn("kind", F.lit("flop"))
    return best.select(*columns).unionByName(worst.select(*columns))


@query
def top3_news_ranking(i):
    order = [F.desc("investment_score"), F.desc("avg_sentiment_45d"), c("isin")]
    return reports.numbered_top(news_scores(i), order, 20).select("rank", "isin", "investment_score", "avg_sentiment_45d", "mention_count_45d")


@query
def top4_insider_ranking(i):
    order = [F.desc("signal_date"), F.desc("score_1_10"), c("isin")]
    return reports.numbered_top(insider(i), order, 15).select("rank", "isin", "signal_date", "score_1_10")


@query
def top5_recent_articles_per_company(i):
    order = [F.desc("published_at"), c("row_id")]
    return keyed.newest_n_per_key(i.sentiment(), ["isin"], order, 5).select("isin", "rank", "row_id", "published_at")


@query
def top6_q7_recent_sentiments(i):
    return serving.recent_sentiments(i.sentiment(), AS_OF)


# Sets -------------------------------------------------------------------------------------------


@query
def set2_dedup_by_title(i):
    order = [F.when(c("event_type") == "view", 0).when(c("event_type") == "signup", 1).otherwise(2), c("event_id")]
    return news.first_title(i.feed_entries(), order).select("title", "event_id", "event_type")


def site_entries(i: Inputs) -> DataFrame:
    e = c("event_id")
    return i.t("events").select(
        c("event_type").alias("category"), F.when(e % 4 != 0, F.concat(F.lit("g"), F.floor(e / 3).cast("string"))).alias("guid"),
        F.concat(F.lit("l"), F.floor(e / 2).cast("string")).alias("link"),
        F.when(e % 5 == 0, code(e)).alias("isin_tag"),
        F.when(e % 3 == 0, F.concat(F.lit("Note on "), code(e + 7), F.lit(":"))).otherwise("Note").alias("title"),
        F.when(e % 2 == 0, F.concat(F.lit("about ("), code(e + 9), F.lit(")"))).alias("summary"), "event_id", "value",
    )


@query
def set3_txt12_unseen_entries(i):
    stored = site_entries(i).where("value > 60").withColumn("guid", F.coalesce("guid", "link"))
    rows = news.unseen_entries(site_entries(i), stored, [c("event_id")])
    return rows.select("category", "guid", "event_id", "feed_isin")


# Scalar functions -------------------------------------------------------------------------------


@query
def sc1_surrogate_key(i):
    return i.feed_entries().select("event_id", text.article_key(c("title"), c("isin")).alias("row_id"))


@query
def sc2_feed_timestamp(i):
    return i.feed_entries().select("event_id", "published", clock.feed_timestamp(c("published")).alias("published_at"))


@query
def sc3_iso_timestamp(i):
    shapes = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "yyyy-MM-dd HH:mm:ss"]
    raw = pick(["", "  ", "not-a-date", None], c("event_id"))
    for n, shape in enumerate(shapes):
        raw = F.when(c("event_id") % 5 == n, F.date_format("ts", shape)).otherwise(raw)
    return i.t("events").select("event_id", clock.iso_timestamp(raw).alias("parsed"))


@query
def sc4_strict_date(i):
    return i.staging().select("source_url", clock.strict_date(c("date_cloture_exercice_raw")).alias("period_end"))


@query
def sc5_money_to_eur(i):
    return i.staging().select(
        "source_url", *[numbers.money_to_eur(c(raw)).alias(name) for name, raw in fundamentals.MONEY.items()]
    )


@query
def sc6_first_number(i):
    return i.staging().select(
        "source_url", *[numbers.first_number(c(raw)).alias(name) for name, raw in fundamentals.PERCENT.items()]
    )


@query
def sc7_version_number(i):
    return i.staging().select("source_url", numbers.version_number(c("llm_prompt_version")).alias("version"))


@query
def sc8_safe_divide(i):
    part = numbers.divide(c("l_quantity"), c("l_discount"))
    return i.t("lineitem").select("l_orderkey", "l_linenumber", numbers.round_half_away(part, 4).alias("part"))


@query
def sc9_null_propagating_clip(i):
    value = numbers.first_number(c("ca_growth_raw"))
    return i.staging().select(
        "source_url", numbers.clip(value, F.lit(-5.0), F.lit(5.0)).alias("clipped"),
        numbers.greatest_or_null(value, numbers.first_number(c("marge_op_raw"))).alias("larger"),
    )


@query
def sc10_round_half_away(i):
    return i.t("lineitem").select(
        "l_orderkey", "l_linenumber", numbers.round_half_away(c("l_quantity") / 8, 2).alias("up"),
        numbers.round_half_away(c("l_quantity") / -8, 2).alias("down"),
        numbers.round_half_away(c("l_quantity") * 1e27, 2).alias("huge"),
    )


@query
def sc11_log_ceil(i):
    return i.t("events").select(
        "event_id", numbers.round_half_away(F.log10(c("value") + 1), 8).alias("magnitude"),
        F.ceil("value").cast("int").alias("whole"),
    )


@query
def sc12_market_clock(i):
    here = F.convert_timezone(F.lit("UTC"), F.lit(clock.MARKET_ZONE), c("ts"))
    return i.t("events").select(
        "event_id", F.hour(here).alias("hour"), here.cast("date").alias("day"),
        F.trunc(here.cast("date"), "month").alias("month"), F.date_sub(here.cast("date"), 7).alias("week_before"),
    )


@query
def sc13_defaults(i):
    value = numbers.first_number(c("marge_op_raw"))
    return i.staging().select(
        "source_url", F.coalesce(value, F.lit(5.0)).alias("margin"),
        F.when(value < 0, "loss").when(value < 10, "thin").when(value >= 10, "solid").otherwise("unknown").alias("grade"),
    )


@query
def sc14_text_predicates(i):
    title = c("titre")
    return i.filings().select(
        "record_id", F.upper(title).like("%DIRIGEANT%").alias("insider"), F.lower(title).alias("lowered"),
        F.lower(title).rlike("résultat|results").alias("results"),
    )


def part_titles(i: Inputs) -> DataFrame:
    title = F.concat(c("p_name"), F.lit(" by "), c("p_brand"), F.lit(" - shop.com"))
    return i.t("part").select("p_partkey", title.alias("title"))


@query
def sc15_clean_title(i):
    return part_titles(i).select("p_partkey", text.clean_title(c("title")).alias("title"))


@query
def sc16_model_input(i):
    return i.t("documents").select("doc_id", F.md5(insider_answers.model_input(c("text"))).alias("input"))


def answered(i: Inputs) -> DataFrame:
    """Answers about articles: fenced, chatty, out of range, without a reason, broken, as text."""
    e = c("event_id")
    score = (e % 13).cast("string")
    body = F.concat(F.lit('{"score": '), score, F.lit(', "reason": "fact '), score, F.lit('"}'))
    raw = (
        F.when(e % 6 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(e % 6 == 1, F.concat(F.lit("Sure: "), body, F.lit(" as asked")))
        .when(e % 6 == 2, F.concat(F.lit('{"score": '), score, F.lit("}")))
        .when(e % 6 == 3, F.concat(F.lit('{"score": "'), score, F.lit('", "reason": "text"}')))
        .when(e % 6 == 4, "no json here")
        .otherwise(body)
    )
    return i.sentiment().drop("sentiment_score").join(
        i.t("events").select(F.md5(e.cast("string")).alias("row_id"), raw.alias("raw_response")), "row_id"
    )


@query
def sc17_sco15_article_sentiment(i):
    return news.article_sentiment(answered(i), "model-a", AS_OF)


@query
def sc19_isin_validation(i):
    key = c("c_custkey")
    value = (
        F.when(key % 4 == 0, F.lower(code(key))).when(key % 4 == 1, F.concat(F.lit(" "), code(key), F.lit(" ")))
        .when(key % 4 == 2, F.concat(F.lit("FR000012$"), key.cast("string"))).otherwise(F.concat(F.lit("US"), key.cast("string")))
    )
    return i.t("customer").select("c_custkey", text.is_code(value).alias("valid"))


@query
def sc19_isin_in_text(i):
    return i.t("documents").select("doc_id", text.code_in_text(c("text")).alias("isin"))


@query
def sc20_rescale(i):
    return rounded(insider(i).select("isin", "societe", "signal_date", numbers.rescale_1_10(c("score_1_10")).alias("score")), 6, "score")


@query
def sc21_signal_label(i):
    return reports.labelled_ranking(stocks(i).where("is_latest"), 10).select(
        "rank", "isin", *[f"{s}_label" for s in prices.SIGNALS]
    )


# Indicators -------------------------------------------------------------------------------------


def indicator_query(i: Inputs, *names: str) -> DataFrame:
    return rounded(indicator_rows(i).select("isin", "Date", *names), 4, *names)


@query
def ind1_simple_averages(i):
    return indicator_query(i, "SMA_50", "SMA_200")


@query
def ind2_bollinger_bands(i):
    return indicator_query(i, "BB_upper", "BB_lower")


@query
def ind3_exponential_average(i):
    return indicator_query(i, "EMA_20")


@query
def ind4_ind5_macd(i):
    return indicator_query(i, "MACD", "MACD_signal")


@query
def ind6_relative_strength(i):
    return indicator_query(i, "RSI_14")


@query
def ind7_computed_at(i):
    return indicator_rows(i).groupBy("isin", "computed_at").agg(F.count(F.lit(1)).alias("days"))


@query
def ind8_warm_up_rows(i):
    counts = [F.count_if(c(n).isNull()).alias(n) for n in INDICATORS]
    return indicator_rows(i).groupBy("isin").agg(F.count(F.lit(1)).alias("days"), *counts)


# Scores -----------------------------------------------------------------------------------------


@query
def sco1_to_sco5_signals(i):
    return prices.signals(indicator_rows(i)).select("isin", "Date", *prices.SIGNALS)


@query
def sco7_ratios(i):
    rows = fundamentals.ratios(signal(i)).select("ticker", "date_cloture_exercice", "record_id", "levier", "fcf_yield")
    return rounded(rows, 6, "levier", "fcf_yield")


@query
def sco9_z_scores(i):
    names = [f"z_{m}" for m in fundamentals.WEIGHTS]
    return rounded(z_rows(i).select("ticker", "date_cloture_exercice", *names, "nb_metrics"), 5, *names)


@query
def sco10_dynamic_weights(i):
    rows = fundamentals.weighted(z_rows(i), 2, fundamentals.WEIGHTS)
    return rounded(rows.select("ticker", "date_cloture_exercice", "total_weight", "z_composite"), 5, "total_weight", "z_composite")


@query
def sco11_financials_score(i):
    return financials(i).drop("source", "scored_at")


@query
def sco12_score_insider(i):
    return rounded(insider(i), 2, "total_amount", "raw_score")


@query
def sco13_score_news(i):
    return news_scores(i)


@query
def silver_financial_signal(i):
    columns = ["record_id", "isin", "ticker", "date_cloture_exercice", *fundamentals.MONEY, *fundamentals.PERCENT,
               "llm_prompt_version_num", "financial_signal_run_id", "extracted_at"]
    return signal(i).select(*columns)


# Text jobs --------------------------------------------------------------------------------------


def part_names(i: Inputs) -> DataFrame:
    """Referential of product names and their words, numbered by first appearance."""
    words = F.explode(F.concat(F.array("p_name"), F.split("p_name", " ")))
    names = i.t("part").select(words.alias("name"), "p_partkey", F.length("p_name").alias("n"))
    return names.groupBy("name").agg(F.min("p_partkey").alias("first")).select(
        "name", F.concat(F.lit("I-"), c("name")).alias("isin"), F.concat(F.lit("T-"), c("name")).alias("ticker_bourso"),
        F.struct("first", "name").alias("ordinal"),
    )


@query
def txt1_jn8_entity_link(i):
    return entity_link(part_titles(i), part_names(i))


def benchmark_words(i: Inputs) -> DataFrame:
    """Every word of the benchmark passages as a name, numbered by first appearance."""
    words = i.t("benchmark").select(F.explode(F.split("text", r"\s+")).alias("name"), "item_id")
    return words.where("name <> ''").groupBy("name").agg(F.min("item_id").alias("first")).select(
        "name", F.concat(F.lit("I-"), c("name")).alias("isin"), F.lit("T").alias("ticker_bourso"), F.struct("first", "name").alias("ordinal"),
    )


@query
def txt1_entity_link_documents(i):
    """Whole documents as titles, against all words of the benchmark passages as names."""
    return entity_link(i.t("documents").select("doc_id", c("text").alias("title")), benchmark_words(i)).drop("title")


@query
def txt1_short_names(i):
    """Words with their punctuation as titles, the bare words as names: short ones match below 100."""
    bare = F.regexp_extract("name", r"^([a-zA-ZÀ-ɏ]+)", 1)
    names = benchmark_words(i).groupBy(bare.alias("name")).agg(F.min("ordinal").alias("ordinal")).where("name <> ''").select(
        "name", F.lit("I").alias("isin"), F.lit("T").alias("ticker_bourso"), "ordinal")
    titles = i.t("documents").select(F.explode(F.split("text", r"\s+")).alias("title")).distinct()
    linked = entity_link(titles, names)
    return rounded(linked.select("title", "matched_name", "match_score"), 6, "match_score")


@query
def txt2_matched_by_category(i):
    linked = entity_link(
        i.t("part").select("p_partkey", c("p_type").alias("category"), F.concat(c("p_brand"), F.lit(" "), c("p_name")).alias("title")),
        part_names(i),
    )
    return news.matched_by_category(linked).select("category", "p_partkey", "matched_name")


@query
def txt3_doc_relevance(i):
    return documents.doc_relevance(i.filings()).select("record_id", "relevance_score", "threshold_score")


def spaced_documents(i: Inputs) -> DataFrame:
    """The driver's texts have no blank lines: every line break becomes one."""
    rows = dealt(i, i.t("documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.replace(c("text"), F.lit("\n"), F.lit("\n \n")).alias("text"))


@query
def txt4_split_blocks(i):
    blocks = F.posexplode(documents.split_blocks(c("text"))).alias("place", "block")
    return spaced_documents(i).select("doc_id", blocks).select("doc_id", "place", F.md5("block").alias("block"))


# The invented prose has few financial words, so its own frequent ones score as well.
PROSE = {**documents.KEYWORDS, "tion": 3, "the": 2, "eaux": 2, "und": 1, "ing": 4, "que ": 1}


@query
def txt5_score_blocks(i):
    rows = spaced_documents(i).select("doc_id", F.explode(documents.scored_blocks(c("text"), PROSE)).alias("b"))
    return rows.select("doc_id", "b.place", "b.score")


@query
def txt6_financial_context(i):
    rows = documents.financial_context(spaced_documents(i), "text", "context", 600, 15, PROSE)
    return rows.select("doc_id", F.length("context").alias("chars"), F.md5("context").alias("context"))


def answered_documents(i: Inputs) -> DataFrame:
    k = c("doc_id")
    figures = F.concat(F.lit('{"date_cloture_exercice_raw": "2023-12-31", "ca_raw": "'), k.cast("string"),
                       F.lit(' million EUR", "ca_growth_raw": "3 %", "ebitda_raw": null}'))
    response = (
        F.when(k % 8 == 0, '{"ca_raw": null, "ca_growth_raw": "4 %"}').when(k % 8 == 1, "{broken").when(k % 8 == 2, "[1, 2]")
        .when(k % 8 == 3, None).otherwise(figures)
    )
    return i.t("documents").select(
        F.concat(F.lit("R"), k.cast("string")).alias("record_id"),
        F.when(k % 11 == 0, " \n ").when(k % 17 != 0, c("text")).alias("document_text"),
        response.alias("raw_response"),
        F.when(k % 8 == 3, F.when(k % 3 == 0, 429).otherwise(500)).alias("http_status"),
    )


@query
def txt7_extraction_status(i):
    rows = documents.extraction(answered_documents(i), AS_OF)
    return rows.select("record_id", "extraction_status", *documents.ANSWERS, "text_length", "error_message")


NAMES = ["Jean Dupont", "Ancien dirigeant", "Marie Anne Martin", "Nestlé Holding", "X", "Le Groupe Vert",
         "Anne Marie De La Tour", "  Paul   Durand "]
DATES = ["2026-03-05", "2026-3-5", "2024-12-31", "2025-13-01", "inconnue"]
AMOUNTS = ['"montant": 1250.5', '"montant": "1 250,75 €"', '"montant": 0, "nombre_actions": "1,000", "prix_moyen": "2,5€"',
           '"nombre_actions": 10, "prix_moyen": 3.25', '"montant": "abc"', '"montant": null', '"montant": "0"']


def answered_filings(i: Inputs) -> DataFrame:
    """Answers about insider filings in all shapes: list, bare list, single object, broken."""
    k = c("o_orderkey")
    item = F.concat(
        F.lit('{"dirigeant": "'), pick(NAMES, k), F.lit('", "type_operation": "Achat", "date_signal": "'), pick(DATES, k),
        F.lit('", '), pick(AMOUNTS, k), F.when(k % 2 == 0, '').otherwise(', "ticker": "TK"'), F.lit("}"),
    )
    response = (
        F.when(k % 6 <= 2, F.concat(F.lit('{"signals": ['), item, F.lit(', "noise", '), item, F.lit("]}")))
        .when(k % 6 == 3, F.concat(F.lit("["), item, F.lit("]"))).when(k % 6 == 4, item).otherwise("{broken")
    )
    return dealt(i, i.t("orders"), "o_orderkey").select(
        F.concat(F.lit("R"), k.cast("string")).alias("record_id"), F.lit("https://filings.example").alias("pdf_url"),
        F.concat(F.lit("Company "), c("o_custkey").cast("string")).alias("societe"), i.owner(c("o_custkey")).alias("isin"),
        response.alias("raw_response"),
    )


@query
def txt8_parse_signals(i):
    rows = insider_answers.parse_signals(answered_filings(i), insider_answers.STRICT)
    return rows.groupBy("record_id").agg(F.count(F.lit(1)).alias("signals"))


@query
def txt9_amount_clean(i):
    rows = insider_answers.parse_signals(answered_filings(i), insider_answers.STRICT)
    return rows.select("record_id", numbers.round_half_away(insider_answers.amount(), 4).alias("montant"))


SIGNAL = ["ticker", "date_signal", "dirigeant", "qualite", "type_operation", "montant", "source_record_id", "societe", "isin"]


@query
def txt10_txt11_strict_insider_signals(i):
    return insider_answers.insider_signals(answered_filings(i), AS_OF, insider_answers.STRICT).select(*SIGNAL)


@query
def txt10b_scheduled_insider_signals(i):
    return insider_answers.insider_signals(answered_filings(i), AS_OF, insider_answers.SCHEDULED).select(*SIGNAL)


# Serving ----------------------------------------------------------------------------------------


@query
def q1_latest_technical_scores(i):
    return serving.latest_scores(stocks(i))


@query
def q3_latest_composite(i):
    return serving.latest_composite(kept_snapshots(staged(scores(i)), "composite_score", "composite"))


@query
def q4_latest_news_scores(i):
    return serving.latest_news(kept_snapshots(staged(news_scores(i)), "investment_score", "news"))


@query
def q5_insider_signals_45d(i):
    return rounded(serving.recent_insider(insider(i), AS_OF), 2, "total_amount")


@query
def q6_latest_fundamentals(i):
    return serving.latest_financials(financials(i))


@query
def q9_company_lookup(i):
    return serving.lookup_company(scores(i), "name", "00000000", "T12").select("name", "ticker_bourso", "composite_score")


@query
def q9_news_lookup(i):
    return serving.lookup_company(news_scores(i), "matched_name", "er 1", "T7").select("matched_name", "investment_score")


@query
def q10_recent_articles(i):
    return serving.recent_articles(i.sentiment(), "FR0000000003", 5)


@query
def q11_articles_driving_score(i):
    return serving.articles_driving_score(i.sentiment(), "FR0000000003", AS_OF)


@query
def q12_threshold_screens(i):
    screens = {
        "strong": serving.beyond("composite_score", above=6),
        "solid": serving.beyond("score_financials", at_least=8),
        "bad press": serving.beyond("score_news", below=3),
    }
    return serving.screened(scores(i).select("isin", "composite_score", "score_financials", "score_news"), screens)


@query
def q13_profile_matrix(i):
    return reports.profile_matrix(scores(i))


@query
def q13_signal_heatmap(i):
    return reports.signal_heatmap(stocks(i).where("is_latest"), 10).drop("company_name")


@query
def q14_news_scatter(i):
    return reports.news_scatter(news_scores(i))


@query
def q14_growth_margin_scatter(i):
    return reports.growth_margin_scatter(financials(i))


@query
def jn2_financials_with_names(i):
    rows = reports.financials_with_names(financials(i), stocks(i))
    return rows.select("company_name", "ticker", "date_cloture_exercice", "score_fondamental")


# Quality ----------------------------------------------------------------------------------------


@query
def dq1_dq3_dq4_row_rules(i):
    rows = i.filings()
    rules = [quality.not_null(x) for x in ("record_id", "isin", "publication_ts", "pdf_url")]
    rules += [quality.accepted_values("pdf_download_status", ["success", "failed", "http_error"]),
              quality.accepted_range("pdf_file_size_bytes", 100, 50000)]
    return quality.check_rows(rows, rules)


@query
def dq2_dq5_unique(i):
    filings, prices = i.tasks("orders"), i.tasks("lineitem")
    return quality.unique(i.staging(), ["record_id"], tasks=filings).unionByName(
        quality.unique(i.bars(), ["isin", "Date"], tasks=prices)).unionByName(quality.unique(i.raw_bars(), ["isin", "Date"], tasks=prices))


@query
def dq6_min_rows(i):
    return quality.min_rows(i.bars(), 1_000_000)


@query
def dq_financial_signal_report(i):
    return quality.check(signal(i), quality.financial_signal_rules(), grain=["record_id"], floor=10)


@query
def dq_article_report(i):
    return quality.check(articles(i), quality.article_rules(news.SOURCES[:2]), uniques=["row_id"])


# Incremental and streaming ----------------------------------------------------------------------


@query
def inc1_newer_than_target(i):
    first, second, third = article_parts(i)
    rows = first.unionByName(second).unionByName(third)
    target = rows.where((c("fetched_at") < "2024-01-20") & (c("source") != "abcbourse_rss"))
    return news.newer_than_target(rows, target).select("row_id", "link", "source", "fetched_at")


@query
def inc2_lookback_merge(i):
    """The target holds the low prompt versions; a week before its newest row is read again."""
    staging = i.staging()
    target = fundamentals.financial_signal(staging.where("extracted_at < '2024-01-05'"), AS_OF)
    fresh = fundamentals.financial_signal(staging, AS_OF, target=target)
    return keyed.upsert(target, fresh, ["record_id"]).select("record_id", "llm_prompt_version_num", "extracted_at")


@query
def inc3_rolling_month_rewrite(i):
    return prices.clean_bars(i.raw_bars(), AS_OF, incremental=True, ties=i.bar_ties()).select("isin", "Date", "Volume")


@query
def inc2_lookback_stream(i):
    """A stream of extraction attempts, in two deliveries.

    The first holds those before 15 January but for one run.  The second holds everything: attempts delivered again, better and
    worse versions, and attempts of the missing run, of which those more than a week back come too late.
    """
    path, staging = scratch_path(i.spark, "lookback"), i.staging()
    first = staging.where("extracted_at < '2024-01-15' and financial_signal_run_id <> 'fs-3'")
    figures = lambda rows: fundamentals.financial_signal(rows, AS_OF)
    table = writers.KeyedTable(i.spark, f"{path}/table", figures(first).schema, ["record_id"], buckets=16)
    for delivered in (first, staging):
        delivered.write.mode("append").parquet(f"{path}/attempts")
        stream = incremental.new_files(i.spark, f"{path}/attempts", staging.schema)
        timed = fundamentals.successful(stream).withColumn("event_time", clock.instant(c("extracted_at")))
        incremental.lookback_stream(timed, table, f"{path}/checkpoint", "event_time", "7 days", fundamentals.VERSION_ORDER, figures)
    return table.read().select("record_id", "llm_prompt_version_num", "financial_signal_run_id", "extracted_at")


@query
def inc4_full_refresh(i):
    table = writers.KeyedTable(i.spark, scratch_path(i.spark, "refresh"), i.companies().schema, ["isin"], buckets=8)
    table.write(i.companies().withColumn("name", F.lit("stale")))
    incremental.refresh(table, lambda _: i.companies(), full=True)
    return table.read()


@query
def inc5_snapshot_idempotent(i):
    table = writers.KeyedTable(i.spark, scratch_path(i.spark, "snapshots"), i.companies().schema, ["isin", "snapshot_date"], buckets=8)
    table.write(i.snapshots().where(c("snapshot_date") < AS_OF.date()))
    for _ in range(2):
        incremental.refresh(table, lambda _: i.companies())
    return table.read()


@query
def inc6_stream_unseen(i):
    """A file stream of events; only users the table does not have yet are added."""
    path = scratch_path(i.spark, "unseen")
    table = writers.KeyedTable(i.spark, f"{path}/table", schemas.T.StructType.fromDDL("user_id bigint, value double"), ["user_id"], buckets=8)
    best = lambda df: df.groupBy("user_id").agg(F.max("value").alias("value"))
    table.write(best(i.t("events").where("event_type = 'purchase' and value > 80")))
    stream = incremental.new_files(i.spark, i.folder, i.t("events").schema, "events.parquet")
    incremental.append_unseen(stream, table, f"{path}/checkpoint", best)
    return table.read()


@query
def inc7_retry_state(i):
    """Outcomes are merged, then decide which filings are tried again."""
    stored, outcomes = stored_and_new_filings(i)
    outcomes = outcomes.withColumn("pdf_download_status", F.when(c("isin").isNull(), "failed").otherwise("success"))
    merged = filings.merge_downloads(stored, outcomes)
    return filings.download_candidates(merged).select("record_id", "isin", "publication_ts")


@query
def str1_running_indicators(i):
    """Bars written as files, streamed with state per company."""
    path = scratch_path(i.spark, "running")
    i.bars().select("isin", "Date", "Close").write.parquet(f"{path}/bars")
    stream = incremental.new_files(i.spark, f"{path}/bars", schemas.T.StructType.fromDDL("isin string, Date date, Close double"))
    incremental.run_to_table(bar_streams.running_indicators(stream), f"{path}/out", f"{path}/checkpoint")
    names = ["RSI_14", "MACD", "MACD_signal", "EMA_20"]
    rows = i.spark.read.schema(bar_streams.RUNNING).parquet(f"{path}/out").where("kind = 'bar'")
    return rounded(rows.select("isin", "Date", *names), 4, *names)


@query
def str1_dropped_bars(i):
    """Every bar arrives; then those of odd volume again, with those of the first days, and they are counted, not followed."""
    path = scratch_path(i.spark, "again")
    every = staged(i.bars().select("isin", "Date", "Close", "Volume"), "every")
    for delivered in (every, every.where("Volume % 2 = 1")):
        delivered.drop("Volume").write.mode("append").parquet(f"{path}/bars")
        stream = incremental.new_files(i.spark, f"{path}/bars", schemas.T.StructType.fromDDL("isin string, Date date, Close double"))
        incremental.run_to_table(bar_streams.running_indicators(stream), f"{path}/out", f"{path}/checkpoint")
    rows = i.spark.read.schema(bar_streams.RUNNING).parquet(f"{path}/out")
    return rows.groupBy("isin").agg(F.count_if(c("kind") == "bar").alias("bars"), F.sum("dropped").alias("dropped"))


@query
def str2_stream_daily_bars(i):
    """Ticks streamed from the events file; a day is written once the watermark has passed it, the last days follow from a batch."""
    path = scratch_path(i.spark, "bars")
    stream = incremental.new_files(i.spark, i.folder, i.t("events").schema, "events.parquet")
    timed = stream.withColumn("ts", clock.instant(c("ts"))).withWatermark("ts", "1 hour")
    ticks = lambda events: events.select(
        F.concat(F.lit("U"), c("user_id").cast("string")).alias("isin"), "ts", c("value").alias("price"),
        (c("event_id") % 9).alias("quantity"), "event_id",
    )
    incremental.run_to_table(bar_streams.daily_bars(ticks(timed), ["event_id"]), f"{path}/out", f"{path}/checkpoint")
    written = i.spark.read.schema("isin string, Date date, Open double, High double, Low double, Close double, Volume bigint").parquet(
        f"{path}/out"
    )
    return bar_streams.with_open_days(written, ticks(i.t("events")), ["event_id"])


@query
def str2_batch_daily_bars(i):
    return i.bars()
