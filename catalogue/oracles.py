"""Reference SQL for the queries, for DuckDB on the same tables."""

from catalogue.oracle_parts import (
    COMPANIES, DAY, KEYWORDS, METRICS, NOW, PROSE_KEYWORDS, SUBTYPE_LADDER, TITLE_LADDER, TYPE_LADDER, code, eur, hms, number, owner,
    pick, r, sql, text, ymd,
)
from catalogue.queries import AMOUNTS, DATES, HISTORY, NAMES

FIVE = "rsi_signal, macd_signal, golden_cross_signal, bollinger_signal, trend_signal"
ORACLES = {}


def oracle(name: str, select: str, **ctes: str) -> None:
    ORACLES[name] = sql(select, **ctes)


# Sources ----------------------------------------------------------------------------------------

oracle("src1_read_referential", """
    SELECT name, isin FROM (SELECT *, row_number() OVER (PARTITION BY isin ORDER BY c_custkey) AS rn FROM csv
                            WHERE length(isin) = 12) WHERE rn = 1""",
       csv=f"""SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'X' || c_custkey
               ELSE {code('c_custkey // 3')} END AS isin FROM customer""")
oracle("src2_read_targets", f"""
    SELECT {code('c_custkey // 3')} AS isin, first('T' || c_custkey ORDER BY c_custkey) FILTER (WHERE c_custkey % 2 = 0) AS ticker
    FROM customer WHERE c_custkey % 7 <> 0 GROUP BY c_custkey // 3""")
oracle("src3_read_company_list", f"SELECT s_name AS name, {code('s_suppkey')} AS isin, s_acctbal::VARCHAR AS balance FROM supplier")
LINES = f"""
    SELECT o_orderkey, CASE WHEN (o_orderkey // 2) % 25 = 0 THEN ' ' ELSE 'R' || (o_orderkey // 2) END AS record_id,
           'Company ' || o_custkey AS societe, {owner('o_custkey')} AS isin, 'T' || (o_custkey % {COMPANIES}) AS ticker,
           CASE o_orderkey % 3 WHEN 0 THEN {hms('o_orderdate')} WHEN 1 THEN {hms('o_orderdate - INTERVAL 2 HOUR')} END AS publication_ts,
           'https://filings.example/' || o_orderkey AS pdf_url, 'Filing ' || o_orderkey AS titre, o_orderpriority AS sous_type,
           o_orderstatus AS type_information, 'amf' AS source, 'run-9' AS run_id, '2024-01-31 20:00:00' AS ingestion_ts
    FROM orders JOIN supplier ON s_suppkey = o_custkey % {COMPANIES} AND s_acctbal > 4000 WHERE o_orderkey % 97 <> 5"""
oracle("src4_prj1_jn10_read_filings", """
    SELECT * EXCLUDE (o_orderkey, rn) FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY o_orderkey) AS rn FROM lines)
    WHERE rn = 1 OR trim(record_id) = ''""", lines=LINES)
oracle("src4_filing_line_counts", """
    SELECT count(*) AS lines, count(*) FILTER (WHERE o_orderkey % 97 = 5) AS broken_lines,
           count(*) FILTER (WHERE o_orderkey % 97 <> 5) AS with_record_id FROM orders""")
oracle("src5_jn9_resolve_ticker", f"""
    SELECT {code('s_suppkey')} AS isin, s_name AS name,
           CASE WHEN n_nationkey IS NOT NULL THEN 'M' || n_nationkey WHEN s_acctbal > 2000 THEN 'T' || s_suppkey END AS yf_ticker
    FROM supplier LEFT JOIN nation ON n_nationkey = s_suppkey""")
PAGES = """
    SELECT c_custkey AS page, position, c_name || ' & Co' AS name,
           CASE WHEN c_custkey % 5 <> 0 THEN '1rP' || (c_custkey // 2) END AS ticker_bourso,
           'https://listing.example/cours/' || c_custkey || '/' AS detail_url,
           CASE WHEN c_custkey % 3 IN (0, 1) THEN c_nationkey::VARCHAR END AS last, NULL::VARCHAR AS variation,
           CASE WHEN c_custkey % 3 = 1 THEN c_custkey::VARCHAR END AS high, NULL::VARCHAR AS low,
           CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR END AS volume,
           CASE c_custkey % 3 WHEN 0 THEN '{"quote":{"lastPrice":"' || c_nationkey || '","volume":' || c_custkey || '}}'
                WHEN 1 THEN 'x = {"a":[{"last":"","price":"' || c_nationkey || '"}],"high":' || c_custkey || '};'
                ELSE 'not json' END AS raw_data_ist_init
    FROM customer, (VALUES (0), (1)) AS places(position)"""
oracle("src6_sc18_extract_listing_rows", "SELECT * FROM listed", listed=PAGES)
oracle("set4_dedup_listing", """
    SELECT page, name, ticker_bourso, detail_url FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker_bourso, CASE WHEN ticker_bourso IS NULL THEN name || detail_url END
                                     ORDER BY page, position) AS rn FROM listed) WHERE rn = 1""", listed=PAGES)
oracle("src7_sc19_isin_from_html", f"""
    SELECT page_id, CASE WHEN page_id % 3 IN (0, 1) THEN {code('page_id')} ELSE '' END AS isin FROM pages""")

# Sinks ------------------------------------------------------------------------------------------

DAYS = "SELECT isin, count(*) AS days, sum(volume)::BIGINT AS volume FROM bars GROUP BY isin"
oracle("snk1_append_fixed_schema", DAYS)
oracle("snk2_append_by_category", """
    SELECT event_type AS category, count(*) AS entries, count(*) FILTER (WHERE value >= 50) AS notes FROM events GROUP BY 1""")
oracle("snk3_replace_table", "SELECT isin, count(*) AS days FROM bars GROUP BY isin")
OLD = "SELECT * FROM filings WHERE publication_ts IS NULL OR publication_ts < '2022-01-01'"
NEW = "SELECT * FROM filings WHERE publication_ts >= '2020-01-01'"
oracle("snk4_merge_upsert", """
    SELECT coalesce(o.record_id, n.record_id) AS record_id, coalesce(n.societe, o.societe) AS societe,
           CASE WHEN n.record_id IS NULL THEN o.isin ELSE n.isin END AS isin,
           CASE WHEN n.record_id IS NULL THEN o.titre ELSE 'New ' || n.titre END AS titre,
           CASE WHEN n.record_id IS NULL THEN o.run_id ELSE 'run-3' END AS run_id, o.pdf_download_status, o.pdf_file_size_bytes
    FROM old_rows o FULL JOIN new_rows n ON o.record_id = n.record_id""", old_rows=OLD, new_rows=NEW)
oracle("snk5_merge_update_only", """
    SELECT o.record_id, o.societe, o.isin, o.titre, o.run_id,
           CASE WHEN n.record_id IS NULL THEN o.pdf_download_status ELSE 'ignored' END AS pdf_download_status, o.pdf_file_size_bytes
    FROM old_rows o LEFT JOIN new_rows n ON o.record_id = n.record_id""", old_rows=OLD, new_rows=NEW)
ARTICLE = f"row_id, title, link, isin, {hms('fetched_at')} AS fetched_at, source, {hms('published_at')} AS published_at"
NEWEST = "row_number() OVER (PARTITION BY row_id ORDER BY fetched_at DESC, source, link, title)"
oracle("snk6_incremental_merge", f"SELECT {ARTICLE} FROM newer UNION ALL SELECT {ARTICLE} FROM older WHERE row_id NOT IN (SELECT row_id FROM newer)",
       older=f"SELECT * FROM (SELECT *, {NEWEST} AS rn FROM parts WHERE source <> 'abcbourse_rss') WHERE rn = 1",
       again="SELECT * REPLACE (CASE WHEN source = 'google_news_rss' THEN 'again' ELSE link END AS link) FROM parts WHERE source <> 'yahoo_rss'",
       newer=f"SELECT * FROM (SELECT *, {NEWEST} AS rn FROM again) WHERE rn = 1")
oracle("snk7_insert_overwrite_month", f"""
    SELECT {ymd("date_trunc('month', date)")} AS month, count(*) AS bars,
           sum(volume + CASE WHEN date >= DATE '2024-01-01' THEN 1000 ELSE 0 END)::BIGINT AS volume FROM clean GROUP BY 1""")
oracle("snk8_dump_raw_run", """
    SELECT kind, '2024-01-31T20-00-00Z' AS run_id, count(*) AS records, count(DISTINCT title) AS titles
    FROM (SELECT 'raw' AS kind, title FROM entries UNION ALL SELECT 'clean', title FROM entries WHERE isin IS NOT NULL) GROUP BY kind""")
oracle("snk9_export_csv_projected", f"SELECT s_name AS name, NULL AS ticker_bourso, {code('s_suppkey')} AS isin FROM supplier")
oracle("snk10_layout", "SELECT record_id, isin, titre, run_id FROM filings")
oracle("snk11_ensure_table", """
    SELECT isin, count(*) AS days, sum(volume) FILTER (WHERE date >= DATE '2020-01-01')::BIGINT AS volume FROM bars GROUP BY isin""")
oracle("snk12_conform_fail", f'SELECT {ymd("date")} AS "Date", isin, volume::DOUBLE AS "Volume" FROM bars')
oracle("snk12_conform_schema", f'SELECT isin, {ymd("date")} AS "Date", volume::DOUBLE AS "Volume", NULL AS note FROM bars')

# Filters and projections ------------------------------------------------------------------------

BAR = f'isin, {ymd("date")} AS "Date", volume AS "Volume", l_partkey'
oracle("flt1_valid_price_filter", f"SELECT {BAR} FROM raw_bars WHERE isin IS NOT NULL AND close > 0 AND open > 0 AND isfinite(close) AND isfinite(open)")
oracle("flt2_market_close_cutoff", f"SELECT {BAR} FROM raw_bars WHERE date <= DATE '2024-01-30'")
oracle("flt3_rolling_window_days", f"SELECT row_id, {hms('published_at')} AS published_at FROM sentiment WHERE published_at >= {NOW} - INTERVAL 20 DAY")
oracle("flt4_nonblank_key", "SELECT * FROM listing WHERE isin IS NOT NULL AND trim(isin) <> ''")
AGAIN = """(pdf_download_status IS NULL OR pdf_download_status IN ('failed', 'empty_file')
            OR (pdf_download_status = 'http_error' AND (pdf_http_status IS NULL OR pdf_http_status NOT IN (404, 410))))"""
oracle("flt5_pdf_retry_candidates", f"""
    SELECT record_id, isin, {hms('publication_ts')} AS publication_ts, pdf_url, source, run_id AS source_run_id FROM filings
    WHERE pdf_url IS NOT NULL AND isin IS NOT NULL AND {AGAIN}""")
RECENT_FILING = """type_information = 'Informations réglementées continues' AND pdf_download_status = 'success'
    AND publication_ts::DATE >= DATE '2024-01-31' - 90"""
oracle("flt6_insider_title_filter", f"""
    SELECT record_id, titre, {hms('publication_ts')} AS publication_ts FROM filings
    WHERE {RECENT_FILING} AND (upper(titre) LIKE '%DIRIGEANT%' OR upper(titre) LIKE '%PERSONNE EXERÇANT%' OR upper(titre) LIKE '%ARTICLE 19%')
      AND upper(titre) NOT LIKE '%ACTIONS PROPRES%' AND upper(titre) NOT LIKE '%RACHAT%' AND upper(titre) NOT LIKE '%DROITS DE VOTE%'""")
oracle("flt6b_jn5_insider_filings", f"""
    SELECT record_id, titre, {hms('publication_ts')} AS publication_ts FROM filings f
    WHERE {RECENT_FILING} AND (upper(titre) LIKE '%DIRIGEANT%' OR upper(titre) LIKE '%ARTICLE 19%')
      AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = f.o_orderkey AND o.o_orderstatus = 'F')
    ORDER BY f.publication_ts DESC, record_id LIMIT 15""")
oracle("flt7_post_last_date_filter", f"""
    SELECT {BAR} FROM raw_bars n LEFT JOIN marks m USING (isin) WHERE m.mark IS NULL OR n.date > m.mark""",
       marks="SELECT isin, max(date) AS mark FROM raw_bars WHERE l_extendedprice > 50000 GROUP BY isin")
PERIOD = f"ticker, {ymd('date_cloture_exercice')} AS date_cloture_exercice"
oracle("flt8_min_metrics", f"SELECT {PERIOD}, nb_metrics FROM zs WHERE nb_metrics >= 2")
oracle("flt9_active_prompt_version", """
    SELECT record_id, llm_prompt_version, llm_prompt_version_num FROM versions WHERE llm_prompt_version = 'v3'""")
oracle("flt10_q2_score_history", f"""
    SELECT isin, company_name, {ymd('date')} AS date, score_technique, score_7d_avg FROM stocks
    WHERE isin IN ({', '.join(text(x) for x in HISTORY)}) AND date >= {DAY} - 365""")
oracle("prj2_trim_upper_normalise", "SELECT trim(name) AS name, upper(trim(isin)) AS isin, trim(ticker_bourso) AS ticker_bourso FROM listing")

# Joins ------------------------------------------------------------------------------------------

oracle("jn1_sco14_company_scores", f"""
    SELECT * REPLACE ({ymd('snapshot_date')} AS snapshot_date, {ymd('score_date')} AS score_date) FROM composite""")
oracle("jn2_label_fallback", "SELECT isin, company_name, count(*) AS days FROM stocks GROUP BY ALL")
oracle("jn3_inc6_anti_join_unscored", f"""
    SELECT row_id, isin, title, {hms('published_at')} AS published_at FROM articles
    WHERE row_id NOT IN (SELECT row_id FROM articles WHERE source = 'yahoo_rss')""")


def ladder(column: str, steps: list, penalise: bool = True) -> str:
    lowered = f"lower(coalesce({column}, ''))"
    cases = " ".join(f"WHEN regexp_matches({lowered}, {text(p)}) THEN {v}" for p, v in steps if penalise or v > 0)
    return f"(CASE {cases} ELSE 0 END)"


def relevance(penalise: bool) -> str:
    return (f"{ladder('titre', TITLE_LADDER, penalise)} + {ladder('sous_type', SUBTYPE_LADDER)} + "
            f"{ladder('type_information', TYPE_LADDER)}")


oracle("jn4_txt3_top7_relevant_documents", f"""
    SELECT record_id, titre, {relevance(True)} AS relevance_score, {relevance(False)} AS threshold_score,
           {hms('publication_ts')} AS publication_ts
    FROM filings f JOIN (SELECT o_orderkey, o_orderstatus FROM orders) o USING (o_orderkey)
    WHERE run_id = (SELECT max(run_id) FROM filings) AND pdf_download_status = 'success' AND pdf_gcs_uri IS NOT NULL
      AND f.publication_ts >= {NOW} - INTERVAL 400 DAY AND o_orderstatus = 'O' AND {relevance(False)} >= 4""")
oracle("jn6_sco8_winsorise", f"SELECT {PERIOD}, " + ", ".join(f"{r(f'{m}_w', 6)} AS {m}_w" for m in METRICS) + " FROM wins")
oracle("jn7_agg12_latest_run", "SELECT record_id, run_id FROM filings WHERE run_id = (SELECT max(run_id) FROM filings)")

# Aggregations -----------------------------------------------------------------------------------

oracle("agg1_news_45d", "SELECT * FROM news_agg")
oracle("agg2_insider_daily", f"""
    SELECT isin, societe, {ymd('signal_date')} AS signal_date, insider_names, num_operations, {r('total_amount', 2)} AS total_amount FROM insider""")
oracle("agg3_last_date_per_isin", f"SELECT isin, {ymd('max(date)')} AS last_date FROM bars GROUP BY isin")
oracle("agg4_win8_exact_percentiles", "SELECT " + ", ".join(
    f"{r(f'quantile_cont({m}, {p})', 6)} AS {n}_{m}" for m in ("l_extendedprice", "l_quantity", "l_discount") for n, p in (("p05", 0.05), ("p95", 0.95))
) + " FROM lineitem")
oracle("agg5_population_stats", f"SELECT {r('avg(l_quantity)', 6)} AS mu, {r('stddev_samp(l_quantity)', 6)} AS sd FROM lineitem")
oracle("agg6_distinct_isins", "SELECT DISTINCT isin FROM bars")
for name in ("agg7_run_counters", "agg7_counted_write"):
    oracle(name, """
    SELECT financial_signal_run_id, count(*) AS total, count(*) FILTER (WHERE extraction_status = 'success') AS success,
           count(*) FILTER (WHERE extraction_status = 'no_financial_data') AS skipped,
           count(*) FILTER (WHERE extraction_status NOT IN ('success', 'no_financial_data')) AS errors
    FROM staging GROUP BY 1""")
oracle("agg8_composite_kpis", f"""
    SELECT count(*) AS companies, {r('avg(composite_score)', 6)} AS mean_score,
           count(*) FILTER (WHERE composite_score >= 6) AS opportunities,
           first(name ORDER BY composite_score DESC, name DESC) AS top_name, max(composite_score) AS top_score FROM composite""")
oracle("agg9_technical_kpis", f"""
    SELECT count(*) AS companies, first(company_name ORDER BY score_technique DESC, score_7d_avg DESC, company_name DESC) AS top_name,
           max(score_technique) AS top_score, {r('count(*) FILTER (WHERE score_technique >= 7) * 100.0::DOUBLE / count(*)', 6)} AS pct_strong,
           count(*) FILTER (WHERE golden_cross_signal = 2) AS golden_crosses FROM stocks WHERE is_latest""")
oracle("agg10_score_histogram", """
    SELECT bin, bin * 0.5::DOUBLE AS bin_start, CASE WHEN bin < 8 THEN 'caution' WHEN bin < 14 THEN 'neutral' ELSE 'opportunity' END AS zone,
           count(*) AS companies
    FROM (SELECT least(floor(score_technique / 0.5::DOUBLE), 19)::INTEGER AS bin FROM stocks) GROUP BY bin""")
oracle("agg11_freshness", f"""
    SELECT 'stocks' AS table_name, {ymd('max(date)')} AS newest FROM bars
    UNION ALL SELECT 'insiders', {ymd('max(signal_date)')} FROM insider
    UNION ALL SELECT 'news', {ymd('max(published_at)')} FROM sentiment
    UNION ALL SELECT 'fundamentals', {ymd('max(date_cloture_exercice)')} FROM signal""")

# Windows ----------------------------------------------------------------------------------------

oracle("win1_latest_per_key", f"""
    SELECT isin, {ymd('signal_date')} AS signal_date, num_operations FROM (
        SELECT *, row_number() OVER (PARTITION BY isin ORDER BY signal_date DESC, societe) AS rn FROM insider) WHERE rn = 1""")


def ohlc(*extra: str) -> str:
    prices = ", ".join(f'{n.lower()} AS "{n}"' for n in ("Open", "High", "Low", "Close"))
    return ", ".join([f'isin, {ymd("date")} AS "Date", {prices}, volume AS "Volume"', *extra])


oracle("win2_clean_bars", f"SELECT {ohlc('yf_ticker')} FROM clean")
oracle("win2_set1_rss_articles", f"""
    SELECT * REPLACE ({hms('fetched_at')} AS fetched_at, {hms('published_at')} AS published_at) FROM articles""")
oracle("win3_dedup_multi_order", f"""
    SELECT record_id, llm_prompt_version_num, {hms('extracted_at')} AS extracted_at, financial_signal_run_id, ca_raw FROM signal""")
oracle("win4_companies", f"SELECT * REPLACE ({ymd('snapshot_date')} AS snapshot_date) FROM companies")
oracle("win5_sco6_stocks_score", f"""
    SELECT isin, company_name, yf_ticker, {ymd('date')} AS date, close AS "Close", {FIVE}, score_technique,
           score_7d_avg, score_14d_avg, is_latest FROM stocks""")
oracle("win6_is_latest_flag", f"SELECT isin, {ymd('date')} AS date, is_latest FROM stocks WHERE is_latest")
oracle("win7_percent_rank_global", f"""
    SELECT event_id, value, {r('percent_rank() OVER (ORDER BY value NULLS FIRST)', 8)} AS share FROM events""")
oracle("win9_rank_column", f"""
    SELECT row_number() OVER (ORDER BY f.score_fondamental DESC, ticker, f.date_cloture_exercice) AS rank, {PERIOD}, score_fondamental
    FROM financials f ORDER BY rank LIMIT 10""")

# Rankings ---------------------------------------------------------------------------------------

oracle("top1_q8_top_companies", """
    SELECT name, ticker_bourso, composite_score, score_news, score_stock, score_insider, score_financials FROM composite
    ORDER BY composite_score DESC, name LIMIT 25""")
oracle("top2_technical_ranking", """
    SELECT * FROM (SELECT 'top' AS kind, row_number() OVER (ORDER BY score_technique DESC, score_7d_avg DESC, isin DESC) AS rank,
                          isin, score_technique, score_7d_avg FROM stocks WHERE is_latest
                   UNION ALL
                   SELECT 'flop', row_number() OVER (ORDER BY score_technique, score_7d_avg, isin), isin, score_technique, score_7d_avg
                   FROM stocks WHERE is_latest) WHERE rank <= 10""")
oracle("top3_news_ranking", """
    SELECT row_number() OVER (ORDER BY investment_score DESC, avg_sentiment_45d DESC, isin) AS rank, isin, investment_score,
           avg_sentiment_45d, mention_count_45d FROM news ORDER BY rank LIMIT 20""")
oracle("top4_insider_ranking", f"""
    SELECT row_number() OVER (ORDER BY i.signal_date DESC, score_1_10 DESC, isin) AS rank, isin, {ymd('signal_date')} AS signal_date,
           score_1_10 FROM insider i ORDER BY rank LIMIT 15""")
oracle("top5_recent_articles_per_company", f"""
    SELECT isin, rank, row_id, {hms('published_at')} AS published_at FROM (
        SELECT *, row_number() OVER (PARTITION BY isin ORDER BY published_at DESC, row_id) AS rank FROM sentiment) WHERE rank <= 5""")
SENTIMENT = f"isin, matched_name, title, {hms('published_at')} AS published_at, sentiment_score, sentiment_reason"
oracle("top6_q7_recent_sentiments", f"""
    SELECT {SENTIMENT} FROM sentiment s WHERE s.published_at >= {NOW} - INTERVAL 45 DAY ORDER BY s.published_at DESC, row_id LIMIT 500""")

# Sets -------------------------------------------------------------------------------------------

oracle("set2_dedup_by_title", """
    SELECT title, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY title ORDER BY CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END,
                                     event_id) AS rn FROM entries) WHERE rn = 1""")
oracle("set3_txt12_unseen_entries", f"""
    SELECT category, guid, event_id, CASE WHEN event_id % 5 = 0 THEN {code('event_id')} WHEN event_id % 3 = 0 THEN {code('event_id + 7')}
           WHEN event_id % 2 = 0 THEN {code('event_id + 9')} END AS feed_isin
    FROM (SELECT *, row_number() OVER (PARTITION BY category, guid ORDER BY event_id) AS rn FROM site s
          WHERE NOT EXISTS (SELECT 1 FROM site o WHERE o.value > 60 AND o.category = s.category AND o.guid = s.guid)) WHERE rn = 1""",
       site="""SELECT event_type AS category, CASE WHEN event_id % 4 <> 0 THEN 'g' || (event_id // 3) ELSE 'l' || (event_id // 2) END AS guid,
                      event_id, value FROM events""")

# Scalar functions -------------------------------------------------------------------------------

oracle("sc1_surrogate_key", "SELECT event_id, md5(lower(title) || '|' || isin) AS row_id FROM entries")
oracle("sc2_feed_timestamp", f"""
    SELECT event_id,
           CASE WHEN event_id % 29 = 0 THEN 'soon' ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S') || CASE WHEN event_id % 5 = 1 THEN ' +0200' ELSE ' GMT' END END AS published,
           CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 = 1 THEN {hms('ts - INTERVAL 2 HOUR')} ELSE {hms('ts')} END AS published_at
    FROM events""")
oracle("sc3_iso_timestamp", f"""
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 2 THEN {hms('ts - INTERVAL 2 HOUR')}
           WHEN 4 THEN NULL ELSE {hms('ts')} END AS parsed FROM events""")
URL = "'https://filings.example/' || o_orderkey AS source_url"
oracle("sc4_strict_date", f"""
    SELECT {URL}, CASE WHEN o_orderkey % 41 = 5 OR o_orderkey % 43 = 9 THEN NULL ELSE date_cloture_exercice_raw END AS period_end FROM staging""")
oracle("sc5_money_to_eur", f"SELECT {URL}, " + ", ".join(f"{eur(f'{m}_raw')} AS {m}" for m in ("ca", "ebitda", "dette_nette", "fcf")) + " FROM staging")
oracle("sc6_first_number", f"""
    SELECT {URL}, CASE WHEN ca_growth_raw IS NOT NULL THEN ((o_orderkey % 41 - 20) || '.' || (o_orderkey % 10))::DOUBLE END AS ca_growth,
           CASE WHEN marge_op_raw IS NOT NULL THEN (o_orderkey % 37 - 9)::DOUBLE END AS marge_op FROM staging""")
oracle("sc7_version_number", f"SELECT {URL}, CASE WHEN o_orderkey % 47 = 1 THEN 0 ELSE o_orderkey % 12 END AS version FROM staging")
oracle("sc8_safe_divide", f"SELECT l_orderkey, l_linenumber, {r('l_quantity / nullif(l_discount, 0)', 4)} AS part FROM lineitem")
oracle("sc9_null_propagating_clip", f"""
    SELECT {URL}, CASE WHEN g IS NOT NULL THEN greatest(-5.0::DOUBLE, least(5.0::DOUBLE, g)) END AS clipped,
           CASE WHEN g IS NOT NULL AND m IS NOT NULL THEN greatest(g, m) END AS larger
    FROM (SELECT o_orderkey, {number('ca_growth_raw')} AS g, {number('marge_op_raw')} AS m FROM staging)""")
oracle("sc10_round_half_away", f"SELECT l_orderkey, l_linenumber, {r('l_quantity / 8', 2)} AS up, {r('l_quantity / -8', 2)} AS down, l_quantity * 1e27::DOUBLE AS huge FROM lineitem")
oracle("sc11_log_ceil", f"SELECT event_id, {r('log10(value + 1)', 8)} AS magnitude, ceil(value)::INTEGER AS whole FROM events")
oracle("sc12_market_clock", f"""
    SELECT event_id, hour(here)::INTEGER AS hour, {ymd('here')} AS day, strftime(here, '%Y-%m-01') AS month, {ymd('here - INTERVAL 7 DAY')} AS week_before
    FROM (SELECT event_id, ts + INTERVAL 1 HOUR AS here FROM events)""")  # the market is one hour ahead in January
oracle("sc13_defaults", f"""
    SELECT {URL}, coalesce(m, 5.0::DOUBLE) AS margin,
           CASE WHEN m < 0 THEN 'loss' WHEN m < 10 THEN 'thin' WHEN m >= 10 THEN 'solid' ELSE 'unknown' END AS grade
    FROM (SELECT o_orderkey, {number('marge_op_raw')} AS m FROM staging)""")
oracle("sc14_text_predicates", """
    SELECT record_id, contains(upper(titre), 'DIRIGEANT') AS insider, lower(titre) AS lowered,
           contains(lower(titre), 'résultat') OR contains(lower(titre), 'results') AS results FROM filings""")
oracle("sc15_clean_title", "SELECT p_partkey, p_name || ' by ' || p_brand AS title FROM part")
oracle("sc16_model_input", r"SELECT doc_id, md5(left(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'), 3500)) AS input FROM documents")
oracle("sc17_sco15_article_sentiment", f"""
    SELECT row_id, isin, ticker_bourso, matched_name, title, {hms('published_at')} AS published_at, event_id % 13 AS sentiment_score,
           CASE WHEN event_id % 6 = 3 THEN 'text' ELSE 'fact ' || (event_id % 13) END AS sentiment_reason, 'model-a' AS groq_model,
           '2024-01-31 20:00:00' AS scored_at
    FROM sentiment WHERE event_id % 6 NOT IN (2, 4) AND event_id % 13 <= 10""")
oracle("sc19_isin_validation", """
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS valid FROM customer""")
oracle("sc19_isin_in_text", r"""
    SELECT doc_id, nullif(regexp_extract(text, '(?:^|[^\p{L}\p{N}_])([A-Z]{2}[A-Z0-9]{10})(?:$|[^\p{L}\p{N}_])', 1), '') AS isin FROM documents""")
oracle("sc20_rescale", f"SELECT isin, societe, {ymd('signal_date')} AS signal_date, {r('(score_1_10 - 1) / 9.0::DOUBLE * 10', 6)} AS score FROM insider")
oracle("sc21_signal_label", "SELECT row_number() OVER (ORDER BY score_technique DESC, score_7d_avg DESC, isin DESC) AS rank, isin, " + ", ".join(
    f"CASE {s.strip()} WHEN 0 THEN 'bearish' WHEN 1 THEN 'neutral' ELSE 'bullish' END AS {s.strip()}_label" for s in FIVE.split(",")
) + " FROM stocks WHERE is_latest ORDER BY rank LIMIT 10")

# Indicators -------------------------------------------------------------------------------------


def indicator(name: str, *columns: str) -> None:
    listed = ", ".join(f'{r(x.lower(), 4)} AS "{x}"' for x in columns)
    oracle(name, f'SELECT isin, {ymd("date")} AS "Date", {listed} FROM indicators')


indicator("ind1_simple_averages", "SMA_50", "SMA_200")
indicator("ind2_bollinger_bands", "BB_upper", "BB_lower")
indicator("ind3_exponential_average", "EMA_20")
indicator("ind4_ind5_macd", "MACD", "MACD_signal")
indicator("ind6_relative_strength", "RSI_14")
indicator("str1_running_indicators", "RSI_14", "MACD", "MACD_signal", "EMA_20")
oracle("ind7_computed_at", "SELECT isin, '2024-01-31 20:00:00' AS computed_at, count(*) AS days FROM bars GROUP BY isin")
WARM_UP = {"RSI_14": 13, "MACD": 25, "MACD_signal": 33, "BB_upper": 19, "BB_lower": 19, "SMA_50": 49, "SMA_200": 199, "EMA_20": 19}
oracle("ind8_warm_up_rows", "SELECT isin, count(*) AS days, " + ", ".join(
    f'least(count(*), {n}) AS "{x}"' for x, n in WARM_UP.items()) + " FROM bars GROUP BY isin")

# Scores -----------------------------------------------------------------------------------------

oracle("sco1_to_sco5_signals", f'SELECT isin, {ymd("date")} AS "Date", {FIVE} FROM points')
oracle("sco7_ratios", f"SELECT {PERIOD}, record_id, {r('levier', 6)} AS levier, {r('fcf_yield', 6)} AS fcf_yield FROM ratios")
oracle("sco9_z_scores", f"SELECT {PERIOD}, nb_metrics, " + ", ".join(f"{r(f'z_{m}', 5)} AS z_{m}" for m in METRICS) + " FROM zs")
oracle("sco10_dynamic_weights", f"SELECT {PERIOD}, {r('total_weight', 5)} AS total_weight, {r('z_composite', 5)} AS z_composite FROM weighted")
oracle("sco11_financials_score", f"""
    SELECT * REPLACE ({ymd('date_cloture_exercice')} AS date_cloture_exercice, {hms('extracted_at')} AS extracted_at) FROM financials""")
oracle("sco12_score_insider", f"""
    SELECT isin, societe, {ymd('signal_date')} AS signal_date, insider_names, num_operations, {r('total_amount', 2)} AS total_amount,
           {r('raw_score', 2)} AS raw_score, score_1_10 FROM insider""")
oracle("sco13_score_news", f"SELECT * REPLACE ({ymd('score_date')} AS score_date) FROM news")
oracle("silver_financial_signal", f"""
    SELECT record_id, isin, ticker, {ymd('date_cloture_exercice')} AS date_cloture_exercice, ca, ebitda, dette_nette, fcf, ca_growth, marge_op,
           llm_prompt_version_num, financial_signal_run_id, {hms('extracted_at')} AS extracted_at FROM signal""")

# Text jobs --------------------------------------------------------------------------------------

NAMED = """
    SELECT name, min(p_partkey) AS first FROM (SELECT p_name AS name, p_partkey FROM part
        UNION ALL SELECT unnest(string_split(p_name, ' ')), p_partkey FROM part) GROUP BY name"""


def linked(titles: str, where: str = "true") -> dict[str, str]:
    """The best company of each title: all names score 100, so the first in order wins."""
    return {
        "names": NAMED,
        "titles": titles,
        "hits": rf"""
            SELECT p_partkey, first(name ORDER BY n.first, name) AS matched_name FROM titles JOIN names n
            ON {where} AND regexp_matches(title, '(?i)(^|[^a-zA-Z])' || name || '($|[^a-zA-Z])') GROUP BY p_partkey""",
    }


oracle("txt1_jn8_entity_link", """
    SELECT p_partkey, title || ' - shop.com' AS title, matched_name, CASE WHEN matched_name IS NOT NULL THEN 100.0::DOUBLE END AS match_score,
           'I-' || matched_name AS isin, 'T-' || matched_name AS ticker_bourso FROM titles LEFT JOIN hits USING (p_partkey)""",
       **linked("SELECT p_partkey, p_name || ' by ' || p_brand AS title FROM part"))
oracle("txt2_matched_by_category", "SELECT category, p_partkey, matched_name FROM titles JOIN hits USING (p_partkey)",
       **linked("SELECT p_partkey, p_type AS category, p_brand || ' ' || p_name AS title FROM part"))
BENCHMARK_WORDS = r"""
    SELECT name, min(item_id) AS item FROM (SELECT item_id, unnest(regexp_split_to_array(text, '\s+')) AS name FROM benchmark)
    WHERE name <> '' GROUP BY name"""
# a short name that is no word of the title is a part of one: its length is the longest common subsequence
oracle("txt1_entity_link_documents", r"""
    SELECT doc_id, best.name AS matched_name, best.score AS match_score, 'I-' || best.name AS isin,
           CASE WHEN best.name IS NOT NULL THEN 'T' END AS ticker_bourso
    FROM documents LEFT JOIN best USING (doc_id)""",
       words=BENCHMARK_WORDS,
       titles=r"""SELECT doc_id, lower(trim(regexp_replace(text, '\s+-\s+\S+\.\S{2,4}$', ''))) AS title FROM documents""",
       parted="""SELECT doc_id, title, list_filter(list_distinct(regexp_split_to_array(title, '\\s+')), lambda w: w <> '') AS held FROM titles""",
       runs="SELECT doc_id, unnest(list_distinct(regexp_extract_all(title, '[a-zA-ZÀ-ɏ]+'))) AS run FROM titles",
       met=r"""SELECT doc_id, name, item FROM runs JOIN words ON run = lower(name)
               UNION ALL
               SELECT doc_id, name, item FROM titles JOIN words ON NOT regexp_full_match(name, '[a-zA-ZÀ-ɏ]+') AND contains(title, lower(name))
               WHERE regexp_matches(title, '(^|[^a-zA-ZÀ-ɏ])' || regexp_escape(lower(name)) || '($|[^a-zA-ZÀ-ɏ])')""",
       hits=r"""SELECT doc_id, name, item, length(array_to_string(held, ' ')) AS size, list_contains(held, lower(name)) AS word
                FROM met JOIN parted USING (doc_id) WHERE upper(name) NOT IN ('OPTION', 'FOCUS', 'DIRECT', 'CAPITAL', 'CONTACT', 'VISION')""",
       scored="""SELECT *, CASE WHEN length(name) > 6 OR word THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * length(name) / (length(name) + size) END AS score
                 FROM hits""",
       best="""SELECT doc_id, first({'name': name, 'score': score} ORDER BY score DESC, item, name) AS best FROM scored WHERE score >= 80 GROUP BY doc_id""")
oracle("txt1_short_names", f"""
    SELECT title, best.name AS matched_name, {r('best.score', 6)} AS match_score FROM titles LEFT JOIN best USING (title)""",
       words=BENCHMARK_WORDS,
       names="""SELECT name, first(item ORDER BY item, word) AS item, first(word ORDER BY item, word) AS word
                FROM (SELECT regexp_extract(name, '^([a-zA-ZÀ-ɏ]+)', 1) AS name, item, name AS word FROM words) WHERE name <> '' GROUP BY name""",
       titles=r"SELECT DISTINCT unnest(regexp_split_to_array(text, '\s+')) AS title FROM documents",
       runs="SELECT title, unnest(list_distinct(regexp_extract_all(lower(title), '[a-zA-ZÀ-ɏ]+'))) AS run FROM titles",
       scored="""SELECT title, name, item, word, CASE WHEN length(name) > 6 OR lower(title) = run THEN 100.0::DOUBLE
                 ELSE 200.0::DOUBLE * length(name) / (length(name) + length(title)) END AS score
                 FROM runs JOIN names ON lower(name) = run WHERE upper(name) NOT IN ('OPTION', 'FOCUS', 'DIRECT', 'CAPITAL', 'CONTACT', 'VISION')""",
       best="""SELECT title, first({'name': name, 'score': score} ORDER BY score DESC, item, word) AS best FROM scored
               WHERE score >= 80 GROUP BY title""")
oracle("txt3_doc_relevance", f"SELECT record_id, {relevance(True)} AS relevance_score, {relevance(False)} AS threshold_score FROM filings")

SPACE = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"
BLOCKS = rf"""
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS place, block
    FROM (SELECT doc_id, n, regexp_replace(part, {SPACE}, '', 'g') AS block
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part, unnest(range(length(text) - length(replace(text, chr(10), '')) + 1)) AS n
                FROM documents))
    WHERE block <> ''"""
MATCHABLE = "replace(replace(lower(block), '’', ''''), chr(160), ' ')"
EDGE_BEFORE, EDGE_AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
SCORE = (
    rf"(CASE WHEN regexp_matches({MATCHABLE}, '{EDGE_BEFORE}\p{{N}}+(?:[.,]\p{{N}}+)?[\s\p{{Z}}]*(?:million|millions|thousand|billion|[km]?eur){EDGE_AFTER}') THEN 3 ELSE 0 END)"
    rf" + (CASE WHEN regexp_matches({MATCHABLE}, '{EDGE_BEFORE}20\p{{N}}{{2}}{EDGE_AFTER}') THEN 1 ELSE 0 END) + "
    + " + ".join(f"(CASE WHEN contains({MATCHABLE}, {text(k)}) THEN {v} ELSE 0 END)" for k, v in (KEYWORDS | PROSE_KEYWORDS).items())
)
SCORED = f"SELECT doc_id, place, block, {SCORE} AS score FROM blocks"
oracle("txt4_split_blocks", "SELECT doc_id, place, md5(block) AS block FROM blocks", blocks=BLOCKS)
oracle("txt5_score_blocks", "SELECT doc_id, place, score FROM scored", blocks=BLOCKS, scored=SCORED)
oracle("txt6_financial_context", rf"""
    SELECT doc_id, length(context) AS chars, md5(context) AS context FROM (
        SELECT d.doc_id, regexp_replace(left(CASE WHEN b.doc_id IS NULL THEN replace(d.text, chr(10), chr(10) || ' ' || chr(10))
               WHEN b.context IS NULL THEN b.first_block ELSE b.context END, 600), {SPACE}, '', 'g') AS context
        FROM documents d LEFT JOIN taken b ON b.doc_id = d.doc_id)""",
       blocks=BLOCKS, scored=SCORED,
       ranked="SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS rn FROM scored WHERE score > 0",
       filled="SELECT *, sum(length(block) + CASE WHEN rn > 1 THEN 7 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY rn) AS used FROM ranked WHERE rn <= 15",
       taken="""SELECT doc_id, string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rn) FILTER (WHERE used <= 600) AS context,
                       first(block ORDER BY rn) AS first_block FROM filled GROUP BY doc_id""")
oracle("txt7_extraction_status", """
    SELECT 'R' || doc_id AS record_id, status AS extraction_status,
           CASE WHEN status = 'success' THEN '2023-12-31' END AS date_cloture_exercice_raw,
           CASE WHEN status = 'success' THEN doc_id || ' million EUR' END AS ca_raw, CASE WHEN status = 'success' THEN '3 %' END AS ca_growth_raw,
           NULL AS ebitda_raw, NULL AS marge_op_raw, NULL AS dette_nette_raw, NULL AS fcf_raw, length(body) AS text_length,
           CASE status WHEN 'empty_text' THEN 'Extracted PDF text is empty.' WHEN 'no_financial_data' THEN 'All financial fields are null.' END AS error_message
    FROM (SELECT *, CASE WHEN body IS NULL THEN 'pdf_parse_or_process_error' WHEN doc_id % 11 = 0 THEN 'empty_text'
                         WHEN doc_id % 8 = 3 THEN CASE WHEN doc_id % 3 = 0 THEN 'llm_rate_limited' ELSE 'llm_error' END
                         WHEN doc_id % 8 = 0 THEN 'no_financial_data' WHEN doc_id % 8 = 1 THEN 'llm_invalid_json'
                         WHEN doc_id % 8 = 2 THEN 'pdf_parse_or_process_error' ELSE 'success' END AS status
          FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN ' ' || chr(10) || ' ' WHEN doc_id % 17 <> 0 THEN text END AS body FROM documents))""")
SIGNALS = f"""
    SELECT o_orderkey, o_orderkey % 6 AS shape, {pick(NAMES, 'o_orderkey')} AS dirigeant, {pick(DATES, 'o_orderkey')} AS date_signal,
           o_orderkey % {len(AMOUNTS)} AS kind, 'Company ' || o_custkey AS societe, {owner('o_custkey')} AS isin, 'R' || o_orderkey AS record_id,
           CASE WHEN o_orderkey % 2 = 0 THEN {owner('o_custkey')} ELSE 'TK' END AS ticker
    FROM orders, (VALUES (0), (1)) AS copies(copy) WHERE o_orderkey % 6 <> 5 AND (copy = 0 OR o_orderkey % 6 <= 2)"""
CLEANED = "[1250.5, 1250.75, 2500.0, 32.5, 0.0, 0.0, 0.0][kind + 1]::DOUBLE"
GIVEN = "[1250.5, NULL, 0.0, NULL, NULL, NULL, 0.0][kind + 1]::DOUBLE"
KEPT = "ticker, date_signal, dirigeant, 'Unknown' AS qualite, 'Achat' AS type_operation, {} AS montant, record_id AS source_record_id, societe, isin"
oracle("txt8_parse_signals", "SELECT record_id, count(*) AS signals FROM answered GROUP BY 1", answered=SIGNALS)
oracle("txt9_amount_clean", f"SELECT record_id, {CLEANED} AS montant FROM answered", answered=SIGNALS)
oracle("txt10_txt11_strict_insider_signals", f"""
    SELECT {KEPT.format(CLEANED)} FROM answered WHERE dirigeant IN ('Jean Dupont', 'Marie Anne Martin', '  Paul   Durand ')
       AND date_signal IN ('2026-03-05', '2026-3-5')""", answered=SIGNALS)
oracle("txt10b_scheduled_insider_signals", f"""
    SELECT {KEPT.format(GIVEN).replace("'Unknown' AS", "NULL::VARCHAR AS").replace("ticker,", "nullif(ticker, isin) AS ticker,", 1)} FROM answered WHERE shape <= 2
       AND dirigeant IN ('Jean Dupont', 'Marie Anne Martin', 'Nestlé Holding', 'Anne Marie De La Tour', '  Paul   Durand ')""", answered=SIGNALS)

# Serving ----------------------------------------------------------------------------------------

oracle("q1_latest_technical_scores", f"""
    SELECT isin, company_name, yf_ticker, {ymd('date')} AS date, close, score_technique, score_7d_avg, {FIVE}
    FROM stocks WHERE is_latest""")
oracle("q3_latest_composite", f"""
    SELECT * EXCLUDE (snapshot_date) REPLACE ({ymd('score_date')} AS score_date) FROM composite""")
oracle("q4_latest_news_scores", f"SELECT * REPLACE ({ymd('score_date')} AS score_date) FROM news")
oracle("q5_insider_signals_45d", f"""
    SELECT isin, societe, {ymd('signal_date')} AS signal_date, insider_names, num_operations, {r('total_amount', 2)} AS total_amount, score_1_10
    FROM insider i WHERE i.signal_date >= {DAY} - 45""")
oracle("q6_latest_fundamentals", f"""
    SELECT {PERIOD}, isin, score_fondamental, ca_growth_pct, marge_op_pct, levier_dette_ebitda, fcf_yield_pct, nb_metrics, coverage_score
    FROM last_report""")
oracle("q9_company_lookup", """
    SELECT name, ticker_bourso, composite_score FROM composite WHERE name LIKE '%00000000%' OR ticker_bourso = 'T12'""")
oracle("q9_news_lookup", "SELECT matched_name, investment_score FROM news WHERE matched_name LIKE '%er 1%' OR ticker_bourso = 'T7'")
ONE = f"title, {hms('published_at')} AS published_at, sentiment_score, sentiment_reason"
oracle("q10_recent_articles", f"SELECT {ONE} FROM sentiment s WHERE isin = 'FR0000000003' ORDER BY s.published_at DESC, row_id LIMIT 5")
oracle("q11_articles_driving_score", f"""
    SELECT {ONE} FROM sentiment s WHERE isin = 'FR0000000003' AND s.published_at >= {NOW} - INTERVAL 45 DAY""")
oracle("q12_threshold_screens", """
    SELECT isin, composite_score, score_financials, score_news, 'strong' AS screen FROM composite WHERE composite_score > 6
    UNION ALL SELECT isin, composite_score, score_financials, score_news, 'solid' FROM composite WHERE score_financials >= 8
    UNION ALL SELECT isin, composite_score, score_financials, score_news, 'bad press' FROM composite WHERE score_news < 3""")
BEST = "SELECT * FROM composite ORDER BY composite_score DESC, isin LIMIT 5"
oracle("q13_profile_matrix", " UNION ALL ".join(
    f"SELECT isin, name, '{d}' AS dimension, {d} AS score FROM best" for d in ("score_news", "score_stock", "score_insider", "score_financials")
), best=BEST)
oracle("q13_signal_heatmap", " UNION ALL ".join(
    f"SELECT isin, '{s.strip()}' AS signal, {s.strip()} AS points FROM leaders" for s in FIVE.split(",")
), leaders="SELECT * FROM stocks WHERE is_latest ORDER BY score_technique DESC, score_7d_avg DESC, isin DESC LIMIT 10")
oracle("q14_news_scatter", "SELECT isin, matched_name, mention_count_45d, avg_sentiment_45d, investment_score FROM news")
oracle("q14_growth_margin_scatter", f"""
    SELECT {PERIOD}, ca_growth_pct, marge_op_pct, score_fondamental FROM financials WHERE ca_growth_pct IS NOT NULL AND marge_op_pct IS NOT NULL""")
oracle("jn2_financials_with_names", f"""
    SELECT coalesce(company_name, ticker) AS company_name, {PERIOD}, score_fondamental
    FROM financials f LEFT JOIN (SELECT isin, company_name FROM stocks WHERE is_latest) s USING (isin)""")

# Quality ----------------------------------------------------------------------------------------

oracle("dq1_dq3_dq4_row_rules", " UNION ALL ".join([
    f"SELECT 'not_null({x})' AS rule, 'error' AS severity, count(*) FILTER (WHERE {x} IS NULL) AS failures FROM filings"
    for x in ("record_id", "isin", "publication_ts", "pdf_url")
] + [
    """SELECT 'accepted_values(pdf_download_status)', 'error',
              count(*) FILTER (WHERE pdf_download_status NOT IN ('success', 'failed', 'http_error')) FROM filings""",
    """SELECT 'accepted_range(pdf_file_size_bytes)', 'warn',
              count(*) FILTER (WHERE pdf_file_size_bytes NOT BETWEEN 100 AND 50000) FROM filings""",
]))
oracle("dq2_dq5_unique", """
    SELECT 'unique(record_id)' AS rule, 'error' AS severity, count(*) AS failures FROM (SELECT record_id FROM staging GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique(isin, Date)', 'error', 0
    UNION ALL SELECT 'unique(isin, Date)', 'error', count(*) FROM (
        SELECT isin, date FROM raw_bars WHERE isin IS NOT NULL GROUP BY ALL HAVING count(*) > 1)""")
oracle("dq6_min_rows", "SELECT 'min_rows(1000000)' AS rule, 'error' AS severity, greatest(1000000 - count(*), 0) AS failures FROM bars")
oracle("dq_financial_signal_report", """
    SELECT 'not_null(record_id)' AS rule, 'error' AS severity, 0 AS failures
    UNION ALL SELECT 'not_null(financial_signal_run_id)', 'error', 0 UNION ALL SELECT 'not_null(extracted_at)', 'error', 0
    UNION ALL SELECT 'not_null(loaded_at)', 'error', 0
    UNION ALL SELECT 'accepted_range(ca_growth)', 'warn', count(*) FILTER (WHERE ca_growth NOT BETWEEN -1000 AND 10000) FROM signal
    UNION ALL SELECT 'accepted_range(marge_op)', 'warn', count(*) FILTER (WHERE marge_op NOT BETWEEN -1000 AND 10000) FROM signal
    UNION ALL SELECT 'unique(record_id)', 'error', 0 UNION ALL SELECT 'min_rows(10)', 'error', 0""")
oracle("dq_article_report", """
    SELECT 'not_null(row_id)' AS rule, 'error' AS severity, 0 AS failures UNION ALL SELECT 'not_null(isin)', 'error', 0
    UNION ALL SELECT 'not_null(title)', 'error', 0 UNION ALL SELECT 'not_null(source)', 'error', 0
    UNION ALL SELECT 'accepted_values(source)', 'error', count(*) FILTER (WHERE source = 'abcbourse_rss') FROM articles
    UNION ALL SELECT 'unique(row_id)', 'error', 0""")

# Incremental and streaming ----------------------------------------------------------------------

oracle("inc1_newer_than_target", f"""
    SELECT row_id, link, p.source, {hms('fetched_at')} AS fetched_at FROM parts p LEFT JOIN marks m ON m.source = p.source
    WHERE m.mark IS NULL OR p.fetched_at > m.mark""",
       marks="""SELECT source, max(fetched_at) AS mark FROM parts WHERE fetched_at < TIMESTAMP '2024-01-20' AND source <> 'abcbourse_rss'
                GROUP BY source""")
BEST_VERSION = """row_number() OVER (PARTITION BY record_id ORDER BY llm_prompt_version_num DESC, extracted_at DESC, financial_signal_run_id DESC)"""
oracle("inc2_lookback_merge", f"""
    SELECT record_id, llm_prompt_version_num, {hms('extracted_at')} AS extracted_at FROM (SELECT *, {BEST_VERSION} AS rn FROM offered) WHERE rn = 1""",
       stored=f"SELECT * EXCLUDE (rn) FROM (SELECT *, {BEST_VERSION} AS rn FROM versions WHERE extracted_at < TIMESTAMP '2024-01-05') WHERE rn = 1",
       offered="""SELECT * FROM stored UNION ALL SELECT * FROM versions
                  WHERE extracted_at >= (SELECT max(extracted_at) - INTERVAL 7 DAY FROM stored)""")
FIRST = "extracted_at < TIMESTAMP '2024-01-15' AND financial_signal_run_id <> 'fs-3'"
oracle("inc2_lookback_stream", f"""
    SELECT record_id, llm_prompt_version_num, financial_signal_run_id, {hms('extracted_at')} AS extracted_at
    FROM (SELECT *, {BEST_VERSION} AS rn FROM versions
          WHERE {FIRST} OR extracted_at > (SELECT max(extracted_at) - INTERVAL 7 DAY FROM versions WHERE {FIRST})) WHERE rn = 1""")
oracle("inc3_rolling_month_rewrite", f'SELECT isin, {ymd("date")} AS "Date", volume AS "Volume" FROM clean WHERE clean.date >= DATE \'2024-01-01\'')
oracle("inc4_full_refresh", f"SELECT * REPLACE ({ymd('snapshot_date')} AS snapshot_date) FROM companies")
oracle("inc5_snapshot_idempotent", """
    SELECT name, isin, ticker_bourso, '2024-01-31' AS snapshot_date FROM companies
    UNION ALL SELECT 'Old ' || name, isin, ticker_bourso, '2023-12-31' FROM companies""")
oracle("inc6_stream_unseen", """
    SELECT user_id, coalesce(max(value) FILTER (WHERE event_type = 'purchase' AND value > 80), max(value)) AS value FROM events GROUP BY user_id""")
oracle("inc7_retry_state", f"""
    SELECT o.record_id, o.isin, {hms('o.publication_ts')} AS publication_ts
    FROM old_rows o LEFT JOIN new_rows n ON n.record_id = o.record_id
    WHERE o.pdf_url IS NOT NULL AND o.isin IS NOT NULL AND CASE WHEN n.record_id IS NULL THEN {AGAIN.replace('pdf_', 'o.pdf_')} ELSE n.isin IS NULL END""",
       old_rows=OLD, new_rows=NEW)
oracle("str1_dropped_bars", """
    SELECT isin, count(*) AS bars, count(*) FILTER (WHERE volume % 2 = 1)::BIGINT AS dropped FROM bars GROUP BY isin""")
oracle("str2_stream_daily_bars", f"""
    SELECT 'U' || user_id AS isin, {ymd('ts::DATE')} AS "Date", first(value ORDER BY ts, event_id) AS "Open", max(value) AS "High", min(value) AS "Low",
           last(value ORDER BY ts, event_id) AS "Close", sum(event_id % 9)::BIGINT AS "Volume"
    FROM events GROUP BY user_id, ts::DATE""")
oracle("str2_batch_daily_bars", f"SELECT {ohlc('yf_ticker')} FROM bars")
