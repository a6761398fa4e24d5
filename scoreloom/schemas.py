"""Column contracts of the tables, by layer and name, as DDL strings."""

from pyspark.sql import types as T

BARS = "Date date, Open double, High double, Low double, Close double, Volume bigint"
MATCH = "matched_name string, match_score double, isin string, ticker_bourso string"
ENTRY = "title string, link string, published string, summary string, fetched_at string"
FIGURES = (
    "date_cloture_exercice_raw string, ca_raw string, ca_growth_raw string, ebitda_raw string, "
    "marge_op_raw string, dette_nette_raw string, fcf_raw string"
)
DOWNLOAD = (
    "pdf_download_status string, pdf_gcs_uri string, pdf_error_message string, pdf_http_status bigint, "
    "pdf_content_type string, pdf_file_size_bytes bigint, pdf_last_check_ts timestamp_ntz, pdf_download_run_id string"
)
FILING = (
    "societe string, isin string, ticker string, publication_ts timestamp_ntz, pdf_url string, titre string, "
    "sous_type string, type_information string, source string, run_id string, ingestion_ts timestamp_ntz"
)

# Where each table lives: layer -> name -> columns.
TABLES = {
    "bronze": {
        "listing": "name string, ticker_bourso string, isin string, detail_url string, last string, variation string, "
        "high string, low string, volume string, raw_data_ist_init string, ingested_at timestamp_ntz",
        "ohlcv": f"{BARS}, Dividends double, `Stock Splits` double, isin string, yf_ticker string, "
        "ingested_at timestamp_ntz",
        "feed_entries": f"feed_name string, {ENTRY}, {MATCH}",
        "site_entries": f"guid string, title string, link string, description string, published timestamp_ntz, "
        f"ingested_at timestamp_ntz, {MATCH}",
        "filings": f"record_id string, {FILING}, {DOWNLOAD}",
    },
    "work": {
        "financial_signal_staging": "record_id string, isin string, ticker string, source_url string, "
        f"pdf_gcs_uri string, document_publication_ts timestamp_ntz, {FIGURES}, document_text_excerpt string, "
        "text_length bigint, page_count bigint, parser_used string, llm_model string, llm_prompt_version string, "
        "extraction_status string, error_message string, raw_llm_response string, source string, "
        "source_run_id string, financial_signal_run_id string, extracted_at timestamp_ntz",
        "download_staging": f"record_id string, {DOWNLOAD}",
    },
    "silver": {
        "companies": "name string, isin string, ticker_bourso string, snapshot_date date",
        "ohlcv_clean": f"{BARS}, isin string, yf_ticker string",
        "ohlcv": f"{BARS}, isin string, yf_ticker string, RSI_14 double, MACD double, MACD_signal double, "
        "BB_upper double, BB_lower double, SMA_50 double, SMA_200 double, EMA_20 double, computed_at timestamp_ntz",
        "articles": "row_id string, title string, link string, summary string, matched_name string, "
        "match_score double, isin string, ticker_bourso string, fetched_at timestamp_ntz, source string, "
        "published_at timestamp_ntz",
        "insider_signals": "ticker string, date_signal string, dirigeant string, qualite string, "
        "type_operation string, montant double, source_record_id string, url_doc string, societe string, "
        "isin string, processed_at timestamp_ntz, extraction_method string",
    },
    "gold": {
        "article_sentiment": "row_id string, isin string, ticker_bourso string, matched_name string, title string, "
        "published_at timestamp_ntz, sentiment_score bigint, sentiment_reason string, groq_model string, "
        "scored_at timestamp_ntz",
        "score_news": "isin string, ticker_bourso string, matched_name string, mention_count_45d bigint, "
        "avg_sentiment_45d double, investment_score bigint, score_date date",
        "score_insider": "isin string, societe string, signal_date date, insider_names string, "
        "num_operations bigint, total_amount double, raw_score double, score_1_10 double",
        "company_scores": "isin string, name string, ticker_bourso string, snapshot_date date, score_news double, "
        "score_stock double, score_insider double, score_financials double, composite_score double, score_date date",
    },
}


def schema(layer: str, table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[layer][table])


def table_path(root: str, layer: str, table: str) -> str:
    """A table's folder: the layer is named as is, with no environment prefix."""
    return f"{root.rstrip('/')}/{layer}/{table}"
