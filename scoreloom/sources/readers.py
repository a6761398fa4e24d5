"""Reading company lists, overrides, raw filings and listing pages."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.answers import listing_figures, unescape
from scoreloom.functions.numbers import blank_to_null
from scoreloom.functions.text import code_in_html, is_code, nonblank
from scoreloom.operators.keyed import first_per_key
from scoreloom.plans.filings import RAW_FIELDS, conform_filings

# Place of a row in its input: file, split, then row of the split.
INPUT_ORDER = ["_file", "_split", "_row"]


def with_input_order(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_split": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def read_company_list(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header names trimmed and lowered; an empty frame where there is no file."""
    try:
        df = spark.read.csv(path, header=True)
    except AnalysisException:
        return spark.createDataFrame([], "name string, isin string, ticker_bourso string").transform(_no_order)
    # header names are normalised first: the order columns must not be renamed
    ordered = with_input_order(df)
    return ordered.toDF(*[c if c in INPUT_ORDER else c.strip().lower() for c in ordered.columns])


def _no_order(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in INPUT_ORDER})


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"CSV must contain an '{column}' column.")


def read_referential(spark: SparkSession, path: str) -> DataFrame:
    """(name, isin, ticker_bourso, ordinal): codes of 12 characters, the first row of each."""
    rows = read_company_list(spark, path)
    _require(rows, "name")
    _require(rows, "isin")
    if "ticker_bourso" not in rows.columns:
        rows = rows.withColumn("ticker_bourso", F.lit(None).cast("string"))
    valid = rows.where(F.length("isin") == 12)
    return first_per_key(valid, ["isin"], [F.col(c) for c in INPUT_ORDER]).select(
        "name", "isin", "ticker_bourso", F.struct(*INPUT_ORDER).alias("ordinal")
    )


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(isin, ticker): valid codes in upper case, the first non-empty ticker of each."""
    rows = read_company_list(spark, path)
    _require(rows, "isin")
    _require(rows, "ticker_bourso")
    ticker = blank_to_null(F.trim("ticker_bourso"))
    return (
        rows.where(is_code(F.col("isin")))
        .groupBy(F.upper(F.trim("isin")).alias("isin"))
        .agg(F.min_by(ticker, F.when(ticker.isNotNull(), F.struct(*INPUT_ORDER))).alias("ticker"))
    )


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(isin, ticker) from JSON maps, one per file; empty where there is no file."""
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "isin string, ticker string")
    return texts.select(F.explode(F.from_json("value", "map<string,string>")).alias("isin", "ticker"))


def read_raw_filings(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as texts of known fields; `_broken` holds a line that is not JSON."""
    fields = ", ".join(f"{f} string" for f in [*RAW_FIELDS.values(), "_broken"])
    lines = spark.read.schema(fields).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
    return with_input_order(lines)


def filing_line_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("_broken").isNotNull()).alias("broken_lines"),
        F.count(RAW_FIELDS["record_id"]).alias("with_record_id"),
    )


def filings_in_scope(raw: DataFrame, targets: DataFrame) -> DataFrame:
    """Readable records of target companies, the first per record id; a blank id repeats freely."""
    company, record = F.col(RAW_FIELDS["isin"]), F.col(RAW_FIELDS["record_id"])
    readable = raw.where(F.col("_broken").isNull()).withColumn("_isin", F.upper(F.trim(company)))
    wanted = readable.join(targets.withColumnRenamed("isin", "_isin"), "_isin")
    named = wanted.where(nonblank(record)).withColumn("_record", F.trim(record))
    once = first_per_key(named, ["_record"], [F.col(c) for c in INPUT_ORDER]).drop("_record")
    return once.unionByName(wanted.where(~F.coalesce(nonblank(record), F.lit(False)))).drop("_isin")


def read_filings(
    spark: SparkSession, path: str, targets: DataFrame, run_id: str, as_of: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """(raw records in scope, the same as rows of the filings table)."""
    scope = filings_in_scope(read_raw_filings(spark, path), targets)
    return scope.select(*RAW_FIELDS.values()), conform_filings(scope, run_id, as_of)


def _attribute(tag: str, name: str):
    """Value of an attribute in double or single quotes."""
    quoted = F.coalesce(
        blank_to_null(F.regexp_extract(tag, rf'(?is)\s{name}\s*=\s*"([^"]*)"', 1)),
        blank_to_null(F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*'([^']*)'", 1)),
    )
    return quoted


def parse_listing(pages: DataFrame, base_url: str) -> DataFrame:
    """Company rows of listing pages (columns url, html): ticker, name, link and figures.

    A row is a table row with the data-ist-init attribute; its link is the first one into /cours/.
    """
    tr = r"(?is)(<tr\b[^>]*\sdata-ist-init\s*=(?:(?!</tr>).)*)</tr>"
    link = r"(?is)<a\b[^>]*\shref\s*=\s*[\"'][^\"']*/cours/[^>]*>.*?</a>"
    rows = pages.select(
        *[c for c in pages.columns if c != "html"],
        F.posexplode(F.regexp_extract_all("html", F.lit(tr), F.lit(1))).alias("position", "row"),
    ).withColumns(
        {"_tag": F.regexp_extract("row", r"(?is)^<tr\b[^>]*>", 0), "_link": F.regexp_extract("row", link, 0)}
    )

    def words(html):
        return blank_to_null(F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]*>", " "), r"\s+", " ")))

    href = unescape(_attribute(F.col("_link"), "href"))
    site = F.regexp_extract(F.lit(base_url), r"^[a-z]+://[^/]+", 0)
    absolute = (
        F.when(href.rlike(r"^[a-z]+://"), href)
        .when(href.startswith("/"), F.concat(site, href))
        .otherwise(F.concat(F.regexp_extract(F.lit(base_url), r"^.*/", 0), href))
    )
    blob = _attribute(F.col("_tag"), "data-ist-init")
    parsed = rows.withColumns(
        {
            "name": unescape(F.coalesce(words(F.col("_link")), words(F.col("row")))),
            "ticker_bourso": unescape(_attribute(F.col("_tag"), "data-ist")),
            "detail_url": absolute,
            "raw_data_ist_init": unescape(blob),
            "_figures": listing_figures(blob),
        }
    )
    some = F.coalesce("ticker_bourso", "name", "detail_url").isNotNull()
    return parsed.where(some).select(
        *[c for c in pages.columns if c != "html"], "position", "name", "ticker_bourso", "detail_url", "_figures.*",
        "raw_data_ist_init",
    )


def first_listed(rows: DataFrame, order: list) -> DataFrame:
    """One row per ticker, else per name and link."""
    ticker = blank_to_null(F.col("ticker_bourso"))
    key = F.when(ticker.isNotNull(), F.struct(ticker.alias("a"), F.lit(None).cast("string").alias("b"))).otherwise(
        F.struct(F.col("name").alias("a"), F.coalesce("detail_url", F.lit("")).alias("b"))
    )
    return first_per_key(rows.withColumn("_key", key), ["_key"], order).drop("_key")


def isin_from_pages(pages: DataFrame) -> DataFrame:
    """The company code of each detail page, '' where it has none."""
    return pages.withColumn("isin", F.coalesce(code_in_html(F.col("html")), F.lit(""))).drop("html")
