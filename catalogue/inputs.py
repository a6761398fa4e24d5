"""The library's inputs, derived from the driver's tables by Spark.

Whole tables are used everywhere.  Order and shipping dates are moved forward by a constant so
that prices, filings and news share one clock; a supplier is a company.
"""

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.plans import companies as company_plans
from scoreloom.session import tasks_for
from scoreloom.streaming.bars import daily_bars

AS_OF = dt.datetime(2024, 1, 31, 20, 0, 0)
PRICE_SHIFT, ORDER_SHIFT = 8123, 8218
UNITS = ["EUR", "thousand EUR", "million EUR", "billion EUR"]
TITLES = [
    "Résultats annuels de l'exercice", "Rapport financier semestriel", "Chiffre d'affaires du trimestre",
    "Déclaration DIRIGEANT - article 19", "Mise à disposition du document", "Rachat d'actions propres - dirigeant",
    "Annual financial report", "Half-year results", "Assemblée générale", "Déclaration personne exerçant",
    "Publication du rapport annuel",
]
SUBTYPES = ["Rapport annuel", "Information semestrielle", "Autre", "Revenue note", None]
TYPES = ["Informations réglementées continues", "Information réglementée", "Communiqué"]
STATUSES = ["success", "success", "failed", "http_error", "empty_file", "invalid_content_type", None]
HTTP_CODES = [404, 410, 500, None]


@functools.cache
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list, index) -> F.Column:
    """values[index % len(values)]"""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def code(key) -> F.Column:
    return F.concat(F.lit("FR"), F.lpad(key.cast("string"), 10, "0"))


def days(n: int) -> F.Column:
    return F.make_dt_interval(F.lit(n))


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def tasks(self, name: str) -> int:
        """Tasks for rows that are as many as those of a table; the count comes from the files' footers."""
        return tasks_for(self.spark, self.t(name).count())

    def company_count(self) -> F.Column:
        return self.t("supplier").agg(F.count(F.lit(1))).scalar()

    # companies ---------------------------------------------------------------------------------
    def listing(self) -> DataFrame:
        """Untidy listing rows: padded, lower case, every third company twice, a few without code."""
        s = self.t("supplier")
        key = F.col("s_suppkey")
        rows = s.select(
            F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias("name"),
            F.when(key % 17 == 5, None).when(key % 19 == 7, "  ")
            .otherwise(F.concat(F.lit(" "), F.lower(code(key)), F.lit(" "))).alias("isin"),
            F.concat(F.lit("T"), key.cast("string"), F.lit(" ")).alias("ticker_bourso"),
        )
        again = s.where(key % 3 == 0).select(
            F.concat(F.lit("Z "), F.col("s_name")).alias("name"), code(key).alias("isin"),
            F.concat(F.lit("Z"), key.cast("string")).alias("ticker_bourso"),
        )
        return rows.unionByName(again)

    def companies(self) -> DataFrame:
        return company_plans.companies(self.listing(), AS_OF)

    def snapshots(self) -> DataFrame:
        """Two monthly snapshots; names of the older one differ."""
        new = self.companies()
        old = new.withColumn("snapshot_date", F.date_sub("snapshot_date", 31)).withColumn(
            "name", F.concat(F.lit("Old "), F.col("name"))
        )
        return new.unionByName(old)

    # prices ------------------------------------------------------------------------------------
    def ticks(self) -> DataFrame:
        return self.t("lineitem").select(
            code(F.col("l_suppkey")).alias("isin"), (F.col("l_shipdate") + days(PRICE_SHIFT)).alias("ts"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("quantity"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        )

    def bars(self) -> DataFrame:
        order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
        ticker = F.concat(F.lit("T"), F.substring("isin", 3, 10).cast("bigint").cast("string"))
        return daily_bars(self.ticks(), order).withColumn("yf_ticker", ticker)

    def raw_bars(self) -> DataFrame:
        """Price rows as ingested: several per company and day, some without price or code."""
        price = F.col("l_extendedprice") / F.col("l_quantity")
        return self.t("lineitem").select(
            (F.col("l_shipdate").cast("date") + PRICE_SHIFT).alias("Date"),
            F.when(F.col("l_partkey") % 53 == 0, 0.0).otherwise(price).alias("Open"),
            (price * 1.25).alias("High"), (price * 0.75).alias("Low"),
            F.when(F.col("l_partkey") % 59 == 0, -1.0).when(F.col("l_partkey") % 59 == 1, float("nan")).when(
                F.col("l_partkey") % 59 == 2, float("inf")).otherwise(price).alias("Close"),
            F.col("l_quantity").cast("bigint").alias("Volume"),
            F.when(F.col("l_suppkey") % 31 != 30, code(F.col("l_suppkey"))).alias("isin"),
            F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("yf_ticker"),
            (F.lit("2024-02-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("l_orderkey"))).alias("ingested_at"),
            "l_linenumber", "l_partkey", "l_extendedprice",
        )

    def bar_ties(self) -> list:
        return [F.desc(c) for c in ("l_linenumber", "l_partkey", "l_extendedprice")]

    # filings -----------------------------------------------------------------------------------
    def owner(self, key) -> F.Column:
        return code(F.pmod(key, self.company_count()))

    def filings(self) -> DataFrame:
        k = F.col("o_orderkey")
        status = pick(STATUSES, k)
        return self.t("orders").select(
            F.concat(F.lit("R"), k.cast("string")).alias("record_id"),
            F.concat(F.lit("Company "), F.pmod("o_custkey", self.company_count()).cast("string")).alias("societe"),
            F.when(k % 23 != 11, self.owner(F.col("o_custkey"))).alias("isin"),
            F.concat(F.lit("T"), F.pmod("o_custkey", self.company_count()).cast("string")).alias("ticker"),
            F.when(k % 29 != 3, F.col("o_orderdate") + days(ORDER_SHIFT)).alias("publication_ts"),
            F.when(k % 31 != 7, F.concat(F.lit("https://filings.example/"), k.cast("string"))).alias("pdf_url"),
            pick(TITLES, k).alias("titre"), pick(SUBTYPES, k).alias("sous_type"),
            pick(TYPES, k).alias("type_information"), F.lit("amf").alias("source"),
            F.when(k % 10 == 0, "run-1").otherwise("run-2").alias("run_id"),
            F.lit("2024-01-31 06:00:00").cast("timestamp_ntz").alias("ingestion_ts"),
            status.alias("pdf_download_status"),
            F.when(status == "success", F.concat(F.lit("store/"), k.cast("string"), F.lit(".pdf"))).alias("pdf_gcs_uri"),
            F.lit(None).cast("string").alias("pdf_error_message"),
            F.when(status == "http_error", pick(HTTP_CODES, F.floor(k / 7))).cast("bigint").alias("pdf_http_status"),
            F.lit("application/pdf").alias("pdf_content_type"),
            (k * 10).alias("pdf_file_size_bytes"),
            F.lit("2024-01-30 00:00:00").cast("timestamp_ntz").alias("pdf_last_check_ts"),
            F.lit("d-1").alias("pdf_download_run_id"),
        )

    def staging(self) -> DataFrame:
        """Extraction attempts, two per record with different prompt versions."""
        k = F.col("o_orderkey")
        unit = pick(UNITS, F.floor(k / 2))
        money = lambda c: F.concat(c.cast("decimal(12,2)").cast("string"), F.lit(" "), unit)
        year = F.year(F.col("o_orderdate") + days(ORDER_SHIFT)).cast("string")
        rows = self.t("orders").join(
            self.t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey", "left"
        )
        company = F.pmod("o_custkey", self.company_count()).cast("string")
        return rows.select(
            F.concat(F.lit("R"), F.floor(k / 2).cast("string")).alias("record_id"),
            self.owner(F.col("o_custkey")).alias("isin"), F.concat(F.lit("T"), company).alias("ticker"),
            F.concat(F.lit("https://filings.example/"), k.cast("string")).alias("source_url"),
            F.concat(F.lit("store/"), k.cast("string"), F.lit(".pdf")).alias("pdf_gcs_uri"),
            (F.col("o_orderdate") + days(ORDER_SHIFT)).alias("document_publication_ts"),
            F.when(k % 41 == 5, F.concat(year, F.lit("-13-31"))).when(k % 43 == 9, F.lit("31/12/2023"))
            .otherwise(F.concat(year, F.lit("-12-31"))).alias("date_cloture_exercice_raw"),
            F.when(k % 7 != 0, money(F.col("o_totalprice"))).alias("ca_raw"),
            F.when(k % 5 != 0, F.concat((k % 41 - 20).cast("string"), F.lit("."), (k % 10).cast("string"), F.lit(" %")))
            .alias("ca_growth_raw"),
            F.when(k % 11 != 0, money(F.col("c_acctbal"))).alias("ebitda_raw"),
            F.when(k % 3 != 0, F.concat(F.lit("about "), (k % 37 - 9).cast("string"), F.lit("%"))).alias("marge_op_raw"),
            F.when(k % 13 == 0, "n/a").when(k % 17 == 0, "12 billion USD")
            .otherwise(money(F.floor(F.col("o_totalprice") / 16))).alias("dette_nette_raw"),
            F.when(k % 6 != 0, money(F.floor(F.col("c_acctbal") / 4))).alias("fcf_raw"),
            F.lit("pdfplumber").alias("parser_used"), F.lit("model-a").alias("llm_model"),
            F.when(k % 47 == 1, "draft").otherwise(F.concat(F.lit("v"), (k % 12).cast("string"))).alias("llm_prompt_version"),
            F.lit("amf").alias("source"), F.lit("run-2").alias("source_run_id"),
            F.concat(F.lit("fs-"), (k % 4).cast("string")).alias("financial_signal_run_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=k % 40000)).alias("extracted_at"),
            F.when(k % 10 == 9, "no_financial_data").when(k % 19 == 4, "llm_invalid_json").otherwise("success")
            .alias("extraction_status"),
        )

    def insider_table(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.t("orders").select(
            self.owner(F.col("o_custkey")).alias("isin"),
            F.concat(F.lit("Company "), F.pmod("o_custkey", self.company_count()).cast("string")).alias("societe"),
            F.col("o_orderpriority").alias("dirigeant"),
            F.when(F.col("o_orderstatus") == "F", "Achat").otherwise("Vente").alias("type_operation"),
            F.concat(F.lit("R"), F.floor(k / 2).cast("string")).alias("source_record_id"),
            F.col("o_totalprice").alias("montant"),
            F.date_format(F.col("o_orderdate") + days(ORDER_SHIFT), "yyyy-MM-dd").alias("date_signal"),
        )

    # news --------------------------------------------------------------------------------------
    def feed_entries(self) -> DataFrame:
        """Linked feed entries with repeats: the same headline and company fetched several times."""
        e = F.col("event_id")
        company = F.pmod("user_id", self.company_count())
        return self.t("events").select(
            "event_id", "event_type", "ts",
            F.concat(F.initcap("event_type"), F.lit(" note "), (e % 20).cast("string")).alias("title"),
            F.concat(F.lit("https://news.example/"), e.cast("string")).alias("link"),
            F.concat(F.lit("value "), F.col("props")).alias("summary"),
            F.when(e % 29 == 0, "soon").when(
                e % 5 == 1, F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200"))
            ).otherwise(F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).alias("published"),
            F.date_format(F.col("ts") + F.make_dt_interval(hours=F.lit(1)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("fetched_at"),
            F.concat(F.lit("Supplier "), company.cast("string")).alias("matched_name"),
            F.lit("100.0").alias("match_score"),
            F.when(e % 13 != 0, code(company)).alias("isin"),
            F.concat(F.lit("T"), company.cast("string")).alias("ticker_bourso"),
        )

    def feed_parts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        entries = self.feed_entries()
        yahoo = entries.where(F.col("event_type").isin("click", "error"))
        google = entries.where(F.col("event_type").isin("view", "signup"))
        site = entries.where("event_type = 'purchase'").withColumns(
            {"description": F.col("summary"), "published": F.col("ts"),
             "ingested_at": F.col("ts") + F.make_dt_interval(hours=F.lit(1))}
        )
        return yahoo, google, site

    def sentiment(self) -> DataFrame:
        e = F.col("event_id")
        company = F.pmod("user_id", self.company_count())
        return self.t("events").select(
            F.md5(e.cast("string")).alias("row_id"), code(company).alias("isin"),
            F.concat(F.lit("T"), company.cast("string")).alias("ticker_bourso"),
            F.concat(F.lit("Supplier "), company.cast("string")).alias("matched_name"),
            F.concat(F.initcap("event_type"), F.lit(" note "), (e % 20).cast("string")).alias("title"),
            F.col("ts").alias("published_at"), (e % 11).alias("sentiment_score"),
            F.concat(F.lit("reason "), (e % 7).cast("string")).alias("sentiment_reason"),
        )
