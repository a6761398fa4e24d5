"""Regulatory filings: mapping, merging, and the download queue."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import clock
from scoreloom.operators.keyed import merge

SOURCE = "amf"

# Names of the raw fields and of the columns they become.
RAW_FIELDS = {
    "record_id": "recordid",
    "societe": "identificationsociete_iso_nom_soc",
    "isin": "identificationsociete_iso_cd_isi",
    "publication_ts": "uin_dat_amf",
    "pdf_url": "url_de_recuperation",
    "titre": "informationdeposee_inf_tit_inf",
    "sous_type": "sous_type_d_information",
    "type_information": "type_d_information",
}

# Download outcomes worth another try, and HTTP codes that are final.
RETRY_STATUS = ["failed", "empty_file"]
GONE = [404, 410]

UPDATED_BY_INGEST = ["societe", "isin", "ticker", "publication_ts", "pdf_url", "titre", "sous_type",
                     "type_information", "source", "run_id", "ingestion_ts"]
UPDATED_BY_DOWNLOAD = ["pdf_download_status", "pdf_gcs_uri", "pdf_error_message", "pdf_http_status",
                       "pdf_content_type", "pdf_file_size_bytes", "pdf_last_check_ts", "pdf_download_run_id"]


def conform_filings(raw: DataFrame, run_id: str, as_of: dt.datetime) -> DataFrame:
    """Raw records (with the target's `ticker`) in the columns of the filings table."""
    named = {name: F.col(field) for name, field in RAW_FIELDS.items()}
    named["publication_ts"] = clock.iso_timestamp(named["publication_ts"])
    return raw.select(
        named["record_id"].alias("record_id"), named["societe"].alias("societe"), named["isin"].alias("isin"), "ticker",
        *[named[c].alias(c) for c in ("publication_ts", "pdf_url", "titre", "sous_type", "type_information")],
        F.lit(SOURCE).alias("source"), F.lit(run_id).alias("run_id"), clock.at(as_of).alias("ingestion_ts"),
    )


def merge_filings(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New and changed filings; what the downloads wrote about a filing stays."""
    return merge(stored, new, ["record_id"], UPDATED_BY_INGEST)


def merge_downloads(stored: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Download outcomes of known filings; others are ignored."""
    return merge(stored, outcomes, ["record_id"], UPDATED_BY_DOWNLOAD, insert=False)


def download_candidates(filings: DataFrame, limit: int | None = None) -> DataFrame:
    """Filings never tried, or failed in a way that may pass; newest first."""
    status, code = F.col("pdf_download_status"), F.col("pdf_http_status")
    again = (
        status.isNull()
        | status.isin(RETRY_STATUS)
        | ((status == "http_error") & (code.isNull() | ~code.isin(GONE)))
    )
    rows = filings.where(F.col("pdf_url").isNotNull() & F.col("isin").isNotNull() & again).select(
        "record_id", "isin", "publication_ts", "pdf_url", "source", F.col("run_id").alias("source_run_id")
    )
    rows = rows.orderBy(F.desc_nulls_last("publication_ts"), "record_id")
    return rows if limit is None else rows.limit(limit)
