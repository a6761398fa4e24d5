"""The numbered operators as queries over the driver's tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import benchmarks, bpe, chat, language, licenses, maxent, near, negatives, pages, private, repeats, search, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_table(table(spark, sf_dir, "documents"))


@query
def op3_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_digest(table(spark, sf_dir, "documents"))


@query
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_chats(chat.with_control_strings(spark, table(spark, sf_dir, "conversations"))))


ORACLES["op7_chat_format"] = chat.ORACLE


@query
def op10_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op10_minhash_near"] = near.ORACLE


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmarks.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "last_word")


@query
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op6_near_vectors"] = vectors.ORACLE


@query
def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_search"] = search.ORACLE


@query
def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


ORACLES["op12_page_text"] = pages.ORACLE


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op13_hard_negatives"] = negatives.ORACLE
