"""A corpus from `documents` in stages; each is written as Parquet and read again as the next one's documents.

1. language      documents whose text has no letter go
2. near copies   one document of each group of near duplicates (shingles of five words) stays, the one with the least doc_id
3. benchmark     documents that hold a passage of a test item go
4. private data  spans of personal data are replaced by their kind
5. tokens        every text becomes token ids

A row is one document, also where rows share a doc_id; repeated rows are near copies of each other, of which stage 2 keeps one.
Rows with a null doc_id go through like others; of those that are near copies of a document with an id, that one stays.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.llm import arrow, benchmarks, bpe, language, near, private
from scoreloom.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no language; the automata learn from the labelled rows outside the held-out fold.

    Where no row is labelled nothing is learned, and only texts without a letter are in no language.
    """
    arrow.small_batches(spark)
    learned = language.learn(language.training_rows(docs))
    if learned is None:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    return language.identify(docs.select(*COLUMNS), learned).where(F.col("lang_pred") != "und").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies, by shingles of five words.

    Rows are told apart by all their columns, so that those which share a doc_id are rows of their own; of rows equal in all one
    stays.
    """
    arrow.small_batches(spark)
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.xxhash64(*COLUMNS).alias("digest"))
    keyed = docs.select(*COLUMNS, key.alias("_key"))
    groups = near.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), words=5)
    kept = keyed.join(groups.where("kept").select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_semi")
    first = Window.partitionBy("_key").orderBy("doc_id")
    return kept.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that copy a test item."""
    arrow.small_batches(spark)
    copies = benchmarks.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(copies, docs.doc_id.eqNullSafe(copies.doc_id), "left_anti")


def without_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; n_chars follows the text."""
    return private.redacted(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids; a text's ids decode to its words."""
    arrow.small_batches(spark)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", with_language),
    ("near copies", one_of_each),
    ("benchmark", decontaminated),
    ("private data", without_private),
    ("tokens", as_tokens),
]

#: Language and near copies have no SQL form that runs over whole tables; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
