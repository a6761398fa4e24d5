"""Writing tables: appends, rebuilds, partition rewrites, keyed merges, exports."""

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.keyed import merge, upsert
from scoreloom.session import staged


def conform(df: DataFrame, schema: T.StructType, policy: str = "sync") -> DataFrame:
    """`df` in the columns and types of `schema`.

    "sync" adds missing columns as NULL and drops unknown ones; "fail" raises for either.
    """
    wanted = {f.name for f in schema.fields}
    missing, unknown = wanted - set(df.columns), set(df.columns) - wanted
    if policy == "fail" and (missing or unknown):
        raise ValueError(f"columns differ: missing {sorted(missing)}, unknown {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def append_by_category(df: DataFrame, path: str, category: str = "category") -> None:
    """Rows appended below one folder per category; columns may grow over time."""
    df.write.mode("append").partitionBy(category).parquet(path)


def read_by_category(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Full rebuild in one job: readers never see half of it."""
    df.write.mode("overwrite").parquet(path)


def _months(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("month", F.trunc(date, "month"))


def overwrite_months(df: DataFrame, path: str, date: str, cluster: list, parts: int = 64) -> None:
    """Replace only the month folders present in `df`.

    A month is dealt to `parts` tasks by a digest of the cluster key, without a sampling pass: a big
    month is several tasks' work, a folder holds at most `parts` files, each sorted.
    """
    part = F.pmod(F.xxhash64(*cluster), F.lit(parts))
    rows = _months(df, date).repartition("month", part).sortWithinPartitions("month", *cluster, date)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def write_clustered(df: DataFrame, path: str, partition: str, cluster: list) -> None:
    """A partitioned table whose files hold ranges of the cluster key."""
    ordered = df.repartitionByRange(partition, *cluster).sortWithinPartitions(partition, *cluster)
    ordered.write.mode("overwrite").partitionBy(partition).parquet(path)


def write_snapshots(df: DataFrame, path: str, day: str) -> None:
    """Replace the snapshots whose days are present in `df`: one folder a day, so that readers of one day scan one folder."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def dump_run(raw: DataFrame, clean: DataFrame, root: str, run_id: str) -> None:
    """The unfiltered and the cleaned records of a run as JSON lines."""
    for name, df in (("raw", raw), ("clean", clean)):
        df.write.mode("overwrite").json(f"{root}/{name}/run_id={run_id}")


def export_csv(df: DataFrame, path: str, fields: list) -> None:
    """A CSV of a fixed field list; other columns are left out, missing ones are empty."""
    known = [F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields]
    df.select(*known).write.mode("overwrite").csv(path, header=True)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create a Parquet table in the catalog if absent, else add the columns it lacks."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
        return
    present = {c.name for c in spark.catalog.listColumns(name)}
    for f in schema.fields:
        if f.name not in present:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")


def overview(spark: SparkSession) -> DataFrame:
    """(dataset, table_name) of everything in the catalog."""
    rows = [
        (database.name, table.name)
        for database in spark.catalog.listDatabases()
        for table in spark.catalog.listTables(database.name)
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "dataset string, table_name string").orderBy("dataset", "table_name")


BUCKET = "_bucket"


class KeyedTable:
    """A Parquet table with a key, dealt into folders by a digest of the key.

    A batch reads and rewrites only the folders its keys fall into (dynamic partition overwrite);
    rows that are new for certain are appended.  A row with a NULL in its key matches nothing, and is
    dealt by a digest of all its columns, so that such rows fill no single folder.  `buckets` is fixed
    for the life of a table: about as many that a folder is one task's work.

    One writer at a time.  A folder is replaced when the job commits; a run that dies halfway is
    mended by running the batch again, since merging it twice gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets

    def _dealt(self, df: DataFrame) -> DataFrame:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        every = [f.name for f in self.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        digest = F.when(whole, F.xxhash64(*self.keys)).otherwise(F.xxhash64(*every))
        return df.withColumn(BUCKET, F.pmod(digest, F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, mode: str, overwrite: str = "dynamic") -> None:
        dealt = self._dealt(conform(df, self.schema)).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        dealt.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(BUCKET).parquet(self.path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or some of its folders; the filter on the partition column prunes the others."""
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            rows = self.spark.read.schema(stored).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def rows_near(self, batch: DataFrame) -> DataFrame:
        """The rows of the folders that the keys of `batch` fall into."""
        return self.read(self._touched(batch))

    def _touched(self, batch: DataFrame) -> list[int]:
        return [r[0] for r in self._dealt(conform(batch, self.schema)).select(BUCKET).distinct().collect()]  # `buckets` at most

    def write(self, df: DataFrame) -> None:
        """Full rebuild."""
        self._write(df, "overwrite", "static")

    def append(self, df: DataFrame) -> None:
        """Add rows whose keys the table does not have."""
        self._write(df, "append")

    def _rewrite(self, batch: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        batch = staged(batch, "batch")  # which folders it touches and what is merged come from one evaluation
        if touched := self._touched(batch):
            self._write(merged(self.read(touched), batch), "overwrite")

    def upsert(self, new: DataFrame) -> None:
        """`new` replaces the rows with the same key and adds the others."""
        self._rewrite(conform(new, self.schema), lambda old, batch: upsert(old, batch, self.keys))

    def merge(self, source: DataFrame, update: list[str], insert: bool = True) -> None:
        """MERGE of `source` (keys and `update` columns); the rest of a matched row stays."""
        self._rewrite(source, lambda old, batch: merge(old, batch, self.keys, update, insert))
