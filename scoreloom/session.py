"""Session settings, and where intermediate tables go."""

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "scoreloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Rows one task of a sort or a large aggregation should hold.
ROWS_A_TASK = 100_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks `rows` rows are dealt to: the session's number of shuffle partitions, more where that would overfill them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


_local_root: str | None = None
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master may run without it; there a temporary folder serves, since driver and
    executors are one machine.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="scoreloom-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nothing else uses, below the shared folder."""
    return f"{shared_root(spark)}/scoreloom/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once and read it back.

    Used where a plan needs the same rows in several branches: the work happens once, the lineage
    is cut, lost executors do not matter, and sums whose last digit depends on the order of
    partial results are the same in every branch.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def discard(*written: DataFrame) -> None:
    """Empty the tables behind results of `staged` that nothing reads any more; others are left alone."""
    for df in written:
        if path := _places.pop(df, None):
            df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)
