"""Session settings, lineage cuts and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. Partition counts come from AQE, which also
# splits skewed joins; page batches stay small because one page may hold megabytes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "pricelane", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """The same rows from a table written to the shared folder.

    For results that several later steps read. It cuts the lineage, so a lost
    executor forces no new page walk; later steps read only the columns they
    need; and the optimizer plans with the real size instead of a guess.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession, *labels: str) -> int:
    """Delete the tables that ``stored`` wrote under these labels; call it when their readers are done."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for label in labels:
        found = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{label}-*")
        files = found.getFileSystem(conf)
        for status in files.globStatus(found) or ():
            gone += bool(files.delete(status.getPath(), True))
    return gone


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, from file or row sizes; nothing runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small input one task per core before work that is heavy per row.

    Scans cut large inputs into enough tasks by themselves; only inputs below
    one file-open cost per core come in too few, and only those are shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    if estimated_bytes(df) >= cores * conf.filesOpenCostInBytes():
        return df
    return df.repartition(cores, *keys)
