"""Result tables of shop runs, published together.

A run of one shop on one day delivers several tables, such as the listing, the watchlist and the search result, each with
columns of its own. ``publish`` writes every table first, below ``tables/<kind>``, under the number of its run. Only then one
file is appended to the manifest, a row for each table. Readers go by the manifest alone:

* a write that was killed before the manifest is not seen, and the day's earlier run stays as it was;
* the latest run of a shop and day replaces the earlier one in all kinds at once, also in kinds that it does not deliver.

Numbers of rows are counted while the tables are written. The manifest grows by a few rows a shop and day;
tables are read by the partitions that it names.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricelane.sources.tables import clustered, indexed

MANIFEST = (
    "shop string, run_date date, version bigint, run string, kind string, columns string, "
    "n_rows bigint, published_at timestamp"
)
#: Partition columns of all kinds; tables must not have them.
PLACE = {"shop": "string", "run_date": "date", "run": "string"}


class Run(NamedTuple):
    """What one shop's run of one day delivers, by kind."""

    shop: str
    run_date: datetime.date
    tables: Mapping[str, DataFrame]


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row for each published table; none before the first run."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The manifest's rows of the latest run of each shop and day."""
    rows = manifest(spark, root)
    latest = rows.groupBy("shop", "run_date").agg(F.max(F.struct("version", "run")).alias("latest"))
    return rows.join(latest.select("shop", "run_date", "latest.*"), ["shop", "run_date", "version", "run"]).select(*rows.columns)


def write_table(df: DataFrame, root: str, kind: str, run: Run, number: str) -> int:
    """Write one table of a run; nobody sees it until the manifest names its run. Returns its number of rows."""
    clash = {c.lower() for c in df.columns} & set(PLACE)
    if clash:
        raise ValueError(f"{kind} has columns of the store: {sorted(clash)}")
    counted = Observation(f"rows-{kind}-{number}")
    placed = df.withColumns({"shop": F.lit(run.shop), "run_date": F.lit(run.run_date), "run": F.lit(number)})
    named = "name" in df.columns
    if named:  # a search by name then reads little of a file
        placed = clustered(placed, *PLACE)
    writer = placed.observe(counted, F.count(F.lit(1)).alias("n_rows")).write
    (indexed(writer) if named else writer).mode("append").partitionBy(*PLACE).parquet(f"{root}/tables/{kind}")
    return counted.get["n_rows"]


def publish(spark: SparkSession, root: str, runs: Iterable[Run]) -> DataFrame:
    """Write all tables of the runs, then make all of them visible at once; returns their manifest rows."""
    versions = {
        (r["shop"], r["run_date"]): r["version"]
        for r in manifest(spark, root).groupBy("shop", "run_date").agg(F.max("version").alias("version")).collect()
    }
    rows = []
    for run in runs:
        number = uuid.uuid4().hex
        version = versions[run.shop, run.run_date] = versions.get((run.shop, run.run_date), 0) + 1
        for kind, df in run.tables.items():
            n_rows = write_table(df, root, kind, run, number)
            rows.append((run.shop, run.run_date, version, number, kind, _columns(df), n_rows))
    published = spark.createDataFrame(rows, MANIFEST.rpartition(",")[0]).withColumn("published_at", F.lit(datetime.datetime.now(datetime.timezone.utc)))
    published.coalesce(1).write.mode("append").parquet(f"{root}/manifest")  # one file: all rows or none
    return published


def _merged(columns: Iterable[str]) -> dict[str, str]:
    """Columns of several tables of one kind, by first appearance."""
    from pyspark.sql.types import _parse_datatype_string

    merged: dict[str, str] = {}
    for ddl in columns:
        for field in _parse_datatype_string(ddl):
            kind = field.dataType.simpleString()
            if merged.setdefault(field.name, kind) != kind:
                raise ValueError(f"{field.name} is {merged[field.name]} in one run and {kind} in another")
    return merged


def read_kind(
    spark: SparkSession,
    root: str,
    kind: str,
    shop: str | None = None,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> DataFrame:
    """All rows of a kind from the latest runs, with ``shop`` and ``run_date``.

    A column that some shop's table lacks is null there. A kind that nobody delivered has no columns of its own.
    """
    named = current(spark, root).where(F.col("kind") == kind)
    columns = _merged(r["columns"] for r in named.orderBy("run_date", "shop").select("columns").collect())
    for limit in (
        None if shop is None else F.col("shop") == shop,
        None if first is None else F.col("run_date") >= first,
        None if last is None else F.col("run_date") <= last,
    ):
        named = named if limit is None else named.where(limit)
    runs = sorted(r["run"] for r in named.where("n_rows > 0").select("run").collect())
    fields = columns | PLACE
    ddl = ", ".join(f"`{n}` {k}" for n, k in fields.items())
    if not runs:
        return spark.createDataFrame([], ddl).drop("run")
    return spark.read.schema(ddl).parquet(f"{root}/tables/{kind}").where(F.col("run").isin(runs)).drop("run")


def unpublished_runs(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """``run, n_rows`` of written tables that the manifest does not name: killed or unfinished runs."""
    written = spark.read.parquet(f"{root}/tables/{kind}").groupBy("run").agg(F.count("*").alias("n_rows"))
    return written.join(manifest(spark, root).select("run").distinct(), "run", "left_anti")
