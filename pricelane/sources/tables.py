"""Page, watchlist and feed sources; dated and CSV sinks."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from pricelane.fixed_values import LISTING_COLUMNS
from pricelane.operators.nested import json_items
from pricelane.sources import json_arrays

PAGE_SCHEMA = (
    "retailer string, page_kind string, url_no int, url string, page_no int, "
    "fetched_at timestamp, html string"
)


DATED_SCHEMA = (
    "name string, promotion_price double, original_price double, condition string, Brand string, "
    "Volume double, Unit string, Pack string, Retailer string, Date date"
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored page snapshots, one row per fetched page."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    """Watched addresses ``retailer, url`` from CSV with a header."""
    return spark.read.schema("retailer string, url string").option("header", True).csv(path)


def search_names(spark: SparkSession, names: list[str]) -> DataFrame:
    """Names to search for, as a local table whose size the optimizer knows."""
    return spark.createDataFrame(pa.table({"product_name": pa.array(names, pa.string())}))


def read_items(spark: SparkSession, path: str, arrays: bool = False) -> DataFrame:
    """Nested product feed: JSON lines, or files that hold one JSON array each.

    Array files are cut into byte ranges like lines are, so a large one is read by many tasks.
    """
    if arrays:
        return json_items(json_arrays.read_records(spark, path).withColumnRenamed("record", "json"))
    raw = spark.read.schema("data string").json(path)
    record = F.concat(F.lit('{"data":'), F.coalesce("data", F.lit("null")), F.lit("}"))
    return json_items(raw.select(record.alias("json")))


#: Bytes of a row group in a stored listing: small enough that a search by name skips most of a file.
ROW_GROUP_BYTES = 8 << 20


def clustered(df: DataFrame, *places: str) -> DataFrame:
    """Rows of each place in order of their names, a hot place over many tasks, small leftovers merged."""
    return df.hint("rebalance", *places).sortWithinPartitions(*places, "name")


def indexed(writer: DataFrameWriter) -> DataFrameWriter:
    """Small row groups with a Bloom filter of their names; with ``clustered`` their name ranges hardly overlap."""
    return writer.options(
        **{"parquet.block.size": str(ROW_GROUP_BYTES), "parquet.bloom.filter.enabled#name": "true"}
    )


def write_dated(listing: DataFrame, path: str) -> None:
    """Store a listing by retailer and day; writing a day again replaces that day.

    The rebalance hint sizes the files: small leftovers are merged and a shop
    that holds most rows is split over many tasks. Rows lie by name within a
    file, so that a search for names reads the row groups that may hold them.
    """
    writer = clustered(listing, "Retailer", "Date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    indexed(writer).partitionBy("Retailer", "Date").parquet(path)


def read_dated(
    spark: SparkSession, path: str, columns: tuple[str, ...], schema: str = DATED_SCHEMA
) -> DataFrame:
    """A stored listing; a folder without files gives no rows."""
    return spark.read.schema(schema).parquet(path).select(*columns)


def find_names(spark: SparkSession, path: str, names: list[str], columns: tuple[str, ...] = LISTING_COLUMNS) -> DataFrame:
    """Rows of a stored listing with one of a few names, through the row groups that may hold them.

    Each name is a filter of its own for the scan, as a list of names is only known to it by its least and greatest.
    """
    rows = read_dated(spark, path, columns)
    if not names:
        return rows.where(F.lit(False))
    return rows.where(reduce(Column.__or__, (F.col("name") == name for name in dict.fromkeys(names))))


# Quotes are doubled, outer spaces belong to the value.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).csv(path)
