import datetime
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pricelane.fixed_values import LISTING_COLUMNS
from pricelane.operators import arranging
from pricelane.sources import tables

DAY = datetime.date(2025, 3, 3)


def listing(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("item "), F.lpad((F.col("id") * 7919 % n).cast("string"), 7, "0")).alias("name"),
        F.rand(1).alias("promotion_price"), F.rand(2).alias("original_price"), F.sha2(F.col("id").cast("string"), 256).alias("condition"),
        F.lit("b").alias("Brand"), F.lit(1.0).alias("Volume"), F.lit("kg").alias("Unit"), F.lit("1").alias("Pack"),
        F.when(F.col("id") % 3 == 0, "Tops").otherwise("Makro").alias("Retailer"), F.lit(DAY).alias("Date"),
    )


def scanned(df):
    """Rows that the scan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_search_reads_few_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROW_GROUP_BYTES", 128 << 10)
    rows = listing(spark, 60_000)
    tables.write_dated(rows, str(tmp_path))
    files = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    parts = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_row_groups for m in parts) > 10
    for m in parts:  # ranges of names follow each other
        name = next(i for i in range(m.num_columns) if m.schema.column(i).name == "name")
        stats = [m.row_group(g).column(name).statistics for g in range(m.num_row_groups)]
        assert all(a.max <= b.min for a, b in zip(stats, stats[1:]))
    found = tables.find_names(spark, str(tmp_path), ["item 0000007", "item 0059000", "gone"])
    assert scanned(found) < 60_000 / 4
    want = rows.where("name in ('item 0000007', 'item 0059000')").select(*LISTING_COLUMNS)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert tables.find_names(spark, str(tmp_path), []).count() == 0


def test_names_that_no_file_holds_are_skipped_by_their_filter(spark, tmp_path):
    tables.write_dated(listing(spark, 5000), str(tmp_path))
    assert scanned(tables.find_names(spark, str(tmp_path), ["item 0000007x"])) == 0  # inside every range of names


def test_a_hot_name_spreads_over_sort_ranges(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("name"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = arranging.sort_name(rows).withColumn("range", F.spark_partition_id())
        found = placed.where("name = 'hot'").groupBy("range").count().collect()
        assert len(found) > 1 and sum(r["count"] for r in found) == 10_000
        names = [r["name"] for r in arranging.sort_name(rows).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    nulls = sum(n is None for n in names)
    assert set(names[:nulls]) == {None} and names[nulls:] == sorted(names[nulls:])


def test_names_of_rows_with_maps_are_sorted(spark):
    rows = spark.createDataFrame([("b", {"x": 1}), ("a", None)], "name string, m map<string, int>")
    assert [r["name"] for r in arranging.sort_name(rows).collect()] == ["a", "b"]
