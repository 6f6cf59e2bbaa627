import datetime

import pytest

from pricelane.operators import summary
from pricelane.sources import run_store
from pricelane.sources.run_store import Run

DAY, NEXT = datetime.date(2025, 3, 3), datetime.date(2025, 3, 4)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "runs")


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def found(spark, root, kind, **where):
    return sorted(tuple(r) for r in run_store.read_kind(spark, root, kind, **where).select("name", "shop", "run_date").collect())


def test_a_day_is_replaced_in_all_kinds(spark, root):
    run_store.publish(spark, root, [Run("7-Eleven / ก", DAY, {"listing": names(spark, "old"), "watchlist": names(spark, "old")})])
    run_store.publish(spark, root, [Run("7-Eleven / ก", DAY, {"listing": names(spark, "new", "new")}), Run("Tops", DAY, {"listing": names(spark, "t")})])
    assert found(spark, root, "listing") == [("new", "7-Eleven / ก", DAY), ("new", "7-Eleven / ก", DAY), ("t", "Tops", DAY)]
    assert run_store.read_kind(spark, root, "watchlist").count() == 0
    assert run_store.manifest(spark, root).count() == 4
    assert {r["n_rows"] for r in run_store.current(spark, root).collect()} == {2, 1}


def test_a_killed_write_is_not_seen(spark, root, monkeypatch):
    run_store.publish(spark, root, [Run("Tops", DAY, {"listing": names(spark, "good"), "search": names(spark, "good")})])
    whole = run_store.write_table

    def killed(df, root, kind, run, number):
        if kind == "search":
            raise RuntimeError("killed")
        return whole(df, root, kind, run, number)

    monkeypatch.setattr(run_store, "write_table", killed)
    with pytest.raises(RuntimeError):
        run_store.publish(spark, root, [Run("Tops", DAY, {"listing": names(spark, "half"), "search": names(spark, "half")})])
    assert found(spark, root, "listing") == [("good", "Tops", DAY)] == found(spark, root, "search")
    left = run_store.unpublished_runs(spark, root, "listing").collect()
    assert [r["n_rows"] for r in left] == [1]


def test_days_shops_and_unlike_columns(spark, root):
    wide = spark.createDataFrame([("w", "https://x")], "name string, url string")
    run_store.publish(spark, root, [Run("Lotus", DAY, {"watchlist": wide}), Run("Tops", NEXT, {"watchlist": names(spark, "t")})])
    rows = run_store.read_kind(spark, root, "watchlist").orderBy("shop").collect()
    assert [(r["name"], r["url"]) for r in rows] == [("w", "https://x"), ("t", None)]
    assert found(spark, root, "watchlist", shop="Tops") == found(spark, root, "watchlist", first=NEXT) == [("t", "Tops", NEXT)]
    assert found(spark, root, "watchlist", last=DAY) == [("w", "Lotus", DAY)]
    later = run_store.read_kind(spark, root, "watchlist", first=datetime.date(2030, 1, 1))
    assert later.count() == 0 and later.columns == ["name", "url", "shop", "run_date"]


def test_empty_tables_and_an_empty_store(spark, root):
    assert run_store.read_kind(spark, root, "listing").count() == 0
    run_store.publish(spark, root, [Run("Tops", DAY, {"listing": names(spark)})])
    assert found(spark, root, "listing") == []
    assert run_store.current(spark, root).first()["n_rows"] == 0


def test_columns_of_the_store_and_unlike_types_are_refused(spark, root):
    with pytest.raises(ValueError, match="columns of the store"):
        run_store.publish(spark, root, [Run("Tops", DAY, {"listing": spark.createDataFrame([("a",)], "Shop string")})])
    run_store.publish(spark, root, [Run("A", DAY, {"x": names(spark, "a")}), Run("B", DAY, {"x": spark.createDataFrame([(1,)], "name int")})])
    with pytest.raises(ValueError, match="name is"):
        run_store.read_kind(spark, root, "x")


def test_only_named_partitions_are_read(spark, root):
    for day in (DAY, NEXT):
        run_store.publish(spark, root, [Run("Tops", day, {"listing": names(spark, str(day))})])
    plan = run_store.read_kind(spark, root, "listing", first=NEXT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "run#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_totals_come_with_the_write(spark, tmp_path):
    attempts = spark.createDataFrame(
        [("a", True, datetime.datetime(2025, 1, 1)), ("a", False, datetime.datetime(2025, 1, 1, 0, 1)), ("b", False, datetime.datetime(2025, 1, 1, 0, 0, 2))],
        "url string, ok boolean, ts timestamp",
    )
    read = spark.sparkContext.accumulator(0)
    counted = attempts.rdd.map(lambda r: (read.add(1), r)[1]).toDF(attempts.schema)
    rows, totals = summary.observed_attempts(counted)
    rows.write.parquet(str(tmp_path / "attempts"))
    assert totals.get == summary.run_summary(attempts).first().asDict() == {"n_success": 1, "n_requested": 2, "n_attempts": 3, "elapsed_seconds": 60.0}
    assert read.value == 3  # every attempt was read once
