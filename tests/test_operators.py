import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelane.operators import arranging, cleaning, dedupe, filters, joins, nested, summary
from pricelane.sources import tables

DAY = datetime.date(2025, 3, 3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sightings(spark, n=3000):
    """A third of the rows share one name, some have none."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "Unknown")
        .when(F.col("id") % 101 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string")))
        .alias("name"),
        F.pmod(F.col("id") * 7919, F.lit(n)).alias("seq"),
        (F.col("id") % 7).cast("double").alias("price"),
    )


@pytest.mark.parametrize("parts", [1, 17])
def test_dedupe_first_is_independent_of_partitions(spark, parts):
    rows = sightings(spark)
    expected = {}
    for r in rows.collect():
        if r["name"] not in expected or r["seq"] < expected[r["name"]]:
            expected[r["name"]] = r["seq"]
    got = {r["name"]: r["seq"] for r in dedupe.dedupe_first(rows.repartition(parts), ["seq"]).collect()}
    assert got == expected


def test_dedupe_first_aggregates_before_its_shuffle(spark):
    assert "partial_min_by" in plan(dedupe.dedupe_first(sightings(spark), ["seq"]))


def paged(spark, *pages, url="u"):
    rows = [(url, no, pos, name) for no, names in pages for pos, name in enumerate(names)]
    return spark.createDataFrame(rows, "url string, page_no int, pos int, name string")


def kept_pages(df):
    return sorted({(r["url"], r["page_no"]) for r in dedupe.drop_repeated_pages(df).collect()})


def test_drop_repeated_pages(spark):
    repeated = paged(spark, (0, "ab"), (1, "cd"), (2, "cd"), (3, "ef"))
    swapped = paged(spark, (0, "ab"), (1, "ba"), (2, "bac"), (3, "ba"), url="v")
    single = paged(spark, (0, "xy"), url="w")
    again = paged(spark, (5, ["n", None]), (6, ["n", None]), url="x")
    got = kept_pages(arranging.union_sources(repeated, swapped, single, again))
    assert got == [("u", 0), ("u", 1), ("v", 0), ("v", 1), ("v", 2), ("v", 3), ("w", 0), ("x", 5)]


def test_equal_fingerprints_alone_do_not_end_a_catalogue(spark, monkeypatch):
    monkeypatch.setattr(dedupe.F, "xxhash64", lambda *c: F.lit(0).cast("bigint"))
    df = paged(spark, (0, "ab"), (1, "cd"), (2, "cd"), (3, "ee"))
    assert kept_pages(df) == [("u", 0), ("u", 1)]


def test_new_items_per_page(spark):
    df = paged(spark, (0, "ab"), (1, "ab"), (2, "bc"))
    got = {r["page_no"]: r["new_items"] for r in dedupe.new_items_per_page(df, ["page_no", "pos"]).collect()}
    assert got == {0: 2, 1: 0, 2: 1}
    two = paged(spark, (0, "x"), url="a").union(paged(spark, (0, "y"), (1, "x"), url="b"))
    order = ["page_no", "pos"]
    rows = dedupe.new_items_per_page(two, order).collect()
    assert sorted((r["url"], r["page_no"], r["new_items"]) for r in rows) == [("a", 0, 1), ("b", 0, 1), ("b", 1, 1)]
    over_all = dedupe.new_items_per_page(two, [*order, "url"], catalogue=()).collect()
    assert sorted((r["page_no"], r["new_items"]) for r in over_all) == [(0, 2), (1, 0)]


def test_an_empty_page_ends_its_catalogue(spark):
    rows = paged(spark, (0, "ab"), (2, "cd")).union(paged(spark, (0, "e"), (1, "f"), url="v"))
    pages = spark.createDataFrame([("u", 0), ("u", 1), ("u", 2), ("v", 0), ("v", 1)], "url string, page_no int")
    left = dedupe.drop_repeated_pages(rows, pages).collect()
    assert sorted({(r["url"], r["page_no"]) for r in left}) == [("u", 0), ("v", 0), ("v", 1)]
    assert kept_pages(rows) == [("u", 0), ("u", 2), ("v", 0), ("v", 1)]


def test_null_order_values_keep_the_row(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("b", 2, 2.0), ("b", None, 3.0)], "name string, seq int, price double")
    got = sorted((r["name"], r["seq"], r["price"]) for r in dedupe.dedupe_first(rows, ["seq"]).collect())
    assert got == [("a", None, 1.0), ("b", None, 3.0)]


def test_seen_anti_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert sorted(str(r["name"]) for r in dedupe.seen_anti(rows, seen).collect()) == ["None", "b"]


def brute_search(search, offered):
    found = set()
    for name in {r["product_name"] for r in search}:
        hits = {(name, r["original_price"], r["promotion_price"], True) for r in offered if r["name"] == name}
        found |= hits or {(name, None, None, False)}
    return found


def test_search_join_reads_the_listing_once(spark, tmp_path):
    sightings(spark).select("name", F.col("price").alias("original_price"), "price").write.parquet(str(tmp_path / "l"))
    listing = spark.read.parquet(str(tmp_path / "l")).withColumnRenamed("price", "promotion_price")
    found = joins.search_join(tables.search_names(spark, ["n1", "Unknown", "nothing"]), listing)
    found.collect()
    assert plan(found).split("Initial Plan")[0].count("Scan parquet") == 1


def test_search_join_deals_the_pairs_of_a_hot_name(spark):
    offered = spark.range(900).selectExpr(
        "if(id % 3 = 0, concat('n', id), 'Unknown') as name", "cast(id as double) as original_price", "id / 2 as promotion_price"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.search_join(tables.search_names(spark, ["Unknown", "n3", "nothing"]), offered)
        assert found.groupBy("product_name").count().where("product_name = 'Unknown'").first()["count"] == 600
        text = plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pairs = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "original_price" in line.split("ENSURE")[0]]
    assert any(all(c in line for c in ("product_name", "original_price", "promotion_price")) for line in pairs)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_search_join_both_ways(spark, threshold):
    offered = sightings(spark).select(
        "name", F.col("price").alias("original_price"), (F.col("price") / 2).alias("promotion_price")
    )
    search = tables.search_names(spark, ["n1", "n2", "n2", "Unknown", "nothing"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = joins.search_join(search, offered).collect()
        flags = joins.found_flag(search, offered).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = [tuple(r[c] for c in ("product_name", "original_price", "promotion_price", "Found")) for r in got]
    assert len(rows) == len(set(rows))
    assert set(rows) == brute_search(search.collect(), offered.collect())
    assert sorted((r["product_name"], r["Found"]) for r in flags) == [
        ("Unknown", True), ("n1", True), ("n2", True), ("n2", True), ("nothing", False)
    ]


def test_lookups_with_repeated_entries_map_columns_and_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("product_name_vi"),
        F.create_map(F.lit("k"), F.lit(1)).alias("extra"),
    )
    dictionary = spark.createDataFrame([("hot", "b"), ("hot", "a"), ("n1", "one")], "product_name_vi string, translated string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.translate_lookup(rows, dictionary).groupBy("product_name_en").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counts = {r["product_name_en"]: r["count"] for r in got}
    assert (counts["a"], counts["one"], counts["n2"], sum(counts.values())) == (1000, 1, 1, 3000)


def test_badge_map(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, badge_url string")
    labels = spark.createDataFrame([("a", "Buy 1 Get 1"), ("b", None)], "badge_url string, label string")
    def got(keep):
        return {r["i"]: r["condition"] for r in joins.badge_map(rows, labels, keep_unknown=keep).collect()}
    assert got(False) == {1: "Buy 1 Get 1", 2: None, 3: None, 4: None}
    assert got(True) == {1: "Buy 1 Get 1", 2: None, 3: "c", 4: None}


def test_watchlist_coverage(spark):
    watch = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u1",), ("u4",)], "url string")
    tries = spark.createDataFrame(
        [
            ("u1", 1, False, "x", 1.0, 1.0, None),
            ("u1", 2, True, "old", 1.0, 1.0, "c"),
            ("u1", 3, True, "new", None, 2.0, None),
            ("u2", 1, False, "x", 1.0, 1.0, None),
            ("u9", 1, True, "other", 1.0, 1.0, None),
            ("u4", None, True, "no number", 1.0, 1.0, None),
        ],
        "url string, attempt int, ok boolean, name string, promotion_price double, original_price double, "
        "condition string",
    )
    got = sorted((r["url"], r["name"], r["original_price"]) for r in summary.watchlist_coverage(watch, tries).collect())
    missing = "Blocked or Not Found"
    assert got == [("u1", "new", 2.0), ("u1", "new", 2.0), ("u2", missing, None), ("u3", missing, None), ("u4", "no number", 1.0)]


def test_run_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "url string, ok boolean, ts timestamp")
    row = summary.run_summary(empty).first()
    assert (row["n_success"], row["n_requested"], row["n_attempts"], row["elapsed_seconds"]) == (0, 0, 0, None)


def test_union_needs_the_same_columns_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, i int")
    assert [tuple(r) for r in arranging.union_sources(a, b, a).collect()] == [(1, "x")] * 3
    with pytest.raises(Exception):
        arranging.union_sources(a, b.drop("s"))


def test_sort_name_puts_nulls_first_in_byte_order(spark):
    rows = spark.createDataFrame([("b", 1), ("B", 2), (None, 3), ("ก", 4), ("b", 0)], "name string, i int")
    assert [r["i"] for r in arranging.sort_name(rows, ["i"]).collect()] == [3, 2, 0, 1, 4]
    assert [r["i"] for r in arranging.ordered_tail(rows, ["i"], 2).collect()] == [3, 4]


def test_dated_table_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "listing")
    rows = spark.createDataFrame(
        [("Soap 5 kg", 1.0, 2.0, None)],
        "name string, promotion_price double, original_price double, condition string",
    )
    first = cleaning.standardize(rows, "makro", DAY)
    tables.write_dated(first, path)
    tables.write_dated(cleaning.standardize(rows, "makro", DAY + datetime.timedelta(1)), path)
    tables.write_dated(cleaning.standardize(rows, "bigc", DAY), path)
    tables.write_dated(arranging.union_sources(first, first), path)
    counts = {
        (r["Retailer"], r["Date"].day): r["count"]
        for r in tables.read_dated(spark, path, ("Retailer", "Date")).groupBy("Retailer", "Date").count().collect()
    }
    assert counts == {("Makro", 3): 2, ("Makro", 4): 1, ("BigC", 3): 1}


def test_brand_and_price_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "listing")
    rows = spark.createDataFrame(
        [("Soap 5 kg", 1.0, 2.0, None)],
        "name string, promotion_price double, original_price double, condition string",
    )
    tables.write_dated(cleaning.standardize(rows, "makro", DAY), path)
    wanted = filters.brand_price_filter(spark.read.parquet(path), ["Soap", "Pao"], 1, 5)
    text = plan(wanted.where("Retailer = 'Makro'").select("name"))
    assert "In(Brand" in text and "GreaterThanOrEqual(original_price" in text
    assert "Retailer" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "condition" not in text.split("ReadSchema: ")[1]


def test_feed_records_without_parts(spark):
    texts = [
        '{"data": {"data": {"item": {"item_id": 1, "models": [{"model_id": 5, "name": "m"}]}, "product_price": {}}}}',
        '{"data": {"data": {"item": {}}}}',
        '{"data": {"data": {"item": {"image": "x"}}}}',
        '{"data": {"data": {"item": {"item_id": null, "price": 12.5}}}}',
        '{"data": {"data": null}}',
        '{"error": 1}',
        "no json",
    ]
    items = nested.json_items(spark.createDataFrame([(t,) for t in texts], "json string"))
    assert nested.json_flatten(items).count() == 7
    assert nested.json_flatten(items).where("price is not null").first()["price"] == 12.5 / 100000
    full = nested.json_nonempty(items)
    assert [r["item_id"] for r in nested.json_optional_field(full).collect()] == [1, None, None]
    models = nested.json_explode_models(items).collect()
    assert [(r["model_id"], r["price"], r["status"]) for r in models] == [(5, 0.0, None)]


def test_standardize_rejects_unknown_shops(spark):
    with pytest.raises(ValueError):
        cleaning.standardize(spark.range(1), "corner-shop", DAY)


def test_columns_have_their_types(spark, folder):
    """The checks compare some columns as text; here they keep their types."""
    import checks.queries as checked

    flat = dict(nested.json_flatten(checked.items(spark, folder)).dtypes)
    assert flat == {"item_id": "bigint", "shop_id": "bigint", "title": "string", "price": "double", "price_before_discount": "double"}
    listing = dict(checked.makro_tables(spark, folder)["listing"].dtypes)
    assert (listing["Date"], listing["promotion_price"], listing["Volume"]) == ("date", "double", "double")


def test_stored_tables_can_be_cleared(spark):
    from pricelane import session

    first, second = (session.stored(spark.range(2), "to-clear") for _ in range(2))
    assert first.count() + second.count() == 4
    assert session.clear_stored(spark, "to-clear") == 2
