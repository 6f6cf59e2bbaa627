"""Limits that a user may widen: both sides of each edge."""

from pyspark.sql import functions as F

from pricelane.functions import text_nodes, urls


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def texts(*values):
    return F.array(*map(F.lit, values))


def test_name_length(spark):
    assert one(spark, text_nodes.texts_name(texts("0123456789"))) is None
    assert one(spark, text_nodes.texts_name(texts("0123456789a"))) == "0123456789a"
    assert one(spark, text_nodes.texts_name(texts("0123456789"), longer_than=9)) == "0123456789"


def test_price_range(spark):
    shown = texts("5", "5.1", "9999", "10000")
    assert one(spark, text_nodes.texts_prices(shown)) == [5.1, 9999.0]
    assert one(spark, text_nodes.texts_prices(shown, between=(4, 10001))) == [5.0, 5.1, 9999.0, 10000.0]


def test_price_line_window(spark):
    lines = texts("Code: 1", *["x"] * 14, "77", "88")
    assert one(spark, text_nodes.price_lines(lines, F.lit("n"))) == ["77"]
    assert one(spark, text_nodes.price_lines(lines, F.lit("n"), window_lines=16)) == ["77", "88"]


def test_tier_window(spark):
    block = texts("Buy more, save more", *["x"] * 17, "2+ units", "฿ 9")
    assert one(spark, text_nodes.quantity_tiers(block)) == {"2+ units": "฿ 9"}
    assert one(spark, text_nodes.quantity_tiers(block, window_texts=18)) == {}


def test_short_address(spark):
    assert one(spark, urls.url_short(F.lit("a/" + "b" * 60))) == "b" * 50
    assert one(spark, urls.url_short(F.lit("a/" + "b" * 60), characters=55)) == "b" * 55
