from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelane.functions import prices
from pricelane.functions.promos import promo_flag, promo_label
from pricelane.functions.text import strict_double, strict_long
from pricelane.operators import cleaning

AMOUNTS = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 5.5, 99.0, 120.0]))


def one(spark, text, build):
    return spark.createDataFrame([(text,)], "t string").select(build(F.col("t"))).first()[0]


def many(spark, texts, build):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = frame.select("i", build(F.col("t")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def test_lenient_casts(spark):
    texts = ["1.8", " 12 ", "1d", "1.2.3", ".", "", "N/A", "5.", ".5", "12", "-3", "1e3", "nan", None]
    assert many(spark, texts, strict_double) == [
        1.8, None, None, None, None, None, None, 5.0, 0.5, 12.0, -3.0, 1000.0, None, None
    ]
    assert many(spark, texts, strict_long) == [
        None, None, None, None, None, None, None, None, None, 12, -3, None, None, None
    ]


def test_price_texts(spark):
    texts = ["฿ 1,290.00", "฿  35 ", "1,000", "free", "", "1.2.3", None]
    assert many(spark, texts, prices.price_from_text) == [1290.0, 35.0, 1000.0, None, None, None, None]
    assert many(spark, texts, prices.price_strip_currency) == [1290.0, 35.0, 1000.0, None, None, None, None]
    assert many(spark, ["1.234.000 đ", "9,500đ", "đ", "x1"], prices.price_integer_strip) == [
        1234000, 9500, None, None
    ]


def test_promo_label(spark):
    cases = {
        "BUV 2 GET 1": "Buy 2 Get 1",
        "1แถม1": "Buy 1 Get 1",
        "SUPER SAVE": "Supersave",
        "Buy 3 Cheaper": "Buy 3 Cheaper",
        "ประหยัด 20": "Supersave",
        "GET": "Buy 1 Get",
        "cheaper": "Buy 2 Cheaper",
        "  ": None,
        "NEW": "NEW",
        " NEW in ": "NEW in",
        "Buy 21 GET 1": "Buy 1 Get 1",
        "ซื้อ 3 แถม 1": "Buy 3 Get 1",
        None: None,
    }
    assert many(spark, list(cases), promo_label) == list(cases.values())


def test_promo_flag(spark):
    assert many(spark, ["buy now", "ซื้อ", "new 2 you", "save", "แถม", None], promo_flag) == [
        True, True, True, False, True, None
    ]


def price_frame(spark, pairs):
    return spark.createDataFrame(
        [(i, p, o) for i, (p, o) in enumerate(pairs)],
        "i int, promotion_price double, original_price double",
    )


def collected(df):
    return [(r["promotion_price"], r["original_price"]) for r in sorted(df.collect(), key=lambda r: r["i"])]


@settings(max_examples=5, deadline=None)
@given(pairs=st.lists(st.tuples(AMOUNTS, AMOUNTS), min_size=1, max_size=30))
def test_price_rules_settle(spark, pairs):
    frame = price_frame(spark, pairs)
    filled = cleaning.reevaluate_price(frame)
    assert collected(filled) == collected(cleaning.reevaluate_price(filled))
    assert all(p is None or p != o for p, o in collected(filled))
    ordered = cleaning.reevaluate_price_swap(frame)
    assert collected(ordered) == collected(cleaning.reevaluate_price_swap(ordered))
    assert all(p is None or p < o for p, o in collected(ordered))
    assert collected(cleaning.reevaluate_price_swap(filled)) == collected(ordered)


def test_fake_original_comes_back_when_filled(spark):
    frame = price_frame(spark, [(50.0, 50.0), (40.0, 50.0)])
    bare = cleaning.nullify_fake_original(frame)
    assert collected(bare) == [(50.0, None), (40.0, 50.0)]
    assert collected(cleaning.reevaluate_price(bare)) == [(None, 50.0), (40.0, 50.0)]


def test_discount(spark):
    frame = price_frame(spark, [(75.0, 100.0), (2.0, 3.0), (5.0, None), (1.0, 0.0)])
    rows = cleaning.with_discount_pct(frame).orderBy("i").collect()
    assert [r["discount_pct"] for r in rows] == [25.0, 33.3, None, None]
