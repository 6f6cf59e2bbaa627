import pytest
from pyspark.sql import functions as F

from pricelane.sources import shop_pages


def pages(spark, *htmls):
    rows = [(i, f"https://shop.example/{i}", 1, h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "url_no int, url string, page_no int, html string")


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in sorted(df.collect(), key=lambda r: (r["url_no"], r["pos"]))]


def test_card_7e_name_choices(spark):
    html = (
        '<div class="item-list-wrapper"><a class="productlink" title="">x</a>'
        '<p class="item-description-cls-mobile"> From text </p></div>'
        '<div class="product-item"><a class="other" title="no">x</a></div>'
        '<div class="product-item"><a class="productlink" title=" As is ">x</a>'
        "<strong>1</strong><del>3</del><s>2</s>"
        '<i class="flag" style="url(/a/2get1-th.svg)"></i></div>'
    )
    got = rows_of(
        shop_pages.extract_card_7e(pages(spark, html, "<p>none</p>", None)),
        "name", "promotion_text", "original_text", "condition",
    )
    assert got == [
        ("From text", None, None, None),
        ("Unknown", None, None, None),
        (" As is ", "1", "3", "2GET1"),
    ]


def test_detail_7e_without_gallery_reads_whole_page(spark):
    html = '<h1>A</h1><i class="flag"></i><i class="flag" style="x-2get1"></i><i class="flag" style="1get1"></i>'
    got = rows_of(shop_pages.extract_detail_7e(pages(spark, html, "<p></p>")), "name", "condition")
    assert got == [("A", "2GET1"), ("Unknown Name", None)]


def test_card_makro_skips_thin_cards(spark):
    html = (
        '<a href="/en/p/1"><b>A long product name</b><i>฿ 20</i></a>'
        '<a href="/en/p/2"><b>A long product name</b><i>฿ 20</i><i>19.50</i></a>'
        '<a href="/en/p/3"><b>A long product name</b><i>each</i><i>3</i></a>'
        '<a href="/en/p/4"><b>short</b><i>฿ 20</i><i>each</i></a>'
        '<a href="/en/c/5"><b>A long category name</b><i>฿ 20</i><i>each</i></a>'
    )
    got = rows_of(shop_pages.extract_card_makro(pages(spark, html)), "name", "promotion_price", "original_price")
    assert got == [("A long product name", 19.5, 20.0)]


def test_price_makro_anchors(spark):
    coded = "<h1>Soap</h1><p>5</p><p>Code: 1</p><p>each</p><p>฿1,200</p><p>1,500.50</p><p>9</p>"
    named = "<h1>Soap</h1><p>7</p><p>Soap refill</p><p>8</p>"
    none = "<h1>Soap</h1>" + "<p>x</p>" * 16 + "<p>5</p>"
    got = rows_of(
        shop_pages.extract_price_makro(pages(spark, coded, named, none, "<p>5</p>")),
        "name", "promotion_text", "original_text",
    )
    assert got == [("Soap", "1200", "1500.50"), ("Soap", "8", "8"), ("Soap", None, None), (None, None, None)]


def test_tiers_makro(spark):
    html = (
        '<div data-test-id="x_product_title"> Soap </div><p>Buy More</p><p>Buy more, save more!</p>'
        "<p>1 - 1 units</p><p>2+ units</p><p>5+ units</p><p>฿ 10</p><p>฿</p><p>9</p><p>\"c\"</p>"
    )
    got = rows_of(shop_pages.extract_tiers_makro(pages(spark, html, "<p>unit 1 ฿ 2</p>")), "name", "condition")
    assert got == [
        ("Soap", '{"1 - 1 units": "฿ 10", "2+ units": "฿ 9"}'),
        ("Name not found", None),
    ]


def test_product_makro_is_both_walks(spark):
    html = (
        '<div data-test-id="x_product_title">Soap</div><p>Code : 1</p><p>10</p>'
        "<p>buy more save more</p><p>2 units</p><p>฿ 9</p>"
    )
    stored = pages(spark, html, "<h1>Other</h1><p>3</p>", "<p>no title</p>")
    joined = shop_pages.extract_price_makro(stored).join(
        shop_pages.extract_tiers_makro(stored).select("url", "condition"), "url"
    )
    columns = ("url", "name", "promotion_text", "original_text", "condition")
    assert rows_of(shop_pages.extract_product_makro(stored), *columns) == rows_of(joined, *columns)


def test_detail_bigc_removes_base_before_reading(spark):
    box = (
        '<h1>Soap</h1><div class="productDetail_product_price_new__x">฿1,290'
        '<div class="productDetail_product_baseprice__y">฿1,500<span class="productDetail_unit__z">/pc</span></div>'
        '<span class="productDetail_unit__z">/pc</span></div>'
    )
    blocked = "<h1>Just a moment...</h1>"
    html_blocked = "<h1>Soap</h1><p>Attention Required</p>"
    got = rows_of(
        shop_pages.extract_detail_bigc(pages(spark, box, blocked, html_blocked, "<h1>Bare</h1>")),
        "name", "promotion_price", "original_price", "badge_url",
    )
    # the unit inside the base price leaves with it, so the base price text is no number
    assert got == [("Soap", 1290.0, None, "null"), ("Bare", None, None, "null")]


def test_detail_lotus(spark):
    plain = '<h1>Soap</h1><div class="mui-style-kbur42">฿ 35.00/ each</div>'
    crossed = plain + '<div class="mui-style-1opqjiq">฿ 1,040</div>'
    blank = plain + '<div class="mui-style-1opqjiq"> </div>'
    banner = "<h1>Privacy Preference Center</h1>"
    got = rows_of(
        shop_pages.extract_detail_lotus(pages(spark, plain, crossed, blank, banner, "<p>x</p>")),
        "url", "promotion_price", "original_price",
    )
    assert got == [
        ("https://shop.example/0", None, 35.0),
        ("https://shop.example/1", 35.0, 1040.0),
        ("https://shop.example/2", None, 35.0),
    ]


def test_card_tops_finds_nearest_box(spark):
    span = '<span class="hidden lg:inline">{}</span>'
    html = (
        f'<div class="item"><div class="relative"><div class="text-textblack"> A </div>{span.format("1,100")}</div>'
        f"{span.format('7')}</div>"
        f'<section><div class="text-textblack">B</div>{span.format(5)}{span.format(6)}{span.format(7)}</section>'
        '<section><div class="text-textblack">C</div><span class="lg:inline hidden">5</span></section>'
    )
    got = rows_of(shop_pages.extract_card_tops(pages(spark, html)), "name", "promotion_price", "original_price")
    assert got == [("A", None, 1100.0), ("B", 5.0, 6.0), ("C", None, None)]


def test_card_go_reads_visible_text(spark):
    html = (
        '<div class="stick_camp_prod_item"><p class="chakra-text css-138rv0j">Nước\n  rửa <i>chén</i></p>'
        '<b class="chakra-text css-aqfyqq">1.234.000 đ</b><span class="p-1 x"> -5% </span></div>'
        '<div class="stick_camp_prod_item"><p class="chakra-text">other</p></div>'
    )
    got = rows_of(
        shop_pages.extract_card_go(pages(spark, html)),
        "product_name_vi", "sale_price", "original_price", "discount_pct",
    )
    assert got == [("Nước rửa chén", 1234000, None, "-5%")]


@pytest.mark.parametrize("title", ["Just a <b>moment</b>...", "Just a moment...", "www.Tops.co.th", "Checking your browser", ""])
def test_detail_tops_drops_challenges(spark, title):
    assert shop_pages.extract_detail_tops(pages(spark, f"<h1>{title}</h1>")).count() == 0


def test_refused_markup_does_not_stop_the_job(spark):
    refused = "<h1>Soap</h1><![nonsense x]]><p>y</p>"
    got = rows_of(shop_pages.extract_heading(pages(spark, refused, "<h1>Next</h1>")), "h1")
    assert got == [("Next",)]


def test_every_page_has_rows_or_a_reason(spark):
    df = pages(spark, "<h1>Soap</h1><![nonsense x]]>", "<h1>Next</h1>").withColumn("retailer", F.lit("makro"))
    df = df.unionByName(df.limit(1).withColumn("html", F.lit(None).cast("string")))
    bad = shop_pages.rejected_pages(df)
    assert sorted(r["reason"] for r in bad.collect()) == ["no markup", "refused markup"]
    assert shop_pages.extract_heading(df).count() + bad.count() == df.count()
    assert sum(r["n_pages"] for r in shop_pages.reject_counts(df).collect()) == 2


def test_markup_stays_out_of_results(spark):
    df = shop_pages.extract_card_lotus(pages(spark, "<p></p>"))
    assert df.columns == [
        "url_no", "url", "page_no", "pos", "name", "promotion_price", "original_price", "condition"
    ]
    assert df.count() == 0
