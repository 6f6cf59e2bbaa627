"""Inputs of the checked queries, all derived from the driver tables.

``LISTING`` is written once and used on both engines; everything else here is
Spark only, and the oracle answers from the same listing.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.functions.prices import price_from_text
from pricelane.session import spread_small

RUN_DATE = datetime.date(2025, 3, 3)
CARDS_PER_PAGE = 50

_MONEY = "cast(cast({} as decimal(10,2)) as varchar(20))"
LISTING = {
    "seq": "p_partkey",
    "retailer": (
        "case p_partkey%5 when 0 then '7-Eleven' when 1 then 'Makro' when 2 then 'Lotus' "
        "when 3 then 'BigC' else 'Tops' end"
    ),
    "name": (
        "concat(p_brand,' ',p_name,' ',"
        "case p_partkey%4 when 0 then cast(p_size*10 as varchar(20)) "
        "when 1 then concat(cast(p_size as varchar(20)),'.5') "
        "when 2 then concat('1,',lpad(cast(p_size as varchar(20)),3,'0')) "
        "else cast(p_size as varchar(20)) end,' ',"
        "case p_partkey%7 when 0 then 'ML' when 1 then 'g' when 2 then 'kg' when 3 then 'L' "
        "when 4 then 'grams' when 5 then 'ltr' else 'กรัม' end,' ',"
        "case p_partkey%6 when 0 then 'Refill' when 1 then 'Pack 3' when 2 then 'x 1+1' "
        "when 3 then 'TWINPACK' when 4 then 'Pack 2 free 1' else '(2+1)' end)"
    ),
    "family_name": "concat(p_brand,' ',p_name)",
    "promotion_text": (
        f"case p_partkey%3 when 0 then concat('฿ ',{_MONEY.format('p_retailprice')}) "
        f"when 1 then concat('฿',{_MONEY.format('p_retailprice-100')}) else null end"
    ),
    "original_text": (
        "case p_partkey%8 when 0 then null when 1 then 'N/A' "
        f"else concat('฿ ',{_MONEY.format('p_retailprice')}) end"
    ),
    "badge_text": (
        "case p_partkey%9 when 0 then 'BUV 2 GET 1' when 1 then '1แถม1' when 2 then 'SUPER SAVE' "
        "when 3 then 'Buy 3 Cheaper' when 4 then 'ประหยัด 20' when 5 then 'GET' "
        "when 6 then 'cheaper' when 7 then '  ' else 'NEW' end"
    ),
}
# Price sightings: every order line saw its part at a price. A third of them lost
# the name, so one placeholder name is very common.
SIGHTINGS = {
    "order_no": "l_orderkey",
    "line_no": "l_linenumber",
    "supplier": "l_suppkey",
    "name": "case when l_orderkey%3=0 then 'Unknown' else name end",
    "promotion_text": f"concat('฿ ',{_MONEY.format('l_extendedprice')})",
    "original_text": (
        "case when l_linenumber%2=0 then null "
        f"else concat('฿',{_MONEY.format('l_extendedprice+100')}) end"
    ),
    "condition": "l_returnflag",
}
SIGHTING_ORDER = ("order_no", "line_no", "supplier", "promotion_text", "original_text", "condition")
SIGHTINGS_SQL = (
    "select " + ", ".join(f"{e} as {n}" for n, e in SIGHTINGS.items())
    + " from lineitem join listing on l_partkey = seq"
)
LISTING_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in LISTING.items()) + " from part"


# With a schema given, opening a table needs no job of its own.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def listing(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """The columns of ``LISTING``; with ``spread`` they are made on all cores, small as the table may be."""
    part = table(spark, folder, "part")
    if spread:
        part = spread_small(part, "p_partkey")
    return part.selectExpr(*(f"{e} as {n}" for n, e in LISTING.items()))


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread_small(table(spark, folder, "lineitem"))
    named = listing(spark, folder).select("seq", "name")
    joined = lines.join(named, F.col("l_partkey") == F.col("seq"))
    return joined.selectExpr(*(f"{e} as {n}" for n, e in SIGHTINGS.items()))


# -- pieces of markup ---------------------------------------------------------
def _join(*parts: str | Column) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def _opt(before: str, column: str | Column, after: str) -> Column:
    """Markup around a value, nothing at all when the value is null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(_join(before, value, after), F.lit(""))


def _every(modulus: int, rest: int, markup: str | Column) -> Column:
    shown = markup if isinstance(markup, Column) else F.lit(markup)
    return F.when(F.col("seq") % modulus == rest, shown).otherwise("")


_HEAD = (
    '<!DOCTYPE html><html><head><title>Shop &amp; more</title><style>s{color:red}</style>'
    '<script>var t="<strong>1</strong></div>";</script></head><body><!-- top -->'
    '<nav><ul><li><a href="/home">Home</a><li><a href="/sale">Sale</a></ul></nav><main>'
)
_FOOT = "</main><footer>Help<br>Terms</footer></body></html>"
_NUMBER = "trim(replace({}, '฿', ''))"


def _catalogue_pages(rows: DataFrame, card: Column) -> DataFrame:
    """Result pages of 50 cards each, in ``seq`` order."""
    page_no = F.floor(F.col("seq") / CARDS_PER_PAGE).cast("int")
    cards = F.array_sort(F.collect_list(F.struct("seq", "card")))
    # markup is many times as large as the rows it is built from, so small tables are spread before
    dealt = spread_small(rows.withColumn("page_no", page_no), "page_no")
    return (
        dealt.select("page_no", "seq", card.alias("card"))
        .groupBy("page_no")
        .agg(F.array_join(F.transform(cards, lambda c: c["card"]), "\n").alias("cards"))
        .select(
            F.lit(0).alias("url_no"),
            F.lit("https://shop.example/c").alias("url"),
            "page_no",
            _join(_HEAD, F.col("cards"), _FOOT).alias("html"),
        )
    )


def _product_pages(rows: DataFrame, body: Column) -> DataFrame:
    return rows.select(
        F.col("seq").cast("int").alias("url_no"),
        _join("https://shop.example/p/", F.col("seq").cast("string")).alias("url"),
        F.lit(1).alias("page_no"),
        _join(_HEAD, body, _FOOT).alias("html"),
    )


# -- one page set per shop layout ----------------------------------------------
def _card_7e() -> Column:
    return _join(
        '<div class="item item-list-wrapper"><a class="productlink" href="/i"',
        F.when(F.col("seq") % 10 == 7, "").otherwise(_opt(' title="', "name", '"')),
        '>view</a><p class="item-description-cls-mobile">\n ',
        F.col("name"),
        "</p>",
        _opt("<strong> ", "promotion_text", " </strong>"),
        _opt("<s>", "original_text", "</s>"),
        _every(4, 0, '<i class="flag" style="background:url(/img/buy1get1-th.svg)"></i>'),
        "</div>",
    )


def cards_7e(spark: SparkSession, folder: str) -> DataFrame:
    return _catalogue_pages(listing(spark, folder), _card_7e())


def catalogue_7e(spark: SparkSession, folder: str) -> DataFrame:
    """The 7-Eleven catalogue as collected: the last page comes back twice more."""
    pages = cards_7e(spark, folder)
    last = pages.select(F.max("page_no").alias("last_no"))
    again = pages.join(last, F.col("page_no") == F.col("last_no")).drop("last_no")
    return pages.unionByName(again.withColumn("page_no", F.col("page_no") + 1)).unionByName(
        again.withColumn("page_no", F.col("page_no") + 2)
    )


def details_7e(spark: SparkSession, folder: str) -> DataFrame:
    body = _join(
        '<div class="flag" style="url(/banner-1get1-th.svg)"></div><h1>\n ',
        F.col("name"),
        ' </h1><div class="gallery"><span class="flag" style="url(/new-th.svg)"></span>',
        _every(3, 1, '<span class="flag" style="url(/b-1get1-th.svg)"></span>'),
        _every(3, 2, '<span class="flag" style="url(/b-2get1-th.svg)"></span>'),
        "</div>",
        _opt('<p class="big currentPrice">', "promotion_text", "</p>"),
        _opt("<strike>", "original_text", "</strike>"),
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def cards_makro(spark: SparkSession, folder: str, name: str = "name") -> DataFrame:
    card = _join(
        '<a href="/en/p/1"><span>Today delivery</span><span>12 points back</span><span>',
        F.col(name),
        "</span>",
        _opt("<b>", "promotion_text", "</b>"),
        _opt("<s>", "original_text", "</s>"),
        _every(3, 0, '<div data-test-id="card_lbl_buy_more">Buy <i>2</i> more</div>'),
        _every(3, 1, "<em>2+ Units each</em>"),
        "</a>",
    )
    return _catalogue_pages(listing(spark, folder), card)


def details_makro(spark: SparkSession, folder: str) -> DataFrame:
    seq = F.col("seq").cast("string")
    body = _join(
        '<div data-test-id="pdp_product_title"><span>',
        F.col("name"),
        "</span></div>",
        F.when(F.col("seq") % 5 == 0, "<div>Sold by us</div>").otherwise(
            _join("<div>77</div><div>Code : ", seq, "</div>")
        ),
        _opt("<div>", "promotion_text", "</div>"),
        _opt("<div>", "original_text", "</div>"),
        F.when(F.col("seq") % 4 == 0, "").otherwise(
            _join(
                "<h2>Buy more, Save more</h2><div>1 - 1 units</div><div>",
                F.when(F.col("seq") % 4 == 1, "1 - 1 units").otherwise("2+ units"),
                "</div><div><b>฿</b><b>",
                seq,
                "a</b></div><div>฿ ",
                seq,
                "b</div>",
            )
        ),
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def cards_bigc(spark: SparkSession, folder: str) -> DataFrame:
    card = _join(
        '<div class="x productCard_container__a"><div class="productCard_title__b"><a href="/p">',
        F.col("name"),
        "</a></div>",
        _opt('<span class="productCard_sale_price__c">', F.expr(_NUMBER.format("promotion_text")), "</span>"),
        _opt('<div class="productCard_base_price__d">', "original_text", "<i>each</i></div>"),
        F.when(F.col("seq") % 10 == 9, "").otherwise(
            _join(
                '<div class="productCard_badge__e"><img alt="product badge" src="/b/',
                (F.col("seq") % 9).cast("string"),
                '"></div>',
            )
        ),
        "</div>",
    )
    return _catalogue_pages(listing(spark, folder), card)


def details_bigc(spark: SparkSession, folder: str) -> DataFrame:
    body = _join(
        _every(11, 0, "<script>/* Cloudflare */</script>"),
        F.when(F.col("seq") % 13 == 0, "").otherwise(_opt("<h1> ", "name", "</h1>")),
        '<div class="productDetail_product_price_new__a"><b>',
        F.coalesce("promotion_text", F.lit("")),
        '</b><span class="productDetail_unit__b">/ 1 pc</span>',
        _opt('<div class="productDetail_product_baseprice__c">', "original_text", "</div>"),
        '</div><div class="imageSlider_badge_warpper__d">',
        F.when(F.col("seq") % 10 == 9, "").otherwise(
            _join('<img src="/b/', (F.col("seq") % 9).cast("string"), '">')
        ),
        "</div>",
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def details_bigc_by_id(spark: SparkSession, folder: str) -> DataFrame:
    body = _join(
        "<h1>",
        F.col("name"),
        '</h1><div id="pdp_product-price-new">',
        _opt('<div class="productDetail_product_price_new__a"> ', "promotion_text", "<i>/pc</i></div>"),
        _opt('<span id="pdp_price-base">', "original_text", "</span>"),
        '</div><span class="productDetail_product_price_default__b">1,5</span>',
        '<div class="imageSlider_badge_top-right__c"><img src="',
        F.when(F.col("seq") % 2 == 0, "/b/1").otherwise("https://cdn.example/b/2"),
        '"></div>',
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def badge_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts read from badge images; two of the nine addresses were never read."""
    rows = listing(spark, folder).where("seq % 9 < 7")
    address = _join("/b/", (F.col("seq") % 9).cast("string"))
    return rows.select(address.alias("badge_url"), F.col("badge_text").alias("text"))


def cards_lotus(spark: SparkSession, folder: str, name: str = "name") -> DataFrame:
    card = _join(
        '<div class="MuiPaper-root MuiCard-root"><p class="mui-style-17swnep"> ',
        F.when(F.col("seq") % 17 == 0, "").otherwise(F.col(name)),
        " </p>",
        _opt('<div class="mui-style-18s6ztp">', "promotion_text", "</div>"),
        _opt('<div class="mui-style-f59hd5">', "original_text", "</div>"),
        _every(3, 1, '<div class="mui-style-axryyp">Buy\n  <b>2</b> Get&nbsp;<b>1</b></div>'),
        "</div>",
    )
    return _catalogue_pages(listing(spark, folder), card)


def details_lotus(spark: SparkSession, folder: str) -> DataFrame:
    body = F.when(
        F.col("seq") % 12 == 0, "<h1>Privacy Preference Center</h1>"
    ).otherwise(
        _join(
            "<h1>Menu</h1><h1 class=\"mui-style-1wc9qn4\">",
            F.col("name"),
            "</h1>",
            _opt('<div class="mui-style-kbur42">', "promotion_text", "/ each</div>"),
            _opt('<div class="mui-style-1opqjiq">', "original_text", "</div>"),
            _every(3, 1, '<div class="mui-style-abwb4l"><b>Save</b><b>20</b></div>'),
        )
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def cards_tops(spark: SparkSession, folder: str) -> DataFrame:
    card = _join(
        '<div class="relative card"><p><div class="text-textblack line"> ',
        F.col("name"),
        " </div></p><section>",
        _opt('<span class="hidden lg:inline">', F.expr(_NUMBER.format("promotion_text")), "</span>"),
        _opt('<span class="hidden lg:inline">', F.expr(_NUMBER.format("original_text")), "</span>"),
        '<span class="hidden">9</span></section></div>',
    )
    return _catalogue_pages(listing(spark, folder), card)


def details_tops(spark: SparkSession, folder: str) -> DataFrame:
    body = _join(
        F.when(F.col("seq") % 14 == 0, "<h1>Just a moment...</h1>").otherwise(
            _opt("<h1> ", "name", "</h1>")
        ),
        _opt('<span class="hidden lg:inline">', "promotion_text", "</span>"),
        _opt('<span class="hidden lg:inline">', "original_text", "</span>"),
        _every(2, 0, '<div class="mt-2 text-sm text-textsecondary">2 for <b>99</b></div>'),
    )
    return _product_pages(listing(spark, folder, spread=True), body)


def cards_go(spark: SparkSession, folder: str) -> DataFrame:
    seq = F.col("seq")
    price = _join(
        (seq % 9 + 1).cast("string"), ".", F.lpad((seq % 1000).cast("string"), 3, "0"), ".000 đ"
    )
    card = _join(
        '<div class="stick_camp_prod_item"><p class="chakra-text css-138rv0j"> ',
        F.col("family_name"),
        " 3.5 Liters - ",
        F.floor(seq / 2).cast("string"),
        '</p><b class="chakra-text css-aqfyqq">',
        price,
        "</b>",
        _every(2, 1, _join('<del class="chakra-text css-nxr2hb">9,', price, "</del>")),
        _every(3, 0, '<span class="p-1"> -5% </span>'),
        "</div>",
    )
    return _catalogue_pages(listing(spark, folder), card)


def all_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Stored pages of five shops and both kinds in one table, and pages of a shop that has no rules."""
    number = F.col("url_no")
    makro = details_makro(spark, folder).where(number % 23 != 4)
    broken = F.when(number % 23 == 5, F.lit(None)).when(number % 23 == 6, "<h1>Soap</h1><![nonsense x]]>").otherwise(F.col("html"))
    strange = driver_pages(spark, folder).drop("retailer")
    parts = (
        ("makro", "category", cards_makro(spark, folder, "family_name")),
        ("makro", "product", makro.withColumn("html", broken)),
        ("bigc", "category", cards_bigc(spark, folder)),
        ("bigc", "product", details_bigc(spark, folder)),
        ("lotus", "category", cards_lotus(spark, folder, "family_name")),
        ("lotus", "product", details_lotus(spark, folder)),
        ("7e", "category", catalogue_7e(spark, folder)),
        ("7e", "product", details_7e(spark, folder)),
        ("tops", "category", cards_tops(spark, folder)),
        ("tops", "product", details_tops(spark, folder)),
        ("other", "product", strange),
    )
    frames = [df.select(F.lit(shop).alias("retailer"), F.lit(kind).alias("page_kind"), "url_no", "url", "page_no", "html") for shop, kind, df in parts]
    return reduce(DataFrame.unionByName, frames)


# -- other inputs ---------------------------------------------------------------
def driver_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The driver's pages, dealt to three shops, with challenge texts put into some of them."""
    page_id = F.col("page_id")
    shop = page_id % 3
    heading = (
        F.when(page_id % 10 == 1, "<h1>Just a moment... ")
        .when(page_id % 10 == 3, "<h1>You are BLOCKED ")
        .when(page_id % 10 == 5, "<h1>Privacy Preference Center ")
        .when(page_id % 10 == 7, "<h1><!-- Attention Required -->")
        .otherwise("<h1>")
    )
    return table(spark, folder, "pages").select(
        page_id.cast("int").alias("url_no"),
        "url",
        F.lit(1).alias("page_no"),
        F.when(shop == 0, "BigC").when(shop == 1, "Tops").otherwise("Lotus").alias("retailer"),
        F.replace("html", F.lit("<h1>"), heading).alias("html"),
    )


def price_rows(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """The listing with prices read from its texts."""
    return listing(spark, folder, spread).select(
        "seq",
        "name",
        "family_name",
        price_from_text(F.col("promotion_text")).alias("promotion_price"),
        price_from_text(F.col("original_text")).alias("original_price"),
        F.when(F.col("badge_text") != "  ", F.col("badge_text")).alias("condition"),
    )


def search_list(spark: SparkSession, folder: str, name: str = "family_name") -> DataFrame:
    """Every name of the listing, and as many names that nothing has."""
    chosen = listing(spark, folder)
    return chosen.select(F.col(name).alias("product_name")).unionByName(
        chosen.select(_join("No such item ", F.col("seq").cast("string")).alias("product_name"))
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        _join("https://shop.example/u/", F.col("user_id").cast("string")).alias("url"),
        (F.col("event_type") != "error").alias("ok"),
        "ts",
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed records as JSON text; some lack an item, prices or models, or have odd fields only.

    Amounts of every 13th record have a fraction.
    """
    rows = listing(spark, folder)
    seq = F.col("seq")
    half = F.when(seq % 13 == 0, 0.5).otherwise(0.0)

    def priced(amount: Column, lost: int) -> Column:
        value = F.struct(amount.alias("single_value"))
        return F.when(seq % lost == 0, F.lit(None)).otherwise(value)

    models = F.when(
        seq % 4 != 0,
        F.transform(
            F.sequence(F.lit(0), (seq % 3).cast("int")),
            lambda i: F.struct(
                seq.alias("item_id"),
                (seq * 10 + i).alias("model_id"),
                F.concat(F.col("family_name"), F.lit(" / "), i.cast("string")).alias("name"),
                F.when(i == 1, F.col("family_name")).alias("name_tr"),
                F.when(i != 2, (seq + 1) * 150_000).alias("price"),
                i.alias("status"),
                (i == 0).alias("has_stock"),
            ),
        ),
    )
    item = F.when(
        seq % 7 != 0,
        F.struct(
            seq.alias("item_id"),
            (seq % 100).alias("shop_id"),
            F.col("name").alias("title"),
            F.col("family_name").alias("title_tr"),
            F.lit("VND").alias("currency"),
            ((seq + 1) * 12_345 + half).alias("price"),
            F.when(seq % 5 != 0, (seq + 1) * 23_456 + half).alias("price_before_discount"),
            F.struct(((seq % 50) / 10).alias("rating_star")).alias("item_rating"),
            models.alias("models"),
        ),
    )
    inner = F.struct(
        item.alias("item"),
        F.struct(
            priced((seq + 1) * 1_234_567, 6).alias("price"),
            priced((seq + 1) * 7_654_321, 8).alias("price_before_discount"),
        ).alias("product_price"),
    )
    record = F.struct(F.struct(F.when(seq % 11 != 0, inner).alias("data")).alias("data"))
    odd = F.when(seq % 17 == 0, '{"image":"x.png"}').when(seq % 19 == 0, '{"item_id":null}').otherwise("{}")
    lone = F.concat(F.lit('{"data":{"data":{"item":'), odd, F.lit("}}}"))
    return rows.select(F.when((seq % 7 == 0) & (seq % 11 != 0), lone).otherwise(F.to_json(record)).alias("json"))
