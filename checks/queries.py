"""The checked queries: each a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs, oracle
from checks.inputs import RUN_DATE, listing, price_rows, search_list, table
from checks.oracle import FAMILY_ROWS, PRICE_ROWS, on_listing
from pricelane.fixed_values import LISTING_COLUMNS, NAME_PROFILES, PRICE_COLUMNS, RETAILERS
from pricelane.functions import names, prices, promos, text, text_nodes, urls
from pricelane.operators import arranging, cleaning, dedupe, filters, joins, nested, summary
from pricelane.plans import shops
from pricelane.session import scratch_path, stored
from pricelane.sources import page_dispatch, run_store, shop_pages, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


# Columns compared as text: engines and clients show dates and nullable integers
# in different ways.
AS_TEXT = {
    "Date": "date",
    "as_long": "bigint",
    "result": "bigint",
    "original_price": "bigint",
    "item_id": "bigint",
    "shop_id": "bigint",
}


def plain(df: DataFrame) -> DataFrame:
    odd = {c for c, kind in df.dtypes if AS_TEXT.get(c) == kind}
    return df.withColumns({c: F.col(c).cast("string") for c in odd}) if odd else df


def check(name: str, sql: str | None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(query(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


def scalar(name: str, sql: str, build: Callable[[], F.Column], extra: str = "seq") -> None:
    """A column rule over the whole listing, keyed by ``seq``."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return listing(spark, folder).select(extra, build().alias("result"))

    check(name, on_listing(f"select {extra}, {sql} as result from listing"))(query)


def family_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Price rows whose names repeat."""
    return price_rows(spark, folder).drop("name").withColumnRenamed("family_name", "name")


# -- sources and sinks --------------------------------------------------------------
@check("scan_pages", "select page_id, url, md5(html) as html_md5 from pages")
def scan_pages(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url", F.md5("html").alias("html_md5"))


@check(
    "watchlist_source",
    on_listing("select retailer, 'https://shop.example/p/'||seq as url from listing"),
)
def watchlist_source(spark, folder):
    path = scratch_path(spark, "watchlist")
    tables.write_csv(
        listing(spark, folder).select("retailer", F.concat(F.lit("https://shop.example/p/"), "seq").alias("url")), path
    )
    return tables.read_watchlist(spark, path)


@check("json_items", on_listing(oracle.FEED_FLAT))
def json_items(spark, folder):
    path = scratch_path(spark, "feed")
    inputs.feed(spark, folder).write.text(path)
    return nested.json_flatten(tables.read_items(spark, path))


@check("json_items_array", on_listing(oracle.FEED_FLAT))
def json_items_array(spark, folder):
    """The feed as array files on single lines."""
    path = scratch_path(spark, "feed-arrays")
    records = inputs.feed(spark, folder).groupBy(F.pmod(F.xxhash64("json"), F.lit(4))).agg(F.array_join(F.collect_list("json"), ", ").alias("records"))
    records.select(F.concat(F.lit("[ "), "records", F.lit(" ]"))).repartition(4).write.text(path)
    return nested.json_flatten(tables.read_items(spark, path, arrays=True))


@check(
    "dated_sink_roundtrip",
    on_listing(
        oracle.standard(f"select * from ({PRICE_ROWS})", "makro")
        + " union all "
        + oracle.standard(f"select * from ({PRICE_ROWS})", "bigc")
    ),
)
def dated_sink_roundtrip(spark, folder):
    path = scratch_path(spark, "listing")
    rows = price_rows(spark, folder)
    makro = cleaning.standardize(rows, "makro", RUN_DATE)
    earlier = cleaning.standardize(rows.withColumn("name", F.concat(F.lit("Old "), "name")), "makro", RUN_DATE)
    tables.write_dated(earlier, path)  # an earlier run of the same day, replaced below
    tables.write_dated(makro, path)
    tables.write_dated(cleaning.standardize(rows, "bigc", RUN_DATE), path)
    return tables.read_dated(spark, path, LISTING_COLUMNS)


@check(
    "dated_find_names",
    on_listing(
        f"select * from ({oracle.standard(PRICE_ROWS, 'makro')}) where name in "
        "(select name from listing where seq in (3, 77, 150))"
    ),
)
def dated_find_names(spark, folder):
    """A few names in a stored listing, whose files lie by name."""
    path = scratch_path(spark, "listing")
    rows = price_rows(spark, folder)
    tables.write_dated(cleaning.standardize(rows, "makro", RUN_DATE), path)
    names = [r["name"] for r in rows.where("seq in (3, 77, 150)").select("name").collect()]
    return tables.find_names(spark, path, [*names, "No such item"])


@check("csv_roundtrip", on_listing("select seq, name, promotion_text, badge_text from listing"))
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    tables.write_csv(listing(spark, folder).select("seq", "name", "promotion_text", "badge_text"), path)
    return tables.read_csv(spark, path, "seq bigint, name string, promotion_text string, badge_text string")


@check("ordered_head", on_listing(f"select name, promotion_price from ({PRICE_ROWS}) order by seq limit 10"))
def ordered_head(spark, folder):
    return arranging.ordered_head(price_rows(spark, folder), ["seq"], 10).select("name", "promotion_price")


@check(
    "ordered_tail", on_listing(f"select name, promotion_price from ({PRICE_ROWS}) order by seq desc limit 10")
)
def ordered_tail(spark, folder):
    return arranging.ordered_tail(price_rows(spark, folder), ["seq"], 10).select("name", "promotion_price")


# -- extraction ---------------------------------------------------------------------
def extraction(name: str, sql: str, pages: Query, extract: Callable[[DataFrame], DataFrame]) -> None:
    check(name, on_listing(sql))(lambda spark, folder: extract(pages(spark, folder)))


extraction("extract_card_7e", oracle.CARD_7E, inputs.cards_7e, shop_pages.extract_card_7e)
extraction("extract_detail_7e", oracle.DETAIL_7E, inputs.details_7e, shop_pages.extract_detail_7e)
extraction("extract_card_makro", oracle.card_makro(), inputs.cards_makro, shop_pages.extract_card_makro)
extraction("extract_price_makro", oracle.PRICE_MAKRO, inputs.details_makro, shop_pages.extract_price_makro)
extraction("extract_tiers_makro", oracle.TIERS_MAKRO, inputs.details_makro, shop_pages.extract_tiers_makro)
extraction(
    "extract_product_makro",
    "select p.*, t.condition from "
    f"({oracle.PRICE_MAKRO}) p join ({oracle.TIERS_MAKRO}) t on p.url = t.url",
    inputs.details_makro,
    shop_pages.extract_product_makro,
)
extraction("extract_card_bigc", oracle.CARD_BIGC, inputs.cards_bigc, shop_pages.extract_card_bigc)
extraction("extract_detail_bigc", oracle.DETAIL_BIGC, inputs.details_bigc, shop_pages.extract_detail_bigc)
extraction(
    "extract_detail_bigc_by_id",
    oracle.DETAIL_BIGC_BY_ID,
    inputs.details_bigc_by_id,
    shop_pages.extract_detail_bigc_by_id,
)
extraction("extract_card_lotus", oracle.card_lotus(), inputs.cards_lotus, shop_pages.extract_card_lotus)
extraction("extract_detail_lotus", oracle.DETAIL_LOTUS, inputs.details_lotus, shop_pages.extract_detail_lotus)
extraction("extract_card_tops", oracle.CARD_TOPS, inputs.cards_tops, shop_pages.extract_card_tops)
extraction("extract_detail_tops", oracle.DETAIL_TOPS, inputs.details_tops, shop_pages.extract_detail_tops)
extraction("extract_card_go", oracle.CARD_GO, inputs.cards_go, shop_pages.extract_card_go)


@check(
    "extract_badge_urls",
    on_listing(
        "select distinct seq//50 as page_no, '/b/'||(seq%9) as badge_url from listing where seq%10<>9"
    ),
)
def extract_badge_urls(spark, folder):
    pages = inputs.cards_bigc(spark, folder)
    named = pages.withColumn("url", F.col("page_no").cast("string"))
    return shop_pages.extract_badge_urls(named).select(
        F.col("url").cast("bigint").alias("page_no"), "badge_url"
    )


_H1 = (
    "trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), "
    "'&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g'))"
)


@check("extract_heading", f"select cast(page_id as integer) as url_no, url, {_H1} as h1 from pages")
def extract_heading(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("url_no"), "url", F.lit(1).alias("page_no"), "html"
    )
    return shop_pages.extract_heading(pages).select("url_no", "url", "h1")


@check(
    "blocked_pages",
    f"select cast(page_id as integer) as url_no, trim(case page_id%10 when 1 then 'Just a moment... ' "
    "when 3 then 'You are BLOCKED ' when 5 then 'Privacy Preference Center ' else '' end || "
    f"{_H1}) as h1 from pages where case page_id%3 when 0 then page_id%10 in (1, 7) "
    "when 1 then page_id%10 in (1, 3) else page_id%10 = 5 end",
)
def blocked_pages(spark, folder):
    return shop_pages.blocked_pages(inputs.driver_pages(spark, folder)).select("url_no", "h1")


# -- rules over text nodes ----------------------------------------------------------
def texts_of(*columns) -> F.Column:
    return F.array(*(F.lit(c[1:]) if c.startswith("=") else F.col(c) for c in columns))


def compact(texts: F.Column) -> F.Column:
    return F.filter(texts, lambda t: t.isNotNull())


scalar(
    "texts_name",
    "case when seq%3=2 then family_name||' now' else name end",
    lambda: text_nodes.texts_name(
        F.when(F.col("seq") % 3 == 2, F.array(F.lit("short"), F.concat("family_name", F.lit(" now"))))
        .otherwise(texts_of("=Today only deals", "=20 Points back", "=฿ 99 this week", "name", "family_name"))
    ),
)


@check(
    "texts_prices",
    on_listing(
        "select seq, least(a, b) as low, greatest(a, b) as high from (select seq, "
        f"{oracle._ranged('promotion_text')} as a, {oracle._ranged('original_text')} as b from listing)"
    ),
)
def texts_prices(spark, folder):
    texts = compact(texts_of("promotion_text", "=buy 50", "=Get 60", "=70 points", "original_text",
                             "=3", "=฿ 10,000", "name"))
    found = text_nodes.texts_prices(texts)
    return listing(spark, folder).select(
        "seq", F.array_min(found).alias("low"), F.array_max(found).alias("high")
    )


scalar(
    "texts_condition",
    "case seq%3 when 0 then badge_text when 1 then '3 Units '||family_name end",
    lambda: text_nodes.texts_condition(
        F.array(F.lit("units"), F.col("family_name"),
                F.when(F.col("seq") % 3 == 1, F.concat(F.lit("3 Units "), "family_name")).otherwise("none")),
        F.when(F.col("seq") % 3 == 0, F.col("badge_text")),
    ),
)


@check(
    "anchor_price_lines",
    on_listing(
        "select seq, coalesce(a, b) as promotion_text, coalesce(case when a is not null then b end, a, b) "
        f"as original_text from (select seq, {oracle._line('promotion_text')} as a, "
        f"{oracle._line('original_text')} as b from listing)"
    ),
)
def anchor_price_lines(spark, folder):
    coded = F.when(F.col("seq") % 2 == 0, F.lit("Item Code: 7")).otherwise("no number")
    lines = compact(F.array(F.lit("55"), F.col("name"), F.lit("66"), F.col("name"), coded,
                            F.lit("each"), F.col("promotion_text"), F.col("original_text")))
    promotion, original = text_nodes.price_line_pair(F.col("found"))
    rows = listing(spark, folder).withColumn("found", text_nodes.price_lines(lines, F.col("name")))
    return rows.select(
        "seq", promotion.alias("promotion_text"), original.alias("original_text")
    )


scalar(
    "quantity_tiers",
    "case seq%4 when 0 then '{}' when 1 then '{\"1 unit\": \"฿ '||seq||'\"}' "
    "when 2 then '{\"1 unit\": \"฿ 8\", \"2+ units\": \"฿ '||seq||'\"}' "
    "else '{\"1 unit\": \"฿ '||seq||'\", \"2+ units\": \"฿ 9\"}' end",
    lambda: text_nodes.tiers_json(text_nodes.quantity_tiers(
        F.when(F.col("seq") % 4 == 0, texts_of("name", "=1 unit", "=฿ 5"))
        .when(F.col("seq") % 4 == 1, F.array(F.lit("Buy More and Save More"), F.lit("1 unit"),
                                             F.lit("฿"), F.col("seq").cast("string"), F.lit("฿ 1")))
        .when(F.col("seq") % 4 == 2, F.array(F.lit("buy more, save more"), F.lit("1 unit"), F.lit("2+ units"),
                                             F.lit("฿ 8"), F.lit("฿"), F.col("seq").cast("string")))
        .otherwise(F.array(F.lit("BUY MORE SAVE MORE"), F.lit("1 unit"), F.lit("2+ units"), F.lit("1 unit"),
                           F.lit("฿ 3"), F.lit("฿ 9"), F.concat(F.lit("฿ "), F.col("seq").cast("string"))))
    )),
)


# The last page of each of three catalogues comes back twice more.
_PAGED = (
    "select 'https://shop.example/c/'||(seq%3) as url, cast(seq//50 as integer) as page_no, "
    "cast(seq%50 as integer) as pos, family_name as name from listing"
)


def paged(spark: SparkSession, folder: str) -> DataFrame:
    rows = listing(spark, folder).select(
        F.concat(F.lit("https://shop.example/c/"), (F.col("seq") % 3).cast("string")).alias("url"),
        F.floor(F.col("seq") / 50).cast("int").alias("page_no"),
        (F.col("seq") % 50).cast("int").alias("pos"),
        F.col("family_name").alias("name"),
    )
    last = rows.select(F.max("page_no").alias("last_no"))
    again = rows.join(last, F.col("page_no") == F.col("last_no")).drop("last_no")
    return rows.unionByName(again.withColumn("page_no", F.col("page_no") + 1)).unionByName(
        again.withColumn("page_no", F.col("page_no") + 2)
    )


# One catalogue has an empty page 2, which ends it.
@check("drop_repeated_pages", on_listing(f"select * from ({_PAGED}) where not (url like '%/1' and page_no >= 2)"))
def drop_repeated_pages(spark, folder):
    rows = paged(spark, folder)
    pages = rows.select("url", "page_no").distinct()
    shown = rows.where("not (url like '%/1' and page_no = 2)")
    return dedupe.drop_repeated_pages(shown, pages).select("url", "page_no", "pos", "name")


# -- scalar rules -------------------------------------------------------------------
scalar("price_from_text", oracle.digits_price("promotion_text"),
       lambda: prices.price_from_text(F.col("promotion_text")))
scalar("price_strip_currency", oracle.strip_price("original_text"),
       lambda: prices.price_strip_currency(F.col("original_text")))
scalar(
    "price_integer_strip",
    "case when seq%4<>0 then cast((seq%9+1)*1000000 + seq as varchar) end",
    lambda: prices.price_integer_strip(
        F.when(F.col("seq") % 4 == 0, F.lit("đ")).otherwise(
            F.concat(((F.col("seq") % 9 + 1) * 1000000 + F.col("seq")).cast("string"), F.lit(".,đ"))
        )
    ),
)


@check(
    "lenient_cast",
    on_listing(
        f"select seq, {oracle.num('t')} as as_double, case when regexp_matches(t, '^[+-]?[0-9]+$') then "
        "cast(try_cast(t as bigint) as varchar) end as as_long from (select seq, case seq%9 when 0 then '1.8' "
        "when 1 then ' 12 ' when 2 then '1d' when 3 then '1.2.3' when 4 then '.' when 5 then '' "
        "when 6 then 'N/A' when 7 then cast(seq as varchar)||'.' else cast(seq as varchar) end as t from listing)"
    ),
)
def lenient_cast(spark, folder):
    seq = F.col("seq")
    cases = F.array(*(F.lit(c) for c in ("1.8", " 12 ", "1d", "1.2.3", ".", "", "N/A")))
    t = F.when(seq % 9 < 7, F.get(cases, (seq % 9).cast("int"))).when(
        seq % 9 == 7, F.concat(seq.cast("string"), F.lit("."))
    ).otherwise(seq.cast("string"))
    return listing(spark, folder).select(
        "seq", text.strict_double(t).alias("as_double"), text.strict_long(t).alias("as_long")
    )


_SEQ_PRICES = "seq, promotion_price, original_price"


@check("reevaluate_price", on_listing(oracle.filled(PRICE_ROWS, "seq")))
def reevaluate_price(spark, folder):
    return cleaning.reevaluate_price(price_rows(spark, folder)).select(*_SEQ_PRICES.split(", "))


@check("reevaluate_price_swap", on_listing(oracle.ordered(PRICE_ROWS, "seq")))
def reevaluate_price_swap(spark, folder):
    return cleaning.reevaluate_price_swap(price_rows(spark, folder)).select(*_SEQ_PRICES.split(", "))


@check(
    "nullify_fake_original",
    on_listing(
        "select seq, promotion_price, nullif(original_price, promotion_price) as original_price "
        f"from ({PRICE_ROWS})"
    ),
)
def nullify_fake_original(spark, folder):
    return cleaning.nullify_fake_original(price_rows(spark, folder)).select(*_SEQ_PRICES.split(", "))


@check(
    "discount_pct",
    on_listing(
        "select seq, round((original_price - promotion_price) / original_price * 100, 1) as discount_pct "
        f"from ({PRICE_ROWS})"
    ),
)
def discount_pct(spark, folder):
    return cleaning.with_discount_pct(price_rows(spark, folder)).select("seq", "discount_pct")


scalar("brand_first_word", oracle.brand("makro"), lambda: names.brand_first_word(F.col("name")))


@check(
    "brand_dictionary",
    on_listing(
        f"select seq, {oracle.brand('7e')} as result from (select seq, case seq%3 when 0 then 'เปา'||name "
        "when 1 then 'ไลปอนเอฟ '||name else name end as name from listing)"
    ),
)
def brand_dictionary(spark, folder):
    shown = F.concat(
        F.when(F.col("seq") % 3 == 0, "เปา").when(F.col("seq") % 3 == 1, "ไลปอนเอฟ ").otherwise(""), "name"
    )
    return listing(spark, folder).select("seq", names.brand_dictionary(shown).alias("result"))


for _profile in NAME_PROFILES:
    scalar(f"parse_volume_{_profile}", oracle.volume(_profile),
           lambda p=_profile: names.volume(F.col("name"), p))
    scalar(f"parse_unit_{_profile}", oracle.unit(_profile), lambda p=_profile: names.unit(F.col("name"), p))
    if NAME_PROFILES[_profile].pack_forms:
        scalar(f"parse_pack_{_profile}", oracle.pack(_profile), lambda p=_profile: names.pack(F.col("name"), p))

scalar("parse_product_id_go", "cast(seq as varchar)",
       lambda: names.go_product_id(F.concat("name", F.lit(" - "), F.col("seq").cast("string"))))


@check("parse_names_7e", on_listing(oracle.parsed(PRICE_ROWS, "7e")))
def parse_names_7e(spark, folder):
    return cleaning.parse_names(price_rows(spark, folder), "7e", RUN_DATE)


@check(
    "parse_names_go",
    on_listing(
        f"select product_name_en, {oracle.volume('go', 'product_name_en')} as \"Volume\", "
        f"{oracle.unit('go', 'product_name_en')} as \"Unit\", cast(seq as varchar) as product_id "
        "from (select seq, family_name||' 3.5 Liters - '||seq as product_name_en from listing)"
    ),
)
def parse_names_go(spark, folder):
    shown = listing(spark, folder).select(
        F.concat("family_name", F.lit(" 3.5 Liters - "), F.col("seq").cast("string")).alias("product_name_en")
    )
    return cleaning.parse_names_go(shown)


@check("promo_label", on_listing(f"select seq, label as result from ({oracle.LABELLED})"))
def promo_label(spark, folder):
    return listing(spark, folder).select("seq", promos.promo_label(F.col("badge_text")).alias("result"))


scalar("promo_flag", "regexp_matches(upper(badge_text), 'BUY|GET|FREE|1|2|ซื้อ|แถม')",
       lambda: promos.promo_flag(F.col("badge_text")))
scalar(
    "sentinel_null",
    "case when seq%3<>0 then badge_text end",
    lambda: promos.sentinel_null(F.when(F.col("seq") % 3 == 0, "{}").otherwise(F.col("badge_text"))),
)


@check(
    "page_url",
    "select page_id, case when contains(url, '?') then string_split(url, '&page=')[1]||'&page='||(page_id%7) "
    "else url||'?page='||(page_id%7) end as result from pages",
)
def page_url(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", urls.page_url(F.col("url"), F.col("page_id") % 7).alias("result")
    )


@check("url_short", "select page_id, substring(string_split(url, '/')[-1], 1, 50) as result from pages")
def url_short(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.url_short(F.col("url")).alias("result"))


scalar(
    "badge_url_absolute",
    "case when seq%2=0 then 'https://www.bigc.co.th/b/'||seq else 'https://cdn.example/'||seq end",
    lambda: urls.badge_url_absolute(
        F.concat(F.when(F.col("seq") % 2 == 0, "/b/").otherwise("https://cdn.example/"),
                 F.col("seq").cast("string"))
    ),
)
scalar("scaled_price", oracle.scaled("seq*1234567", 100000),
       lambda: prices.scaled_price(F.col("seq") * 1234567, 100_000.0))


@check(
    "select_canonical",
    on_listing(
        "select family_name as name, promotion_text as promotion_price, original_text as original_price, "
        "badge_text as condition from listing"
    ),
)
def select_canonical(spark, folder):
    renames = {"family_name": "name", "promotion_text": "promotion_price",
               "original_text": "original_price", "badge_text": "condition"}
    return cleaning.select_canonical(listing(spark, folder).drop("name"), renames)


@check(
    "consistent_schema",
    on_listing(
        f"select name, {oracle.num('p')} as promotion_price, cast(seq as double) as original_price, "
        "cast(seq as varchar) as condition from (select *, replace(promotion_text, '฿', '') as p from listing)"
    ),
)
def consistent_schema(spark, folder):
    rows = listing(spark, folder).select(
        "name",
        F.replace("promotion_text", F.lit("฿"), F.lit("")).alias("promotion_price"),
        F.col("seq").alias("original_price"),
        F.col("seq").alias("condition"),
    )
    return cleaning.consistent_schema(rows)


# -- nested feeds -------------------------------------------------------------------
def items(spark: SparkSession, folder: str) -> DataFrame:
    return nested.json_items(inputs.feed(spark, folder))


@check("json_flatten", on_listing(oracle.FEED_FLAT))
def json_flatten(spark, folder):
    return nested.json_flatten(items(spark, folder))


@check("json_optional_field", on_listing(oracle.FEED_OPTIONAL))
def json_optional_field(spark, folder):
    return nested.json_optional_field(nested.json_nonempty(items(spark, folder)))


@check("json_explode_models", on_listing(oracle.FEED_MODELS))
def json_explode_models(spark, folder):
    return nested.json_explode_models(items(spark, folder))


@check(
    "json_nonempty",
    on_listing(
        f"select case when {oracle.HAS_ITEM} then cast(seq as varchar) end as item_id from listing where {oracle.NOT_EMPTY}"
    ),
)
def json_nonempty(spark, folder):
    return nested.json_nonempty(items(spark, folder)).select(F.col("data.data.item.item_id").alias("item_id"))


@check(
    "item_lookup",
    on_listing(f"select * from ({oracle.FEED_FLAT}) where item_id = '142' and shop_id = '42'"),
)
def item_lookup(spark, folder):
    return filters.item_lookup(nested.json_flatten(items(spark, folder)), 142, 42)


_DICTIONARY = "select distinct family_name as product_name_vi, upper(family_name) as translated from listing where seq%2=0"


@check(
    "translate_lookup",
    on_listing(
        "select seq, family_name as product_name_vi, coalesce(translated, family_name) as product_name_en "
        "from listing left join dictionary on family_name = product_name_vi",
        dictionary=_DICTIONARY,
    ),
)
def translate_lookup(spark, folder):
    rows = listing(spark, folder).select("seq", F.col("family_name").alias("product_name_vi"))
    return joins.translate_lookup(rows, dictionary(spark, folder))


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return (
        listing(spark, folder)
        .where("seq % 2 = 0")
        .select(F.col("family_name").alias("product_name_vi"), F.upper("family_name").alias("translated"))
        .distinct()
    )


# -- filters ------------------------------------------------------------------------
_TITLES = (
    "select seq, case seq%5 when 0 then '' when 1 then 'Unknown Product' when 2 then 'See Tops.co.th now' "
    "when 3 then null else name end as name from listing"
)


@check("valid_names", on_listing(f"select * from ({_TITLES}) where seq%5=4"))
def valid_names(spark, folder):
    kind = F.col("seq") % 5
    titles = listing(spark, folder).select(
        "seq",
        F.when(kind == 0, "").when(kind == 1, "Unknown Product").when(kind == 2, "See Tops.co.th now")
        .when(kind == 4, F.col("name")).alias("name"),
    )
    return filters.valid_names(titles)


@check(
    "merged_url_guard",
    "select page_id, u as url from (select page_id, case when page_id%10=0 then url||url else url end as u "
    "from pages) where (length(u) - length(replace(u, 'https://', ''))) // 8 <= 1",
)
def merged_url_guard(spark, folder):
    glued = F.when(F.col("page_id") % 10 == 0, F.concat("url", "url")).otherwise(F.col("url"))
    return filters.merged_url_guard(table(spark, folder, "pages").select("page_id", glued.alias("url")))


def badges(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("seq") % 9
    return listing(spark, folder).select(
        "seq", F.when(kind == 8, "null").when(kind != 7, F.concat(F.lit("/b/"), kind.cast("string"))).alias("badge_url")
    )


@check(
    "distinct_badges",
    on_listing("select distinct '/b/'||(seq%9) as badge_url from listing where seq%9 < 7"),
)
def distinct_badges(spark, folder):
    return dedupe.distinct_values(filters.with_badge(badges(spark, folder)), "badge_url")


@check("with_condition", on_listing(f"select seq, condition from ({PRICE_ROWS}) where condition is not null"))
def with_condition(spark, folder):
    return filters.with_condition(price_rows(spark, folder)).select("seq", "condition")


@check(
    "brand_price_filter",
    on_listing(
        f"select * from ({oracle.standard(PRICE_ROWS, 'makro')}) where \"Brand\" in ('Brand#2', 'Brand#17') "
        "and original_price between 880 and 1000"
    ),
)
def brand_price_filter(spark, folder):
    rows = cleaning.standardize(price_rows(spark, folder), "makro", RUN_DATE)
    return filters.brand_price_filter(rows, ["Brand#2", "Brand#17"], 880, 1000)


# -- joins --------------------------------------------------------------------------
def _urls(rows: DataFrame) -> DataFrame:
    return rows.withColumn("url", F.concat(F.lit("https://shop.example/p/"), F.col("seq").cast("string")))


@check(
    "watchlist_merge",
    on_listing(
        "select 'https://shop.example/p/'||seq as url, name, promotion_price, original_price, "
        f"case when seq%2=0 then condition end as condition from ({PRICE_ROWS})"
    ),
)
def watchlist_merge(spark, folder):
    rows = _urls(price_rows(spark, folder))
    conditions = rows.where("seq % 2 = 0").select("url", "name", "condition")
    return joins.watchlist_merge(rows.drop("seq", "condition", "family_name"), conditions)


@check("search_join", on_listing(oracle.searched(oracle.search_list(), FAMILY_ROWS)))
def search_join(spark, folder):
    return joins.search_join(search_list(spark, folder), family_rows(spark, folder))


@check(
    "found_flag",
    on_listing(
        f"select product_name, product_name in (select family_name from listing) as \"Found\" "
        f"from ({oracle.search_list()})"
    ),
)
def found_flag(spark, folder):
    return joins.found_flag(search_list(spark, folder), family_rows(spark, folder))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return shops.badge_labels(inputs.badge_texts(spark, folder))


_BADGES = "select seq, case seq%9 when 8 then 'null' when 7 then null else '/b/'||(seq%9) end as badge_url from listing"


@check(
    "badge_map_default",
    on_listing(
        f"select seq, b.badge_url, label as condition from ({_BADGES}) b left join labels l on b.badge_url = l.badge_url",
        labels=oracle.BADGE_LABELS,
    ),
)
def badge_map_default(spark, folder):
    return joins.badge_map(badges(spark, folder), labels(spark, folder))


@check(
    "badge_map_keep",
    on_listing(
        "select seq, b.badge_url, case when l.badge_url is null then b.badge_url else label end as condition "
        f"from ({_BADGES}) b left join labels l on b.badge_url = l.badge_url",
        labels=oracle.BADGE_LABELS,
    ),
)
def badge_map_keep(spark, folder):
    return joins.badge_map(badges(spark, folder), labels(spark, folder), keep_unknown=True)


@check(
    "seen_anti",
    on_listing(
        "select seq, family_name as name from listing where family_name not in "
        "(select family_name from listing where seq%3=0)"
    ),
)
def seen_anti(spark, folder):
    rows = family_rows(spark, folder).select("seq", "name")
    return dedupe.seen_anti(rows, rows.where("seq % 3 = 0"))


# -- distinct, counts, order, unions --------------------------------------------------
@check("distinct_rows", on_listing(f"select distinct name, condition from ({FAMILY_ROWS})"))
def distinct_rows(spark, folder):
    return dedupe.distinct_rows(family_rows(spark, folder).select("name", "condition"))


@check("dedupe_first", on_listing(oracle.first_of(FAMILY_ROWS, "name", "seq")))
def dedupe_first(spark, folder):
    return dedupe.dedupe_first(family_rows(spark, folder), ["seq"])


@check("listing_counts", on_listing("select retailer as \"Retailer\", count(*) as n_items from listing group by 1"))
def listing_counts(spark, folder):
    return summary.listing_counts(listing(spark, folder).withColumnRenamed("retailer", "Retailer"))


@check(
    "run_summary",
    "select count(distinct case when event_type <> 'error' then user_id end) as n_success, "
    "count(distinct user_id) as n_requested, count(*) as n_attempts, "
    "cast(epoch_us(max(ts)) - epoch_us(min(ts)) as double) / 1000000 as elapsed_seconds from events",
)
def run_summary(spark, folder):
    return summary.run_summary(inputs.attempts(spark, folder))


@check("run_summary_observed", ORACLE["run_summary"])
def run_summary_observed(spark, folder):
    """The totals of a run, counted while its attempts are stored."""
    rows, totals = summary.observed_attempts(inputs.attempts(spark, folder))
    rows.write.parquet(scratch_path(spark, "attempts"))
    kinds = "n_success bigint, n_requested bigint, n_attempts bigint, elapsed_seconds double"
    return spark.createDataFrame([totals.get], kinds)


@check(
    "new_items_per_page",
    on_listing(
        "select p.url, p.page_no, coalesce(n, 0) as new_items from (select distinct url, page_no from paged) p left join "
        "(select url, page_no, count(*) as n from (select * from paged qualify row_number() over "
        "(partition by url, name order by page_no, pos) = 1) group by 1, 2) f on p.url = f.url and p.page_no = f.page_no",
        paged="select u as url, cast(seq//50 as integer) + r*1000000 as page_no, seq%50 as pos, family_name as name "
        "from listing, (values ('/a'), ('/b'), ('/c')) c(u), (values (0), (1)) d(r)",
    ),
)
def new_items_per_page(spark, folder):
    rows = listing(spark, folder).select(
        "seq",
        F.floor(F.col("seq") / 50).cast("int").alias("page_no"),
        (F.col("seq") % 50).alias("pos"),
        F.col("family_name").alias("name"),
    )
    again = rows.withColumn("page_no", F.col("page_no") + 1000000)
    url = F.explode(F.array(*map(F.lit, ("/a", "/b", "/c"))))  # three catalogues of the same names
    return dedupe.new_items_per_page(rows.unionByName(again).withColumn("url", url), ["page_no", "pos"])


@check(
    "watchlist_coverage",
    on_listing(
        "select 'https://shop.example/p/'||seq as url, case seq%3 when 0 then 'Blocked or Not Found' "
        "when 1 then 'first '||name else 'second '||name end as name, "
        "case when seq%3<>0 then promotion_price end as promotion_price, "
        "case when seq%3<>0 then original_price end as original_price, "
        f"case when seq%3<>0 then condition end as condition from ({PRICE_ROWS})"
    ),
)
def watchlist_coverage(spark, folder):
    rows = _urls(price_rows(spark, folder))
    tries = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    ok = F.col("seq") % 3 >= F.col("attempt")
    label = F.when(F.col("attempt") == 1, "first ").otherwise("second ")
    attempts = tries.withColumns({"ok": ok, "name": F.concat(label, "name")})
    return summary.watchlist_coverage(rows.select("url"), attempts)


@check("sort_name", on_listing(f"select seq, name, condition from ({FAMILY_ROWS}) order by name nulls first, seq"))
def sort_name(spark, folder):
    return arranging.sort_name(family_rows(spark, folder).select("seq", "name", "condition"), ["seq"])


_CANONICAL = "name, promotion_price, original_price, condition"


@check(
    "union_sources",
    on_listing(
        f"select {_CANONICAL} from ({PRICE_ROWS}) union all select {_CANONICAL} from ({PRICE_ROWS}) "
        f"union all select {_CANONICAL} from ({FAMILY_ROWS})"
    ),
)
def union_sources(spark, folder):
    rows = price_rows(spark, folder)
    return arranging.union_sources(
        rows.select(*PRICE_COLUMNS),
        rows.select(*PRICE_COLUMNS),
        family_rows(spark, folder).select(*reversed(PRICE_COLUMNS)),
    )


@check(
    "union_toggle",
    on_listing(f"select {_CANONICAL} from ({FAMILY_ROWS}) union all select {_CANONICAL} from ({PRICE_ROWS})"),
)
def union_toggle(spark, folder):
    watched = price_rows(spark, folder).select(*PRICE_COLUMNS)
    return arranging.union_toggle(family_rows(spark, folder).select(*PRICE_COLUMNS), watched, False)


# -- shop runs ------------------------------------------------------------------------
for _profile in RETAILERS:
    check(f"standardize_{_profile}", on_listing(oracle.standard(PRICE_ROWS, _profile)))(
        lambda spark, folder, p=_profile: cleaning.standardize(price_rows(spark, folder), p, RUN_DATE)
    )


_READERS = {
    "7e": oracle.digits_price,
    "makro": oracle.num,
    "bigc": oracle.num,
    "lotus": oracle.strip_price,
    "tops": lambda x: oracle.num(f"replace(replace({x}, '฿', ''), ',', '')"),
}
for _profile in RETAILERS:
    check(
        f"standardize_raw_{_profile}",
        on_listing(oracle.standard(
            oracle.typed("select name, promotion_text, original_text, badge_text as condition from listing",
                         _READERS[_profile]),
            _profile,
        )),
    )(
        lambda spark, folder, p=_profile: cleaning.standardize(
            cleaning.read_prices(listing(spark, folder).withColumnRenamed("badge_text", "condition"), p),
            p,
            RUN_DATE,
        )
    )


def makro_tables(spark: SparkSession, folder: str, keep: bool = False) -> shops.Tables:
    """Of the watched product pages, some were never stored, some have no markup and some refused markup."""
    pages = inputs.details_makro(spark, folder)
    number = F.col("url_no")
    html = F.when(number % 23 == 5, F.lit(None)).when(number % 23 == 6, "<h1>Soap</h1><![nonsense x]]>").otherwise(F.col("html"))
    return shops.makro_run(
        inputs.cards_makro(spark, folder, "family_name"),
        pages.where(number % 23 != 4).withColumn("html", html),
        search_list(spark, folder),
        RUN_DATE,
        keep,
        pages.select("url"),
    )


_MAKRO_CATALOGUE = oracle.first_of(oracle.card_makro("family_name"), "name", "page_no, pos")
_MAKRO_CARDS = (
    "select name, promotion_price, nullif(original_price, promotion_price) as original_price, condition "
    f"from ({_MAKRO_CATALOGUE})"
)
_FAILED = "p.url_no%23 in (4, 5, 6)"
_MAKRO_WATCHED = (
    f"select case when not {_FAILED} then p.name end as name, "
    f"case when not {_FAILED} then {oracle.num('p.promotion_text')} end as promotion_price, "
    f"case when not {_FAILED} then {oracle.num('p.original_text')} end as original_price, "
    f"case when not {_FAILED} then c.condition end as condition "
    f"from ({oracle.PRICE_MAKRO}) p left join ({oracle.TIERS_MAKRO}) c on p.url = c.url"
)
_MAKRO_LISTING = oracle.standard(f"{_MAKRO_CARDS} union all {_MAKRO_WATCHED}", "makro")


@check(
    "makro_catalogue",
    on_listing(
        "select url_no, url, page_no, pos, name, promotion_price, original_price, condition, "
        "round((original_price - promotion_price) / original_price * 100, 1) as discount_pct from "
        "(select * replace (nullif(original_price, promotion_price) as original_price) "
        f"from ({_MAKRO_CATALOGUE}))"
    ),
)
def makro_catalogue(spark, folder):
    return shops.makro_catalogue(inputs.cards_makro(spark, folder, "family_name"))


@check("run_makro", on_listing(_MAKRO_LISTING))
def run_makro(spark, folder):
    return makro_tables(spark, folder)["listing"]


@check("run_makro_watchlist", on_listing(oracle.standard(_MAKRO_WATCHED, "makro")))
def run_makro_watchlist(spark, folder):
    return makro_tables(spark, folder)["watchlist"]


@check("run_makro_failed_pages", on_listing(
    oracle.standard(f"select * from ({_MAKRO_WATCHED}) where name is null", "makro")
))
def run_makro_failed_pages(spark, folder):
    return makro_tables(spark, folder)["watchlist"].where("name is null")


@check("run_makro_search", on_listing(oracle.searched(oracle.search_list(), _MAKRO_LISTING)))
def run_makro_search(spark, folder):
    return makro_tables(spark, folder, keep=True)["search"]


_SHOWN = "name, promotion_price, original_price"


@check(
    "dated_run_roundtrip",
    on_listing(
        " union all ".join(
            f"select '{kind}' as kind, 'Makro, big & small' as shop, {columns} from ({sql})"
            for kind, columns, sql in (
                ("listing", _SHOWN, _MAKRO_LISTING),
                ("watchlist", _SHOWN, oracle.standard(_MAKRO_WATCHED, "makro")),
                ("search", "product_name, promotion_price, original_price", oracle.searched(oracle.search_list(), _MAKRO_LISTING)),
            )
        )
        + f" union all select 'listing', 'BigC', {_SHOWN} from ({oracle.standard(PRICE_ROWS, 'bigc')})"
    ),
)
def dated_run_roundtrip(spark, folder):
    """Three tables of a run, published again over an earlier run, beside another shop's and a killed one."""
    root, shop = scratch_path(spark, "runs"), "Makro, big & small"
    made = makro_tables(spark, folder, keep=True)
    rows = price_rows(spark, folder, spread=True)  # their names are parsed in the write
    earlier = {k: df.limit(3) for k, df in made.items()} | {"found_late": rows.select("name")}
    run_store.publish(spark, root, [run_store.Run(shop, RUN_DATE, earlier)])
    bigc = run_store.Run("BigC", RUN_DATE, {"listing": cleaning.standardize(rows, "bigc", RUN_DATE)})
    run_store.publish(spark, root, [run_store.Run(shop, RUN_DATE, made), bigc])
    run_store.write_table(made["listing"], root, "listing", bigc, "killed")  # and no manifest
    kinds = []
    for kind in ("listing", "watchlist", "search", "found_late"):
        df = run_store.read_kind(spark, root, kind)
        name = F.col("name" if "name" in df.columns else "product_name") if len(df.columns) > 2 else F.lit(None).cast("string")
        prices = (F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("promotion_price", "original_price"))
        kinds.append(df.select(F.lit(kind).alias("kind"), "shop", name.alias("name"), *prices))
    return arranging.union_sources(*kinds)


def bigc_tables(spark: SparkSession, folder: str, keep: bool = False) -> shops.Tables:
    return shops.bigc_run(
        inputs.cards_bigc(spark, folder),
        inputs.details_bigc(spark, folder),
        inputs.badge_texts(spark, folder),
        search_list(spark, folder, "name"),
        RUN_DATE,
        keep,
    )


def _badged(source: str) -> str:
    return f"select s.*, l.label as condition from ({source}) s left join labels l on s.badge_url = l.badge_url"


_BIGC_WATCHED = _badged(oracle.DETAIL_BIGC)


@check(
    "run_bigc",
    on_listing(
        oracle.standard(_badged(oracle.typed(oracle.CARD_BIGC, oracle.num)), "bigc"), labels=oracle.BADGE_LABELS
    ),
)
def run_bigc(spark, folder):
    return bigc_tables(spark, folder)["listing"]


@check("run_bigc_watchlist", on_listing(oracle.standard(_BIGC_WATCHED, "bigc"), labels=oracle.BADGE_LABELS))
def run_bigc_watchlist(spark, folder):
    return bigc_tables(spark, folder)["watchlist"]


@check(
    "run_bigc_search",
    on_listing(oracle.searched(oracle.search_list("name"), _BIGC_WATCHED), labels=oracle.BADGE_LABELS),
)
def run_bigc_search(spark, folder):
    return bigc_tables(spark, folder, keep=True)["search"]


def lotus_tables(spark: SparkSession, folder: str, keep: bool = False) -> shops.Tables:
    pages = inputs.details_lotus(spark, folder)
    return shops.lotus_run(
        inputs.cards_lotus(spark, folder, "family_name"),
        pages,
        pages.select("url"),
        search_list(spark, folder, "name"),
        RUN_DATE,
        keep,
    )


_LOTUS_WATCHED = (
    "select 'https://shop.example/p/'||l.seq as url, "
    "case when d.name is null then 'Blocked or Not Found' else d.name end as name, d.promotion_price, "
    "d.original_price, d.condition from listing l left join "
    f"({oracle.DETAIL_LOTUS}) d on d.url_no = l.seq"
)


@check(
    "run_lotus",
    on_listing(oracle.standard(oracle.first_of(oracle.card_lotus("family_name"), "name", "page_no, pos"), "lotus")),
)
def run_lotus(spark, folder):
    return lotus_tables(spark, folder)["listing"]


@check("run_lotus_watchlist", on_listing(oracle.standard(_LOTUS_WATCHED, "lotus", keep="url")))
def run_lotus_watchlist(spark, folder):
    return lotus_tables(spark, folder)["watchlist"]


@check("run_lotus_search", on_listing(oracle.searched(oracle.search_list("name"), _LOTUS_WATCHED)))
def run_lotus_search(spark, folder):
    return lotus_tables(spark, folder, keep=True)["search"]


_7E_WATCHED = oracle.typed(oracle.DETAIL_7E, oracle.digits_price)
_7E_CARDS = oracle.first_of(oracle.typed(oracle.CARD_7E, oracle.digits_price), "name", "page_no, pos")


@check("run_7e", on_listing(oracle.standard(_7E_WATCHED, "7e")))
def run_7e(spark, folder):
    return shops.seven_eleven_run(
        inputs.catalogue_7e(spark, folder), inputs.details_7e(spark, folder), RUN_DATE
    )["listing"]


@check(
    "run_7e_with_catalogue",
    on_listing(
        oracle.standard(
            f"select {_CANONICAL} from ({_7E_CARDS}) union all select {_CANONICAL} from ({_7E_WATCHED})", "7e"
        )
    ),
)
def run_7e_with_catalogue(spark, folder):
    return shops.seven_eleven_run(
        inputs.catalogue_7e(spark, folder), inputs.details_7e(spark, folder), RUN_DATE, just_watchlist=False, keep=True
    )["listing"]


@check("run_tops", on_listing(oracle.standard(oracle.DETAIL_TOPS, "tops")))
def run_tops(spark, folder):
    return shops.tops_run(inputs.details_tops(spark, folder), RUN_DATE)["watchlist"]


@check(
    "run_tops_catalogue",
    on_listing(oracle.standard(f"select *, cast(null as varchar) as condition from ({oracle.CARD_TOPS})", "tops")),
)
def run_tops_catalogue(spark, folder):
    return shops.tops_catalogue(inputs.cards_tops(spark, folder), RUN_DATE)


@check("run_shopee", on_listing(f"select *, {oracle.DATE} as \"Date\" from ({oracle.FEED_FLAT})"))
def run_shopee(spark, folder):
    return shops.shopee_items(items(spark, folder), RUN_DATE)


@check("run_shopee_vn", on_listing(oracle.FEED_OPTIONAL))
def run_shopee_vn(spark, folder):
    return shops.shopee_vn_items(items(spark, folder))


@check("run_shopee_models", on_listing(oracle.FEED_MODELS))
def run_shopee_models(spark, folder):
    return shops.shopee_models(items(spark, folder))


_GO_DICTIONARY = (
    "select distinct family_name||' 3.5 Liters - '||(seq//2) as vi, "
    "upper(family_name)||' 3.5 liters - '||(seq//2) as en from listing where seq%4=0"
)


@check(
    "run_go",
    on_listing(
        f"select *, {oracle.volume('go', 'product_name_en')} as \"Volume\", "
        f"{oracle.unit('go', 'product_name_en')} as \"Unit\", "
        f"{oracle.group('product_name_en', '-[ ]*([0-9]+)$', 1)} as product_id from "
        "(select coalesce(en, product_name_vi) as product_name_en, product_name_vi, sale_price, original_price, "
        f"discount_pct from ({oracle.first_of(oracle.CARD_GO, 'product_name_vi', 'page_no, pos')}) "
        "left join dictionary on product_name_vi = vi)",
        dictionary=_GO_DICTIONARY,
    ),
)
def run_go(spark, folder):
    half = F.floor(F.col("seq") / 2).cast("string")
    known = (
        listing(spark, folder)
        .where("seq % 4 = 0")
        .select(
            F.concat("family_name", F.lit(" 3.5 Liters - "), half).alias("product_name_vi"),
            F.concat(F.upper("family_name"), F.lit(" 3.5 liters - "), half).alias("translated"),
        )
        .distinct()
    )
    return shops.go_vietnam(inputs.cards_go(spark, folder), known)


@check(
    "all_retailers",
    on_listing(
        " union all ".join(
            f"select * from ({q})"
            for q in (
                _MAKRO_LISTING,
                oracle.standard(_BIGC_WATCHED, "bigc"),
                oracle.standard(_LOTUS_WATCHED, "lotus"),
                oracle.standard(_7E_WATCHED, "7e"),
                oracle.standard(oracle.DETAIL_TOPS, "tops"),
            )
        ),
        labels=oracle.BADGE_LABELS,
    ),
)
def all_retailers(spark, folder):
    return shops.all_retailers(
        run_makro(spark, folder),
        run_bigc_watchlist(spark, folder),
        run_lotus_watchlist(spark, folder),
        run_7e(spark, folder),
        run_tops(spark, folder),
    )


def one_walk(spark: SparkSession, folder: str) -> dict[str, shops.Tables]:
    """All shops' runs over one stored page table."""
    pages = stored(inputs.all_pages(spark, folder), "all-pages")
    asked = search_list(spark, folder).select("product_name")
    watched = pages.where("page_kind = 'product'").select("retailer", "url")
    # pages that were never stored are on the watchlist as well
    missing = inputs.details_makro(spark, folder).where("url_no % 23 = 4").select(F.lit("makro").alias("retailer"), "url")
    searches = [asked.withColumn("retailer", F.lit(shop)) for shop in ("makro", "bigc", "lotus")]
    return shops.runs_of_one_walk(
        pages,
        inputs.badge_texts(spark, folder),
        arranging.union_sources(watched, missing),
        arranging.union_sources(*searches),
        RUN_DATE,
    )


@check("all_retailers_one_walk", ORACLE["all_retailers"])
def all_retailers_one_walk(spark, folder):
    runs = one_walk(spark, folder)
    watched = (runs[shop]["watchlist"] for shop in ("bigc", "lotus", "7e", "tops"))
    return shops.all_retailers(runs["makro"]["listing"], *watched)


@check(
    "walk_rejects",
    on_listing(
        "select 'makro' as retailer, 'https://shop.example/p/'||seq as url, "
        "case seq%23 when 5 then 'no markup' else 'refused markup' end as reason from listing where seq%23 in (5, 6) "
        "union all select 'bigc', 'https://shop.example/p/'||seq, 'not the page asked for' from listing where seq%11 = 0 "
        "union all select 'other', url, 'no rule' from pages"
    ),
)
def walk_rejects(spark, folder):
    return one_walk(spark, folder)["pages"]["rejects"].select("retailer", "url", "reason")


@check(
    "walk_page_states",
    on_listing(
        "select retailer, state, count(*) as n_pages from ("
        "select 'makro' as retailer, case seq%23 when 5 then 'no markup' when 6 then 'refused markup' else 'products' end as state "
        "from listing where seq%23 <> 4 union all "
        "select 'bigc', case when seq%11 = 0 then 'not the page asked for' else 'products' end from listing union all "
        "select shop, 'products' from listing, (values ('lotus'), ('7e'), ('tops')) as t(shop) union all "
        "select 'other', 'no rule' from pages) group by retailer, state"
    ),
)
def walk_page_states(spark, folder):
    """Every product page that went into the walk, counted by what came of it."""
    states = one_walk(spark, folder)["pages"]["states"].where("page_kind = 'product'")
    return states.groupBy("retailer", "state").agg(F.count("*").alias("n_pages"))



# -- the same operators over price sightings: many rows, one name on a third of them ----
def sighting_prices(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.sightings(spark, folder).select(
        "order_no", "line_no", "supplier", "name",
        prices.price_from_text(F.col("promotion_text")).alias("promotion_price"),
        prices.price_from_text(F.col("original_text")).alias("original_price"),
        "condition",
    )


_SIGHTING_ORDER = ["order_no", "line_no", "supplier", "promotion_price", "original_price", "condition"]


@check("sightings_standardize", on_listing(oracle.standard(oracle.SIGHTING_PRICES, "makro")))
def sightings_standardize(spark, folder):
    return cleaning.standardize(sighting_prices(spark, folder), "makro", RUN_DATE)


@check(
    "sightings_dedupe_first",
    on_listing(
        oracle.first_of(
            oracle.SIGHTING_PRICES, "name",
            "order_no, line_no, supplier, promotion_price, original_price nulls first, condition",
        )
    ),
)
def sightings_dedupe_first(spark, folder):
    return dedupe.dedupe_first(sighting_prices(spark, folder), _SIGHTING_ORDER)


@check(
    "sightings_search_join",
    on_listing(
        oracle.searched(
            oracle.search_list("name") + " union all select 'Unknown'",
            oracle.SIGHTING_PRICES,
        )
    ),
)
def sightings_search_join(spark, folder):
    wanted = search_list(spark, folder, "name")
    placeholder = tables.search_names(spark, ["Unknown"])
    return joins.search_join(wanted.unionByName(placeholder), sighting_prices(spark, folder))
