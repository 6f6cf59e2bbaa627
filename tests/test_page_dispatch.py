import datetime
import re

import pytest
from pyspark.sql import functions as F

from checks import inputs, queries
from pricelane.operators import dedupe
from pricelane.plans import shops
from pricelane.session import stored
from pricelane.sources import page_dispatch, shop_pages

SCHEMA = "retailer string, page_kind string, url_no int, url string, page_no int, html string"
CARD = '<div class="item-list-wrapper"><a class="productlink" title="{}"></a><strong>{}</strong></div>'


def walked(spark, rows):
    return page_dispatch.walk_all(spark.createDataFrame(rows, SCHEMA))


def test_every_page_has_one_state(spark):
    rows = [
        ("7e", "category", 1, "a", 1, CARD.format("Soap", 5) + CARD.format("Rice", 6)),
        ("7e", "category", 1, "a", 2, "<p>nothing here"),
        ("7e", "category", 1, "a", 3, None),
        ("7e", "category", 1, "a", 4, "<h1>x</h1><![nonsense x]]>"),
        ("bigc", "product", 1, "b", 1, "<h1>x</h1><script>Cloudflare</script>"),
        ("bigc", "product", 1, "b", 2, None),
        ("nobody", "product", 1, "c", 1, "<p>x"),
        (None, None, None, None, None, None),
    ]
    found = walked(spark, rows)
    states = {(r["retailer"], r["page_no"]): (r["state"], r["n_found"]) for r in page_dispatch.page_states(found).collect()}
    assert states == {
        ("7e", 1): ("products", 2), ("7e", 2): ("no products", 0), ("7e", 3): ("no markup", 0), ("7e", 4): ("refused markup", 0),
        ("bigc", 1): ("not the page asked for", 0), ("bigc", 2): ("no markup", 0), ("nobody", 1): ("no rule", 0), (None, None): ("no rule", 0),
    }
    assert found.where(F.col("state") == shop_pages.PIECE).count() == 2
    assert page_dispatch.rejects(found).count() == 6
    assert {(r["state"], r["n_pages"], r["n_found"]) for r in page_dispatch.state_counts(found).where("retailer = '7e'").collect()} >= {("products", 1, 2)}
    named = {r["reason"]: r["detail"] for r in page_dispatch.rejects(found).collect()}
    assert named["refused markup"] and named["no markup"] is None


def test_an_error_of_one_rule_rejects_one_page(spark, monkeypatch):
    def bad(tree):
        yield {"title": "x"}
        raise KeyError("rule")

    bad.fields, bad.page_ok = shop_pages._detail_7e_pieces.fields, None
    monkeypatch.setitem(page_dispatch.RULES, ("7e", "product"), bad)
    rows = [("7e", "product", 1, "a", 1, "<h1>x"), ("7e", "category", 1, "a", 1, CARD.format("Soap", 5))]
    states = {(r["page_kind"], r["state"], r["detail"]) for r in page_dispatch.page_states(walked(spark, rows)).collect()}
    assert states == {("product", "refused markup", "KeyError"), ("category", "products", None)}
    plain = spark.createDataFrame(rows, SCHEMA)
    assert shop_pages.walk_pages(plain.where("page_kind = 'product'"), bad).count() == 0


def test_the_walk_reads_the_markup_once(spark, folder):
    plan = page_dispatch.walk_all(stored(inputs.all_pages(spark, folder), "pages"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\+- MapInArrow|^MapInArrow", plan, re.M)) == 1 and plan.count("FileScan") == 1
    runs = queries.one_walk(spark, folder)
    for tables in (runs["makro"], runs["tops"], runs["7e"]):
        for df in tables.values():
            assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shop", ["makro", "lotus", "bigc", "tops"])
def test_walked_pages_give_the_rows_of_plain_pages(spark, folder, shop):
    pages = {
        "makro": (inputs.cards_makro, shop_pages.extract_card_makro), "lotus": (inputs.cards_lotus, shop_pages.extract_card_lotus),
        "bigc": (inputs.cards_bigc, shop_pages.extract_card_bigc), "tops": (inputs.cards_tops, shop_pages.extract_card_tops),
    }[shop]
    plain = pages[0](spark, folder)
    one = page_dispatch.stored_walk(plain.select(F.lit(shop).alias("retailer"), F.lit("category").alias("page_kind"), "*"))
    got = pages[1](page_dispatch.of(one, shop, "category"))
    want = pages[1](plain)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def catalogue(spark, pages):
    rows = [("7e", "category", 0, url, no, None if names is None else "".join(CARD.format(n, 1) for n in names) or "<p>") for url, no, names in pages]
    return spark.createDataFrame(rows, SCHEMA)


PAGES = [
    ("a", 1, ["x", "y"]), ("a", 2, ["z"]), ("a", 3, ["z"]), ("a", 4, ["late"]),  # ends where page 2 comes again
    ("b", 1, ["x"]), ("b", 2, []), ("b", 3, ["late"]), ("c", 1, ["x"]), ("c", 2, None), ("c", 3, ["late"]),  # ends at an empty page
    ("d", 1, ["x", "y"]), ("d", 2, ["y", "x"]), ("d", 4, ["y", "x"]), ("e", 7, ["p"]),  # no end: another order, a gap
    (None, 1, ["n"]), ("f", None, ["n"]),
]


def test_ends_of_catalogues_by_marks(spark):
    pages = catalogue(spark, PAGES)
    ends = dedupe.catalogue_ends(shop_pages.catalogue_pages_7e(pages))
    assert {(r["url"], r["end_page"]) for r in ends.collect()} == {("a", 3), ("b", 2), ("c", 2)}
    old = dedupe.drop_repeated_pages(shop_pages.extract_card_7e(pages), pages)
    new = shop_pages.catalogue_cards_7e(dedupe.before_end(shop_pages.catalogue_pages_7e(pages), ends))
    assert sorted(map(str, new.where("url is not null and page_no is not null").collect())) == sorted(map(str, old.where("url is not null and page_no is not null").collect()))
    assert new.where("url is null or page_no is null").count() == 2
    assert dedupe.catalogue_ends(shop_pages.catalogue_pages_7e(pages.limit(0))).count() == 0


def test_equal_marks_alone_do_not_end_a_catalogue(spark):
    rows = [("a", 1, 7, ["x"]), ("a", 2, 7, ["y"]), ("a", 3, 7, ["y"])]
    pages = spark.createDataFrame(rows, "url string, page_no int, mark long, names array<string>")
    assert [tuple(r) for r in dedupe.catalogue_ends(pages).collect()] == [("a", 3)]


def test_the_catalogue_walks_its_pages_twice_at_most(spark, folder):
    pages = stored(inputs.catalogue_7e(spark, folder), "catalogue")
    plan = shops.seven_eleven_catalogue(pages)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"- MapInArrow", plan)) <= 2
    listing = shops.seven_eleven_run(pages, inputs.details_7e(spark, folder), datetime.date(2025, 3, 3), just_watchlist=False)["listing"]
    assert listing.count() == queries.QUERIES["run_7e_with_catalogue"](spark, folder).count()
