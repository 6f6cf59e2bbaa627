"""Shop runs: stored pages to the tables each shop's run delivers.

A run returns its tables by name, each a lazy DataFrame. Extraction is the
costly part, so a run stores the extracted rows once (``keep=True``) when more
than one table will be written from them.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelane.fixed_values import LISTING_COLUMNS, PRICE_COLUMNS
from pricelane.functions.promos import promo_label
from pricelane.operators import cleaning, dedupe, joins, nested, summary
from pricelane.operators.arranging import union_sources, union_toggle
from pricelane.session import stored
from pricelane.sources import page_dispatch, shop_pages
from pricelane.sources.shop_pages import SCRAPE_ORDER

Tables = dict[str, DataFrame]


def _keeper(keep: bool) -> Callable[[DataFrame, str], DataFrame]:
    return stored if keep else lambda df, label: df


def makro_catalogue(pages: DataFrame) -> DataFrame:
    """First sighting of each name, sham original prices removed, with percent off."""
    cards = dedupe.dedupe_first(shop_pages.extract_card_makro(pages), SCRAPE_ORDER)
    return cards.transform(cleaning.nullify_fake_original).transform(cleaning.with_discount_pct)


def watched_rows(watchlist: DataFrame, products: DataFrame) -> DataFrame:
    """One row per watched address: its first product row, or nulls."""
    firsts = dedupe.dedupe_first(products, SCRAPE_ORDER, keys=("url",))
    return watchlist.select("url").distinct().join(firsts, "url", "left")


def makro_run(
    category_pages: DataFrame,
    product_pages: DataFrame,
    search: DataFrame,
    run_date: datetime.date,
    keep: bool = False,
    watchlist: DataFrame | None = None,
) -> Tables:
    """``watchlist`` has the watched addresses, ``url``: each has one row in the
    watchlist table and the listing, with nulls if its page is absent, has no
    markup or markup that no parser reads.
    """
    hold = _keeper(keep)
    catalogue = cleaning.consistent_schema(makro_catalogue(category_pages))
    products = cleaning.read_prices(shop_pages.extract_product_makro(product_pages), "makro")
    if watchlist is not None:
        products = watched_rows(watchlist, products)
    watched = hold(cleaning.consistent_schema(products), "makro-watchlist")
    rows = hold(union_sources(catalogue, watched), "makro-rows")
    listing = cleaning.standardize(rows, "makro", run_date)
    return {
        "listing": listing,
        "watchlist": cleaning.standardize(watched, "makro", run_date),
        "search": joins.search_join(search, listing),
    }


def badge_labels(badge_texts: DataFrame) -> DataFrame:
    """Label of each badge address; an address read more than once is labelled once."""
    texts = badge_texts.groupBy("badge_url").agg(F.min("text").alias("text"))
    return texts.select("badge_url", promo_label(F.col("text")).alias("label"))


def bigc_run(
    category_pages: DataFrame,
    product_pages: DataFrame,
    badge_texts: DataFrame,
    search: DataFrame,
    run_date: datetime.date,
    keep: bool = False,
) -> Tables:
    """``badge_texts`` has the text read from each badge image: ``badge_url, text``."""
    hold = _keeper(keep)
    labels = hold(badge_labels(badge_texts), "bigc-labels")
    cards = joins.badge_map(
        cleaning.read_prices(shop_pages.extract_card_bigc(category_pages), "bigc"), labels
    )
    watched = hold(
        joins.badge_map(shop_pages.extract_detail_bigc(product_pages), labels), "bigc-watchlist"
    )
    return {
        "listing": cleaning.standardize(cards, "bigc", run_date),
        "watchlist": cleaning.standardize(watched, "bigc", run_date),
        "search": joins.search_join(search, watched),
    }


def lotus_run(
    category_pages: DataFrame,
    product_pages: DataFrame,
    watchlist: DataFrame,
    search: DataFrame,
    run_date: datetime.date,
    keep: bool = False,
) -> Tables:
    """``product_pages`` may hold several attempts per address, numbered by ``page_no``."""
    hold = _keeper(keep)
    catalogue = dedupe.dedupe_first(shop_pages.extract_card_lotus(category_pages), SCRAPE_ORDER)
    attempts = shop_pages.extract_detail_lotus(product_pages).withColumns(
        {"attempt": F.col("page_no"), "ok": F.lit(True)}
    )
    watched = hold(summary.watchlist_coverage(watchlist, attempts), "lotus-watchlist")
    return {
        "listing": cleaning.standardize(catalogue, "lotus", run_date),
        "watchlist": cleaning.standardize(watched, "lotus", run_date, keep=("url",)),
        "search": joins.search_join(search, watched),
    }


def seven_eleven_catalogue(pages: DataFrame, keep: bool = False) -> DataFrame:
    """First sighting of each name over all catalogues, each cut at its first repeated or empty page.

    The ``url`` of a page is its catalogue's address, without a page number.
    The pages are walked twice, for the ends and for the cards; ``keep`` stores the
    first walk, which then runs while the plan is built. Pages that were walked with
    those of other shops are compared as stored.
    """
    if isinstance(pages, shop_pages.WalkedPages):
        fresh = dedupe.drop_repeated_pages(shop_pages.extract_card_7e(pages), pages.pages())
    else:
        walked = _keeper(keep)(shop_pages.catalogue_pages_7e(pages), "7e-catalogue")
        ends = dedupe.catalogue_ends(walked)
        fresh = shop_pages.catalogue_cards_7e(dedupe.before_end(walked, ends))
    return dedupe.dedupe_first(cleaning.read_prices(fresh, "7e"), SCRAPE_ORDER)


def seven_eleven_run(
    category_pages: DataFrame,
    product_pages: DataFrame,
    run_date: datetime.date,
    just_watchlist: bool = True,
    keep: bool = False,
) -> Tables:
    hold = _keeper(keep)
    products = cleaning.read_prices(shop_pages.extract_detail_7e(product_pages), "7e")
    watched = hold(products.select(*PRICE_COLUMNS), "7e-watchlist")
    if just_watchlist:
        rows = watched
    else:
        catalogue = seven_eleven_catalogue(category_pages, keep).select(*PRICE_COLUMNS)
        rows = union_toggle(catalogue, watched, just_watchlist)
    return {
        "listing": cleaning.standardize(rows, "7e", run_date),
        "watchlist": cleaning.standardize(watched, "7e", run_date),
    }


def tops_run(product_pages: DataFrame, run_date: datetime.date) -> Tables:
    rows = shop_pages.extract_detail_tops(product_pages)
    return {"watchlist": cleaning.standardize(rows, "tops", run_date)}


def tops_catalogue(category_pages: DataFrame, run_date: datetime.date) -> DataFrame:
    """Catalogue pages show no offers, so ``condition`` is null."""
    cards = shop_pages.extract_card_tops(category_pages)
    return cleaning.standardize(
        cards.withColumn("condition", F.lit(None).cast("string")), "tops", run_date
    )


def shopee_items(items: DataFrame, run_date: datetime.date) -> DataFrame:
    return nested.json_flatten(items).withColumn("Date", F.lit(run_date))


def shopee_vn_items(items: DataFrame) -> DataFrame:
    return nested.json_optional_field(nested.json_nonempty(items))


def shopee_models(items: DataFrame) -> DataFrame:
    return nested.json_explode_models(items)


def go_vietnam(pages: DataFrame, dictionary: DataFrame) -> DataFrame:
    """First sighting of each name with its translation, volume, unit and product id."""
    firsts = dedupe.dedupe_first(
        shop_pages.extract_card_go(pages), SCRAPE_ORDER, keys=("product_name_vi",)
    )
    named = joins.translate_lookup(firsts, dictionary).select(
        "product_name_en", "product_name_vi", "sale_price", "original_price", "discount_pct"
    )
    return cleaning.parse_names_go(named)


def runs_of_one_walk(
    pages: DataFrame,
    badge_texts: DataFrame,
    watchlists: DataFrame,
    searches: DataFrame,
    run_date: datetime.date,
) -> dict[str, Tables]:
    """All shops' runs over one page table, which is read and walked once.

    ``pages`` has ``retailer, page_kind`` and the columns of pages; ``watchlists`` has ``retailer, url``,
    ``searches`` ``retailer, product_name``. Under ``pages`` the result has each page's state and the rejects.
    """
    walked = page_dispatch.stored_walk(pages)

    def of(retailer: str, kind: str) -> shop_pages.WalkedPages:
        return page_dispatch.of(walked, retailer, kind)

    def own(table: DataFrame, retailer: str) -> DataFrame:
        return table.where(F.col("retailer") == retailer).drop("retailer")

    return {
        "makro": makro_run(
            of("makro", "category"), of("makro", "product"), own(searches, "makro"), run_date, watchlist=own(watchlists, "makro")
        ),
        "bigc": bigc_run(of("bigc", "category"), of("bigc", "product"), badge_texts, own(searches, "bigc"), run_date),
        "lotus": lotus_run(
            of("lotus", "category"), of("lotus", "product"), own(watchlists, "lotus"), own(searches, "lotus"), run_date
        ),
        "7e": seven_eleven_run(of("7e", "category"), of("7e", "product"), run_date, just_watchlist=False),
        "tops": tops_run(of("tops", "product"), run_date) | {"listing": tops_catalogue(of("tops", "category"), run_date)},
        "pages": {"states": page_dispatch.page_states(walked), "rejects": page_dispatch.rejects(walked)},
    }


def all_retailers(*listings: DataFrame) -> DataFrame:
    """One table of all shops' listings; a shop without rows adds nothing."""
    return union_sources(*(listing.select(*LISTING_COLUMNS) for listing in listings))
