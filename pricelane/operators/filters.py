"""Predicates on pages and listings, and the filters built from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelane.fixed_values import (
    BIGC_BLOCK_HTML,
    BIGC_BLOCK_TITLE,
    LOTUS_BLOCK_TITLE,
    NO_BADGE,
    NO_NAME_PRODUCT,
    TOPS_BLOCK_TITLES,
    TOPS_SITE,
)
from pricelane.functions.text import contains_any, strip_ws
from pricelane.functions.urls import is_merged_url


# Page predicates. Each is true for pages worth keeping and never null.
def bigc_page_ok(html: Column) -> Column:
    return ~contains_any(html, BIGC_BLOCK_HTML)


def has_name(title: Column) -> Column:
    """A title that exists, is no "missing" placeholder and no challenge text."""
    known = title.isNotNull() & (strip_ws(title) != NO_NAME_PRODUCT)
    return F.coalesce(known & ~title.contains(BIGC_BLOCK_TITLE), F.lit(False))


def lotus_name_ok(title: Column) -> Column:
    known = title.isNotNull() & (strip_ws(title) != NO_NAME_PRODUCT)
    return F.coalesce(known & ~title.contains(LOTUS_BLOCK_TITLE), F.lit(False))


def tops_name_ok(title: Column, heading: Column) -> Column:
    """A title that exists on a page whose visible heading is no challenge text."""
    named = (title != "") & ~F.lower(title).contains(TOPS_SITE)
    return F.coalesce(named & ~contains_any(F.lower(heading), TOPS_BLOCK_TITLES), F.lit(False))


def is_blocked(h1: Column, html_ok: Column, retailer: Column) -> Column:
    """A challenge or consent page by its shop's own rule; shops without a rule block nothing."""
    shop = F.lower(retailer)
    return (
        F.when(shop == "bigc", F.coalesce(h1.contains(BIGC_BLOCK_TITLE), F.lit(False)) | ~html_ok)
        .when(shop == "tops", F.coalesce(contains_any(F.lower(h1), TOPS_BLOCK_TITLES), F.lit(False)))
        .when(shop == "lotus", h1.isNull() | h1.contains(LOTUS_BLOCK_TITLE))
        .otherwise(F.lit(False))
    )


def valid_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Rows with a real product name: not empty, no placeholder, no site title."""
    title = F.col(name)
    bad = (
        title.isNull()
        | (title == "")
        | (title == NO_NAME_PRODUCT)
        | F.lower(title).contains(TOPS_SITE)
    )
    return df.where(~bad)


def merged_url_guard(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(~is_merged_url(F.col(url)))


def with_condition(df: DataFrame) -> DataFrame:
    return df.where(F.col("condition").isNotNull())


def with_badge(df: DataFrame) -> DataFrame:
    """Rows with a real badge address."""
    badge = F.col("badge_url")
    return df.where(badge.isNotNull() & ~badge.isin("", NO_BADGE))


def item_lookup(items: DataFrame, item_id: int, shop_id: int) -> DataFrame:
    return items.where((F.col("item_id") == item_id) & (F.col("shop_id") == shop_id))


def brand_price_filter(
    listing: DataFrame, brands: Iterable[str], low: float, high: float, price: str = "original_price"
) -> DataFrame:
    """Rows of some brands in a closed price range.

    On a stored listing both conditions reach the file scan.
    """
    return listing.where(F.col("Brand").isin(*brands) & F.col(price).between(low, high))
