"""Product extraction from stored shop pages.

The page walk runs in Arrow batches inside Spark tasks and only picks raw
pieces out of the markup; every rule on those pieces is a Spark column
expression. A page gives 0..n rows, numbered by ``pos`` in page order. Input
pages have ``url_no, url, page_no, html``, where ``url_no`` is the place of the
address in the shop's list; ``html`` is never carried past the walk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelane.fixed_values import (
    NO_BADGE,
    NO_NAME_CARD,
    NO_NAME_DETAIL,
    NO_NAME_TIERS,
    NO_TEXT,
)
from pricelane.functions import prices, promos, text_nodes, urls
from pricelane.functions.text import (
    first_group,
    none_if_empty,
    strict_double,
    strip_ws,
)
from pricelane.operators.filters import (
    bigc_page_ok,
    has_name,
    is_blocked,
    lotus_name_ok,
    tops_name_ok,
)
from pricelane.session import spread_small
from pricelane.sources.html_tree import Element, HtmlTree

# Where a row was found; unique per row and in the order of collection.
SCRAPE_ORDER = ("url_no", "url", "page_no", "pos")

TEXT, TEXTS = "string", "array<string>"
_ARROW = {
    TEXT: pa.string(), TEXTS: pa.list_(pa.string()), "int": pa.int32(), "boolean": pa.bool_()
}
# A batch goes back to Spark after so many rows, or after reading so much markup.
_ROWS_PER_BATCH = 2000
_CHARS_PER_BATCH = 32 << 20

Pieces = Callable[[HtmlTree], Iterator[dict]]


def gives(page_ok: Callable[[Column], Column] | None = None, **fields: str) -> Callable[[Pieces], Pieces]:
    """Names the fields of the pieces that a rule finds; ``page_ok`` tells by the markup whether a page is the one asked for."""

    def named(rule: Pieces) -> Pieces:
        rule.fields, rule.page_ok = fields, page_ok
        return rule

    return named


def found_in(html: str, rule: Pieces) -> tuple[list[dict], str | None]:
    """All pieces of one page, or the name of the error that its markup gave."""
    try:
        return list(rule(HtmlTree(html))), None
    except Exception as error:  # whatever one page does to the parser or a rule, the others go on
        return [], type(error).__name__


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """The rows as a batch; fields that no row has are null and cost nothing a row."""
    held = set().union(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(f.name) for row in rows], f.type) if f.name in held else pa.nulls(len(rows), f.type) for f in schema], schema=schema
    )


def walk_pages(pages: DataFrame | WalkedPages, rule: Pieces, keep: dict[str, str] | None = None) -> DataFrame:
    """Rows ``url_no, url, page_no, pos, <fields>`` that a rule finds in each page.

    A page without markup, or with markup that no parser accepts, has no rows;
    ``rejected_pages`` names these. ``keep`` has further columns of ``pages`` to
    keep next to the pieces, with their kinds. Pages that were walked before are read, not walked.
    """
    if isinstance(pages, WalkedPages):
        return pages.pieces(rule)
    fields = rule.fields
    kept = {"url_no": "int", "url": "string", "page_no": "int"} | (keep or {})
    schema = pa.schema(
        [(name, _ARROW[kind]) for name, kind in (kept | {"pos": "int"}).items()]
        + [(name, _ARROW[kind]) for name, kind in fields.items()]
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        read = 0
        for batch in batches:
            for page in batch.to_pylist():
                html = page.pop("html")
                rows += (page | {"pos": pos} | found for pos, found in enumerate(found_in(html, rule)[0]))
                read += len(html)
                if len(rows) >= _ROWS_PER_BATCH or read >= _CHARS_PER_BATCH:
                    yield batch_of(rows, schema)
                    rows, read = [], 0
        if rows:
            yield batch_of(rows, schema)

    ddl = ", ".join(f"{n} {k}" for n, k in (kept | {"pos": "int"} | fields).items())
    asked = F.col("html").isNotNull() if rule.page_ok is None else rule.page_ok(F.col("html"))
    wanted = pages.where(asked).select(*(F.col(n).cast(k).alias(n) for n, k in kept.items()), "html")
    return spread_small(wanted, "url", "page_no").mapInArrow(walk, ddl)


class WalkedPages(NamedTuple):
    """Pages of one shop and kind whose pieces were found in a walk over all shops' pages."""

    rows: DataFrame  # of page_dispatch.walk_all
    retailer: str
    page_kind: str

    def _own(self) -> DataFrame:
        return self.rows.where((F.col("retailer") == self.retailer) & (F.col("page_kind") == self.page_kind))

    def pieces(self, rule: Pieces) -> DataFrame:
        return self._own().where(F.col("state") == PIECE).select(*SCRAPE_ORDER, *rule.fields)

    def pages(self) -> DataFrame:
        """``url_no, url, page_no, state, n_found``, one row for each page."""
        return self._own().where(F.col("state") != PIECE).select("url_no", "url", "page_no", "state", "n_found")


def walk_catalogue(pages: DataFrame, rule: Pieces) -> DataFrame:
    """``url_no, url, page_no, cards``: the pieces of each page together; no cards where nothing can be read."""
    kept = {"url_no": "int", "url": "string", "page_no": "int"}
    card = pa.struct([(name, _ARROW[kind]) for name, kind in rule.fields.items()])
    schema = pa.schema([*((name, _ARROW[kind]) for name, kind in kept.items()), ("cards", pa.list_(card))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.to_pylist():
                html = page.pop("html")
                cards = [] if html is None else found_in(html, rule)[0]
                yield pa.RecordBatch.from_pylist([page | {"cards": cards}], schema=schema)

    struct = ", ".join(f"{n}: {k}" for n, k in rule.fields.items())
    ddl = ", ".join(f"{n} {k}" for n, k in kept.items()) + f", cards array<struct<{struct}>>"
    wanted = pages.select(*(F.col(n).cast(k).alias(n) for n, k in kept.items()), "html")
    return spread_small(wanted, "url", "page_no").mapInArrow(walk, ddl)


#: State of a row that holds a piece; the other states are those of pages.
PIECE = "piece"


def _result(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.select(*SCRAPE_ORDER, *(c.alias(n) for n, c in columns.items()))


def _kept(rows: DataFrame, keep: Callable[[Column], Column], **columns: Column) -> DataFrame:
    """Rows with these columns for which ``keep`` holds, each column computed once.

    A plain filter would move below the projection and compute them again.
    """
    row = F.struct(*(c.alias(n) for n, c in columns.items()))
    return rows.select(*SCRAPE_ORDER, F.inline(F.filter(F.array(row), keep)))


def _tag(*tags: str) -> Callable[[Element], bool]:
    return lambda e: e.tag in tags


def _div(part: str) -> Callable[[Element], bool]:
    """A div whose class text contains ``part``."""
    return lambda e: e.tag == "div" and part in e.class_name


def _classed(tag: str, *names: str) -> Callable[[Element], bool]:
    return lambda e: e.tag == tag and all(e.has_class(n) for n in names)


def _attr(element: Element | None, name: str) -> str | None:
    return None if element is None else element.attrs.get(name)


# -- headings of any page ---------------------------------------------------
@gives(h1=TEXT)
def _heading_pieces(tree: HtmlTree):
    yield {"h1": tree.text(tree.find(_tag("h1")))}


def extract_heading(pages: DataFrame) -> DataFrame:
    """One row per page with its first ``h1`` text (null without one)."""
    rows = walk_pages(pages, _heading_pieces)
    return _result(rows, h1=strip_ws(F.col("h1")))


def blocked_pages(pages: DataFrame) -> DataFrame:
    """Pages that hold a challenge or a consent banner instead of products, by ``retailer``'s rule."""
    flagged = pages.withColumn("html_ok", bigc_page_ok(F.col("html")))
    rows = walk_pages(flagged, _heading_pieces, keep={"html_ok": "boolean", "retailer": "string"})
    heading = strip_ws(F.col("h1"))
    return _result(rows.where(is_blocked(F.col("h1"), F.col("html_ok"), F.col("retailer"))), h1=heading)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """``retailer, url_no, url, page_no, reason`` of pages that no extraction can read.

    Reasons are ``no markup`` and ``refused markup``. Each page has rows in a walk
    or is named here; ``reject_counts`` sums up per shop.
    """
    page = ["retailer", "url_no", "url", "page_no"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for html in batch.column("html").to_pylist():
                bad.append(found_in(html, _heading_pieces)[1] is not None)
            yield batch.drop_columns(["html"]).filter(pa.array(bad))

    wanted = pages.select(*page, "html")
    kinds = dict(wanted.dtypes)
    refused = wanted.where(F.col("html").isNotNull()).mapInArrow(walk, ", ".join(f"{c} {kinds[c]}" for c in page))
    missing = wanted.where(F.col("html").isNull()).select(*page, F.lit("no markup").alias("reason"))
    return missing.unionByName(refused.withColumn("reason", F.lit("refused markup")))


def reject_counts(pages: DataFrame) -> DataFrame:
    return rejected_pages(pages).groupBy("retailer", "reason").agg(F.count("*").alias("n_pages"))


# -- 7-Eleven ---------------------------------------------------------------
@gives(title=TEXT, description=TEXT, promotion=TEXT, original=TEXT, flag_style=TEXT)
def _card_7e_pieces(tree: HtmlTree):
    for card in tree.find_all(lambda e: e.has_class("item-list-wrapper") or e.has_class("product-item")):
        yield {
            "title": _attr(tree.find(_classed("a", "productlink"), card), "title"),
            "description": tree.text(tree.find(lambda e: e.has_class("item-description-cls-mobile"), card)),
            "promotion": tree.text(tree.find(_tag("strong"), card)),
            "original": tree.text(tree.find(_tag("s", "strike", "del"), card)),
            "flag_style": _attr(tree.find(lambda e: e.has_class("flag"), card), "style"),
        }


def _card_7e_name(title: Column, description: Column) -> Column:
    return F.coalesce(none_if_empty(title), strip_ws(description), F.lit(NO_NAME_CARD))


def catalogue_pages_7e(pages: DataFrame) -> DataFrame:
    """``url_no, url, page_no, mark, names, cards`` of each catalogue page; ``mark`` is a digest of the ordered names."""
    names = F.transform("cards", lambda c: _card_7e_name(c["title"], c["description"]))
    found = walk_catalogue(pages, _card_7e_pieces).select("*", names.alias("names"))
    return found.select("url_no", "url", "page_no", F.xxhash64("names").alias("mark"), "names", "cards")


def catalogue_cards_7e(catalogue: DataFrame) -> DataFrame:
    """The cards of ``catalogue_pages_7e``, as ``extract_card_7e`` gives them."""
    cards = catalogue.select("url_no", "url", "page_no", F.posexplode("cards").alias("pos", "card"))
    return _cards_7e(cards.select(*SCRAPE_ORDER, "card.*"))


def extract_card_7e(pages: DataFrame) -> DataFrame:
    return _cards_7e(walk_pages(pages, _card_7e_pieces))


def _cards_7e(rows: DataFrame) -> DataFrame:
    return _result(
        rows,
        name=_card_7e_name(F.col("title"), F.col("description")),
        promotion_text=strip_ws(F.col("promotion")),
        original_text=strip_ws(F.col("original")),
        condition=F.upper(first_group(F.col("flag_style"), r"/([A-Za-z0-9_]+)-th\.svg")),
    )


@gives(title=TEXT, promotion=TEXT, original=TEXT, flags=TEXTS)
def _detail_7e_pieces(tree: HtmlTree):
    gallery = tree.find(lambda e: e.has_class("gallery") or e.has_class("art-detail-page-top"))
    yield {
        "title": tree.text(tree.find(_tag("h1"))),
        "promotion": tree.text(tree.find(lambda e: e.has_class("currentPrice"))),
        "original": tree.text(tree.find(_tag("strike"))),
        "flags": [e.attrs.get("style", "") for e in tree.find_all(lambda e: e.has_class("flag"), gallery)],
    }


def extract_detail_7e(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _detail_7e_pieces)
    offers = F.filter(
        F.transform("flags", F.upper), lambda f: f.contains("1GET1") | f.contains("2GET1")
    )
    offer = F.get(offers, F.lit(0))
    return _result(
        rows,
        name=F.coalesce(strip_ws(F.col("title")), F.lit(NO_NAME_DETAIL)),
        promotion_text=strip_ws(F.col("promotion")),
        original_text=strip_ws(F.col("original")),
        condition=F.when(offer.contains("1GET1"), "1GET1").when(offer.isNotNull(), "2GET1"),
    )


# -- Makro ------------------------------------------------------------------
@gives(texts=TEXTS, offer=TEXT)
def _card_makro_pieces(tree: HtmlTree):
    for card in tree.find_all(lambda e: e.tag == "a" and "/p/" in e.attrs.get("href", "")):
        yield {
            "texts": tree.stripped(card),
            "offer": tree.packed(
                tree.find(lambda e: "_lbl_buy_more" in e.attrs.get("data-test-id", ""), card)
            ),
        }


def extract_card_makro(pages: DataFrame, min_texts: int = 3) -> DataFrame:
    """Cards with a name and a price; a card with fewer than ``min_texts`` texts is no product."""
    rows = walk_pages(pages, _card_makro_pieces)
    texts = F.col("texts")
    found = _kept(
        rows.where(F.size(texts) >= min_texts),
        lambda card: card["name"].isNotNull() & (F.size(card["prices"]) > 0),
        name=text_nodes.texts_name(texts),
        prices=text_nodes.texts_prices(texts),
        condition=text_nodes.texts_condition(texts, F.col("offer")),
    )
    return _result(
        found,
        name=F.col("name"),
        promotion_price=F.array_min("prices"),
        original_price=F.array_max("prices"),
        condition=F.col("condition"),
    )


def _titled(e: Element) -> bool:
    return e.attrs.get("data-test-id", "").endswith("_product_title")


@gives(title=TEXT, lines=TEXTS)
def _price_makro_pieces(tree: HtmlTree):
    title = tree.find(_titled) or tree.find(_tag("h1"))
    yield {
        "title": tree.shown(title),
        "lines": [] if title is None else tree.lines(tree.find(_tag("body")) or tree.root),
    }


def extract_price_makro(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _price_makro_pieces)
    found = text_nodes.price_lines(F.col("lines"), F.col("title"))
    promotion, original = text_nodes.price_line_pair(F.col("found"))
    return _result(
        rows.withColumn("found", found),
        name=F.col("title"),
        promotion_text=promotion,
        original_text=original,
    )


@gives(title=TEXT, texts=TEXTS)
def _tiers_makro_pieces(tree: HtmlTree):
    yield {
        "title": tree.text(tree.find(lambda e: e.tag == "div" and _titled(e))),
        "texts": tree.stripped(tree.root),
    }


def extract_tiers_makro(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _tiers_makro_pieces)
    tiers = text_nodes.tiers_json(text_nodes.quantity_tiers(F.col("texts")))
    return _result(
        rows,
        name=F.coalesce(strip_ws(F.col("title")), F.lit(NO_NAME_TIERS)),
        condition=promos.sentinel_null(tiers),
    )


@gives(title=TEXT, lines=TEXTS, texts=TEXTS)
def _product_makro_pieces(tree: HtmlTree):
    priced, tiered = next(_price_makro_pieces(tree)), next(_tiers_makro_pieces(tree))
    yield {"title": priced["title"], "lines": priced["lines"], "texts": tiered["texts"]}


def extract_product_makro(pages: DataFrame) -> DataFrame:
    """Prices and quantity tiers of product pages in one walk.

    The same rows as joining ``extract_price_makro`` and ``extract_tiers_makro``
    of one page set by address, without the second walk and the join.
    """
    rows = walk_pages(pages, _product_makro_pieces)
    found = text_nodes.price_lines(F.col("lines"), F.col("title"))
    promotion, original = text_nodes.price_line_pair(F.col("found"))
    tiers = text_nodes.tiers_json(text_nodes.quantity_tiers(F.col("texts")))
    return _result(
        rows.withColumn("found", found),
        name=F.col("title"),
        promotion_text=promotion,
        original_text=original,
        condition=promos.sentinel_null(tiers),
    )


# -- Big C ------------------------------------------------------------------
def _own_text(tree: HtmlTree, elements) -> str | None:
    """The first text that lies directly in one of the elements."""
    return next((t for e in elements for t in tree.own_texts(e)), None)


@gives(title=TEXT, sale=TEXT, base=TEXT, badge=TEXT)
def _card_bigc_pieces(tree: HtmlTree):
    def part(tag: str, name: str, card: Element):
        return tree.find_all(lambda e: e.tag == tag and name in e.class_name, card)

    for card in tree.find_all(_div("productCard_container")):
        titles = part("div", "productCard_title", card)
        badges = part("div", "productCard_badge", card)
        images = (i for b in badges for i in tree.find_all(_tag("img"), b) if "src" in i.attrs)
        yield {
            "title": _own_text(tree, (a for t in titles for a in tree.find_all(_tag("a"), t))),
            "sale": _own_text(tree, part("span", "productCard_sale_price", card)),
            "base": _own_text(tree, part("div", "productCard_base_price", card)),
            "badge": _attr(next(images, None), "src"),
        }


def extract_card_bigc(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _card_bigc_pieces)

    def shown(piece: str) -> Column:
        return F.coalesce(strip_ws(none_if_empty(F.col(piece))), F.lit(NO_TEXT))

    return _result(
        rows,
        name=shown("title"),
        promotion_text=shown("sale"),
        original_text=F.translate(shown("base"), "฿", ""),
        badge_url=F.coalesce(none_if_empty(F.col("badge")), F.lit(NO_BADGE)),
    )


@gives(page_ok=bigc_page_ok, title=TEXT, base=TEXT, price=TEXT, badge=TEXT)
def _detail_bigc_pieces(tree: HtmlTree):
    box = tree.find(_div("productDetail_product_price_new"))
    base = box and tree.find(_div("productDetail_product_baseprice"), box)

    def is_unit(e: Element) -> bool:
        removed = base is not None and base.start <= e.start < base.end
        return e.tag == "span" and "productDetail_unit" in e.class_name and not removed

    badge = tree.find(_div("imageSlider_badge_warpper"))
    yield {
        "title": tree.text(tree.find(_tag("h1"))),
        "base": tree.text(base),
        "price": tree.text(box, skip=(base, box and tree.find(is_unit, box))),
        "badge": badge and _attr(tree.find(_tag("img"), badge), "src"),
    }


def extract_detail_bigc(pages: DataFrame) -> DataFrame:
    """Product pages that loaded: challenge pages and pages without a title drop out."""
    rows = walk_pages(pages, _detail_bigc_pieces)
    return _result(
        rows.where(has_name(F.col("title"))),
        name=strip_ws(F.col("title")),
        promotion_price=prices.price_strip_currency(F.col("price")),
        original_price=prices.price_strip_currency(F.col("base")),
        badge_url=F.coalesce(F.col("badge"), F.lit(NO_BADGE)),
    )


@gives(title=TEXT, base=TEXT, price=TEXT, default=TEXT, badge=TEXT)
def _detail_bigc_by_id_pieces(tree: HtmlTree):
    wrapper = tree.find(lambda e: e.tag == "div" and e.attrs.get("id") == "pdp_product-price-new")
    base = wrapper and tree.find(lambda e: e.tag == "span" and e.attrs.get("id") == "pdp_price-base", wrapper)
    promo = wrapper and tree.find(_div("productDetail_product_price_new"), wrapper)
    badge = tree.find(_div("imageSlider_badge_top-right"))
    yield {
        "title": tree.packed(tree.find(_tag("h1"))),
        "base": tree.packed(base),
        "price": promo and next((t for t in tree.own_texts(promo) if t.strip()), None),
        "default": tree.packed(
            tree.find(lambda e: e.tag == "span" and "productDetail_product_price_default" in e.class_name)
        ),
        "badge": badge and _attr(tree.find(_tag("img"), badge), "src"),
    }


def extract_detail_bigc_by_id(pages: DataFrame) -> DataFrame:
    """Older page layout: prices by element id, a default price, relative badge addresses."""
    rows = walk_pages(pages, _detail_bigc_by_id_pieces)
    promotion = none_if_empty(strip_ws(F.translate("price", ",", "")))
    original = none_if_empty(F.translate("base", ",", ""))
    lone = F.when(promotion.isNull() & original.isNull(), F.translate("default", ",", ""))
    return _result(
        rows.where(has_name(F.col("title"))),
        name=F.col("title"),
        promotion_text=promotion,
        original_text=F.coalesce(original, lone),
        condition=urls.badge_url_absolute(none_if_empty(F.col("badge"))),
    )


@gives(badges=TEXTS)
def _badge_pieces(tree: HtmlTree):
    images = tree.find_all(lambda e: e.tag == "img" and e.attrs.get("alt") == "product badge")
    yield {"badges": [i.attrs["src"] for i in images if i.attrs.get("src")]}


def extract_badge_urls(pages: DataFrame) -> DataFrame:
    """Distinct badge image addresses of each page."""
    rows = walk_pages(pages, _badge_pieces)
    return rows.select("url", F.explode(F.array_distinct("badges")).alias("badge_url"))


# -- Lotus's ----------------------------------------------------------------
@gives(title=TEXT, promotion=TEXT, original=TEXT, offer=TEXT)
def _card_lotus_pieces(tree: HtmlTree):
    for card in tree.find_all(_classed("div", "MuiCard-root")):
        yield {
            "title": tree.text(tree.find(lambda e: e.has_class("mui-style-17swnep"), card)),
            "promotion": tree.text(tree.find(_classed("div", "mui-style-18s6ztp"), card)),
            "original": tree.text(tree.find(_classed("div", "mui-style-f59hd5"), card)),
            "offer": tree.text(tree.find(_classed("div", "mui-style-axryyp"), card), joint=" "),
        }


def extract_card_lotus(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _card_lotus_pieces)
    promotion = prices.strip_currency(F.col("promotion"))
    return _result(
        rows,
        name=strip_ws(F.col("title")),
        promotion_price=strict_double(promotion),
        original_price=strict_double(F.coalesce(prices.strip_currency(F.col("original")), promotion)),
        condition=strip_ws(F.regexp_replace("offer", r"(?U)\s+", " ")),
    ).where(F.col("name") != "")


@gives(title=TEXT, current=TEXT, crossed=TEXT, offer=TEXT)
def _detail_lotus_pieces(tree: HtmlTree):
    title = tree.find(_classed("h1", "mui-style-1wc9qn4")) or tree.find(_tag("h1"))
    yield {
        "title": tree.text(title),
        "current": tree.text(tree.find(_classed("div", "mui-style-kbur42"))),
        "crossed": tree.text(tree.find(_classed("div", "mui-style-1opqjiq"))),
        "offer": tree.text(tree.find(_classed("div", "mui-style-abwb4l")), joint=" "),
    }


def extract_detail_lotus(pages: DataFrame) -> DataFrame:
    """Product pages that loaded: consent banners and pages without a title drop out."""
    rows = walk_pages(pages, _detail_lotus_pieces)
    current = strip_ws(F.substring_index(F.translate("current", ",฿", ""), "/", 1))
    crossed = prices.strip_currency(F.col("crossed"))
    return _result(
        rows.where(lotus_name_ok(F.col("title"))),
        name=strip_ws(F.col("title")),
        promotion_price=F.when(crossed.isNotNull(), strict_double(current)),
        original_price=strict_double(F.coalesce(crossed, current)),
        condition=strip_ws(F.col("offer")),
    )


# -- Tops -------------------------------------------------------------------
def _price_spans(tree: HtmlTree, within: Element | None = None) -> list[str | None]:
    spans = tree.find_all(lambda e: e.tag == "span" and e.class_name == "hidden lg:inline", within)
    return [tree.packed(s) for s in spans]


@gives(title=TEXT, prices=TEXTS)
def _card_tops_pieces(tree: HtmlTree):
    for title in tree.find_all(_div("text-textblack")):
        box = title.parent
        while box is not None and not (
            box.tag == "div" and ("relative" in box.class_name or "item" in box.class_name)
        ):
            box = box.parent
        yield {"title": tree.packed(title), "prices": _price_spans(tree, box or title.parent)}


def _price_pair(found: str, read: Callable[[Column], Column]) -> tuple[Column, Column]:
    """Two shown prices are promotion and original; a single one is the original."""
    first = read(F.get(found, F.lit(0)))
    second = read(F.get(found, F.lit(1)))
    paired = F.size(found) >= 2
    return F.when(paired, first), F.when(paired, second).otherwise(first)


def extract_card_tops(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _card_tops_pieces)
    promotion, original = _price_pair("prices", lambda t: strict_double(F.translate(t, ",", "")))
    return _result(
        rows, name=F.col("title"), promotion_price=promotion, original_price=original
    )


@gives(title=TEXT, heading=TEXT, prices=TEXTS, offer=TEXT)
def _detail_tops_pieces(tree: HtmlTree):
    def is_offer(e: Element) -> bool:
        return e.tag == "div" and all(
            part in e.class_name for part in ("text-textsecondary", "text-sm", "mt-2")
        )

    yield {
        "title": tree.packed(tree.find(_tag("h1"))),
        "heading": tree.shown(tree.find(_tag("h1"))),
        "prices": _price_spans(tree),
        "offer": tree.packed(tree.find(is_offer)),
    }


def extract_detail_tops(pages: DataFrame) -> DataFrame:
    """Product pages that loaded: challenge pages and pages without a title drop out."""
    rows = walk_pages(pages, _detail_tops_pieces)
    promotion, original = _price_pair("prices", prices.price_drop_currency)
    return _result(
        rows.where(tops_name_ok(F.col("title"), F.col("heading"))),
        name=F.col("title"),
        promotion_price=promotion,
        original_price=original,
        condition=F.col("offer"),
    )


# -- GO Vietnam -------------------------------------------------------------
@gives(title=TEXT, sale=TEXT, original=TEXT, discount=TEXT)
def _card_go_pieces(tree: HtmlTree):
    for card in tree.find_all(lambda e: e.has_class("stick_camp_prod_item")):
        yield {
            "title": tree.shown(tree.find(_classed("p", "chakra-text", "css-138rv0j"), card)),
            "sale": tree.shown(tree.find(_classed("b", "chakra-text", "css-aqfyqq"), card)),
            "original": tree.shown(tree.find(_classed("del", "chakra-text", "css-nxr2hb"), card)),
            "discount": tree.shown(tree.find(_classed("span", "p-1"), card)),
        }


def extract_card_go(pages: DataFrame) -> DataFrame:
    rows = walk_pages(pages, _card_go_pieces)
    return _result(
        rows,
        product_name_vi=strip_ws(F.col("title")),
        sale_price=prices.price_integer_strip(F.col("sale")),
        original_price=prices.price_integer_strip(F.col("original")),
        discount_pct=strip_ws(F.col("discount")),
    ).where(F.col("product_name_vi") != "")
