"""One walk over the pages of all shops.

A page table holds pages of all shops and kinds. ``walk_all`` reads it once: each page goes to the rule of its
``retailer`` and ``page_kind``, and comes out as tagged rows. Every page gives exactly one row with its state and the number of
its pieces, and one row for each piece; so pages in are pages with products, pages without, and rejects with
their reason, all from the same pass. ``stored_walk`` writes the rows once, by shop, kind and state; runs and
reject counts then read only their part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelane.session import spread_small, stored
from pricelane.sources import shop_pages
from pricelane.sources.shop_pages import PIECE, WalkedPages, found_in

#: The rule of each shop and kind of page.
RULES = {
    ("7e", "category"): shop_pages._card_7e_pieces,
    ("7e", "product"): shop_pages._detail_7e_pieces,
    ("makro", "category"): shop_pages._card_makro_pieces,
    ("makro", "product"): shop_pages._product_makro_pieces,
    ("bigc", "category"): shop_pages._card_bigc_pieces,
    ("bigc", "product"): shop_pages._detail_bigc_pieces,
    ("lotus", "category"): shop_pages._card_lotus_pieces,
    ("lotus", "product"): shop_pages._detail_lotus_pieces,
    ("tops", "category"): shop_pages._card_tops_pieces,
    ("tops", "product"): shop_pages._detail_tops_pieces,
    ("go", "category"): shop_pages._card_go_pieces,
}
PRODUCTS, NO_PRODUCTS = "products", "no products"
NO_MARKUP, REFUSED, OTHER_PAGE, NO_RULE = "no markup", "refused markup", "not the page asked for", "no rule"
#: States of pages that nothing could be read from.
REJECTS = (NO_MARKUP, REFUSED, OTHER_PAGE, NO_RULE)

PLACE = {"retailer": "string", "page_kind": "string", "url_no": "int", "url": "string", "page_no": "int"}
TAGS = {"state": "string", "detail": "string", "n_found": "int", "pos": "int"}
FIELDS = {name: kind for rule in RULES.values() for name, kind in rule.fields.items()}
if any(FIELDS[name] != kind for rule in RULES.values() for name, kind in rule.fields.items()):
    raise TypeError("rules give one field in two kinds")


def walk_all(pages: DataFrame) -> DataFrame:
    """Tagged rows of ``retailer, page_kind, url_no, url, page_no, html``; the markup is read once."""
    kinds = PLACE | TAGS | FIELDS
    schema = pa.schema([(name, shop_pages._ARROW[kind]) for name, kind in kinds.items()])
    rules = RULES

    def tagged(page: dict, html: str | None, asked: bool) -> Iterator[dict]:
        rule = rules.get((page["retailer"], page["page_kind"]))
        found, error = [], None
        if rule is None:
            state = NO_RULE
        elif html is None:
            state = NO_MARKUP
        elif not asked:
            state = OTHER_PAGE
        else:
            found, error = found_in(html, rule)
            state = REFUSED if error else PRODUCTS if found else NO_PRODUCTS
        yield page | {"state": state, "detail": error, "n_found": len(found)}
        yield from (page | {"state": PIECE, "pos": pos} | piece for pos, piece in enumerate(found))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        read = 0
        for batch in batches:
            for page in batch.to_pylist():
                html, asked = page.pop("html"), page.pop("asked")
                rows += tagged(page, html, asked)
                read += len(html or "")
                if len(rows) >= shop_pages._ROWS_PER_BATCH or read >= shop_pages._CHARS_PER_BATCH:
                    yield shop_pages.batch_of(rows, schema)
                    rows, read = [], 0
        if rows:
            yield shop_pages.batch_of(rows, schema)

    asked = F.lit(True)
    for (retailer, kind), rule in RULES.items():
        if rule.page_ok is not None:
            own = (F.col("retailer") == retailer) & (F.col("page_kind") == kind)
            asked = F.when(own, rule.page_ok(F.col("html"))).otherwise(asked)
    wanted = pages.select(*(F.col(n).cast(k).alias(n) for n, k in PLACE.items()), F.coalesce(asked, F.lit(True)).alias("asked"), "html")
    return spread_small(wanted, "url", "page_no").mapInArrow(walk, ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


def stored_walk(pages: DataFrame) -> DataFrame:
    """The tagged rows, written once by shop, kind and state, and read by these."""
    return stored(walk_all(pages), "page-walk", "retailer", "page_kind", "state")


def of(walked: DataFrame, retailer: str, page_kind: str) -> WalkedPages:
    """What the extractions take in place of one shop's pages."""
    return WalkedPages(walked, retailer, page_kind)


def page_states(walked: DataFrame) -> DataFrame:
    """``retailer, page_kind, url_no, url, page_no, state, detail, n_found``: one row for each page read."""
    return walked.where(F.col("state") != PIECE).select(*PLACE, "state", "detail", "n_found")


def rejects(walked: DataFrame) -> DataFrame:
    """Pages that nothing could be read from, with the reason and the name of the error, if there was one."""
    bad = walked.where(F.col("state").isin(*REJECTS))
    return bad.select(*PLACE, F.col("state").alias("reason"), "detail")


def state_counts(walked: DataFrame) -> DataFrame:
    """Pages and pieces by shop, kind and state."""
    return page_states(walked).groupBy("retailer", "page_kind", "state").agg(
        F.count("*").alias("n_pages"), F.sum("n_found").alias("n_found")
    )
