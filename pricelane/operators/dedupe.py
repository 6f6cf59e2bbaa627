"""Duplicates, first-seen rows and repeated result pages.

Groups here can be very uneven (a placeholder name may hold a third of all
rows), so nothing gathers a group: every step aggregates before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def dedupe_first(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = ("name",)
) -> DataFrame:
    """The first row of each key by ``order`` (which must be unique within a key).

    ``min_by`` keeps one row per key and task before the shuffle, so a hot key
    costs no more than any other. Null keys form one group; a null order value
    comes first.
    """
    if list(df.columns) == list(keys):
        return df.distinct()
    first = F.min_by(F.struct(*df.columns), F.struct(*order))  # a struct is never null
    return df.groupBy(*keys).agg(first.alias("row")).select("row.*")


def seen_anti(df: DataFrame, seen: DataFrame, key: str = "name") -> DataFrame:
    """Rows whose key is not in the ``seen`` table (rows without a key stay)."""
    return df.join(seen.select(key), key, "left_anti").select(*df.columns)


def new_items_per_page(
    rows: DataFrame, order: Sequence[str], catalogue: Sequence[str] = ("url",)
) -> DataFrame:
    """How many names each page shows first in its catalogue; pages without any show 0.

    Catalogues are told apart by ``catalogue``. With none, a name counts once over all.
    """
    page = [*catalogue, "page_no"]
    columns = dict.fromkeys([*page, "name", *order])
    firsts = dedupe_first(rows.select(*columns), order, keys=(*catalogue, "name"))
    fresh = firsts.groupBy(*page).agg(F.count("*").alias("new_items"))
    return (
        rows.select(*page)
        .distinct()
        .join(fresh, page, "left")
        .select(*page, F.coalesce("new_items", F.lit(0)).alias("new_items"))
    )


def drop_repeated_pages(rows: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Rows before the end of each catalogue: its first repeated or empty page.

    ``rows`` has ``url, page_no, pos, name``. A shop that answers past its
    last page with that page again ends the catalogue there. Pages compare as
    (position, name) pairs: a fingerprint per page finds candidates, and only
    those are compared name by name, so equal fingerprints never decide alone.
    ``pages`` has ``url, page_no`` of all collected pages; one without rows is
    empty and ends its catalogue as well. Reads ``rows`` several times: pass a
    stored table, not an extraction.
    """
    page = ["url", "page_no"]
    prints = rows.groupBy(*page).agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("pos", "name")).alias("mark"),
    )
    earlier = prints.select("url", (F.col("page_no") + 1).alias("page_no"), "size", "mark")
    same_print = prints.join(earlier, [*page, "size", "mark"]).select(*page, "size")
    candidates = same_print

    shown = rows.select(*page, "pos", "name")
    shifted = shown.withColumn("page_no", F.col("page_no") + 1)
    both = shown.join(candidates, page).join(
        shifted.join(candidates.select(*page), page, "left_semi").withColumnRenamed("name", "before"),
        [*page, "pos"],
    )
    agreed = F.count_if(F.col("name").eqNullSafe(F.col("before")))
    ends = both.groupBy(*page, "size").agg(agreed.alias("agreed")).where("agreed = size").select(*page)
    if pages is not None:
        ends = ends.unionByName(pages.select(*page).join(prints.select(*page), page, "left_anti"))
    first_end = ends.groupBy("url").agg(F.min("page_no").alias("end_page"))
    return (
        rows.join(first_end, "url", "left")
        .where(F.col("end_page").isNull() | (F.col("page_no") < F.col("end_page")))
        .select(*rows.columns)
    )


def catalogue_ends(pages: DataFrame) -> DataFrame:
    """``url, end_page``: the first empty page of each catalogue, or the first that repeats the page before.

    ``pages`` has ``url, page_no, mark, names``, one row for each page. Each page also meets the next page number, so the
    pages are read once; names are compared where the marks agree. Two rows of one page at most meet in a group.
    """
    page = F.struct("mark", "names")
    nothing = F.lit(None).cast(pages.select(page).schema[0].dataType)
    own = F.struct("page_no", page.alias("own"), nothing.alias("before"))
    following = F.struct((F.col("page_no") + 1).alias("page_no"), nothing.alias("own"), page.alias("before"))
    numbered = pages.where("url is not null and page_no is not null")
    placed = numbered.select("url", F.inline(F.array(own, following)))
    both = placed.groupBy("url", "page_no").agg(F.max("own").alias("own"), F.max("before").alias("before"))
    same = (F.col("own.mark") == F.col("before.mark")) & (F.col("own.names") == F.col("before.names"))
    ends = both.where(F.col("own").isNotNull() & ((F.size("own.names") == 0) | F.coalesce(same, F.lit(False))))
    return ends.groupBy("url").agg(F.min("page_no").alias("end_page"))


def before_end(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows of pages before the end of their catalogue."""
    return (
        rows.join(ends, "url", "left")
        .where(F.col("end_page").isNull() | F.col("page_no").isNull() | (F.col("page_no") < F.col("end_page")))
        .select(*rows.columns)
    )
