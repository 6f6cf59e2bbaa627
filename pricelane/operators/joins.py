"""Lookups, watchlist merges and name searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(table: DataFrame, key: str, value: str) -> DataFrame:
    """A lookup table with each ``key`` once; of several values the smallest counts."""
    return table.groupBy(key).agg(F.min(value).alias(value))


def badge_map(df: DataFrame, labels: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Set ``condition`` to the label of ``badge_url``.

    ``labels`` has ``badge_url, label``; an address with several labels gets the
    smallest. Unknown addresses give null, or keep the address with
    ``keep_unknown``; a known address whose label is null gives null either way.
    A plain left join: adaptive execution splits the rows of a hot address.
    """
    known = once(labels, "badge_url", "label").withColumn("known", F.lit(True))
    found = df.drop("condition").join(known, "badge_url", "left")
    other = F.col("badge_url") if keep_unknown else F.lit(None).cast("string")
    return found.withColumn("condition", F.when(F.col("known"), F.col("label")).otherwise(other)).drop("label", "known")


def translate_lookup(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``product_name_en``; names without a translation stay as they are.

    ``dictionary`` has ``product_name_vi, translated``; a name with several
    translations gets the smallest.
    """
    found = df.join(once(dictionary, "product_name_vi", "translated"), "product_name_vi", "left")
    english = F.coalesce("translated", "product_name_vi")
    return found.withColumn("product_name_en", english).drop("translated")


def watchlist_merge(price_rows: DataFrame, condition_rows: DataFrame) -> DataFrame:
    """Price rows with the condition collected for the same address."""
    return price_rows.join(condition_rows.select("url", "condition"), "url", "left")


def found_flag(search: DataFrame, listing: DataFrame) -> DataFrame:
    """Each searched ``product_name`` with whether the listing has exactly that name."""
    names = _wanted_rows(listing.select(F.col("name").alias("product_name")), search)
    marked = names.withColumn("Found", F.lit(True))
    return search.join(marked, "product_name", "left").withColumn(
        "Found", F.coalesce("Found", F.lit(False))
    )


def _wanted_rows(offered: DataFrame, search: DataFrame) -> DataFrame:
    """Distinct ``offered`` rows whose ``product_name`` is searched."""
    return offered.distinct().join(search.select("product_name").distinct(), "product_name", "left_semi")


def search_join(search: DataFrame, listing: DataFrame) -> DataFrame:
    """Distinct price pairs of each searched name, or one empty row if it is absent.

    Pairs are made distinct by the whole row, which deals a placeholder name's pairs over all tasks. Each pair then
    meets its name at most once, in an inner join that adaptive execution may split at a hot name; with a semi join
    large runs gathered the name in one task. The listing is read once: the names that are
    absent come from the same shuffle of the distinct pairs.
    """
    offered = listing.select(
        F.col("name").alias("product_name"), "original_price", "promotion_price"
    ).where("product_name is not null").distinct()
    wanted = search.select("product_name").distinct()
    matched = offered.join(wanted, "product_name")
    # the count is asked for, as Spark would read the listing again for the bare names
    seen = offered.groupBy("product_name").agg(F.count("*").alias("n_pairs")).where("n_pairs > 0")
    absent = wanted.join(seen, "product_name", "left_anti")
    return matched.withColumn("Found", F.lit(True)).unionByName(
        absent.select(
            "product_name",
            F.lit(None).cast("double").alias("original_price"),
            F.lit(None).cast("double").alias("promotion_price"),
            F.lit(False).alias("Found"),
        )
    )
