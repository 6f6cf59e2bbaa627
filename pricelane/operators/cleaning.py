"""Price and name standardisation of listing rows."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelane.fixed_values import LISTING_COLUMNS, NAME_PROFILES, PRICE_COLUMNS, RETAILERS
from pricelane.functions import names, prices
from pricelane.functions.text import strict_double

PROMOTION, ORIGINAL = "promotion_price", "original_price"

# How each shop's price texts become numbers.
PRICE_READERS = {
    "7e": prices.price_from_text,
    "makro": strict_double,
    "bigc": strict_double,
    "lotus": prices.price_strip_currency,
    "tops": prices.price_drop_currency,
}


def read_prices(df: DataFrame, profile: str) -> DataFrame:
    """Turn ``promotion_text`` and ``original_text`` into the two price columns."""
    read = PRICE_READERS[profile]
    return df.withColumns(
        {PROMOTION: read(F.col("promotion_text")), ORIGINAL: read(F.col("original_text"))}
    ).drop("promotion_text", "original_text")


def reevaluate_price(df: DataFrame) -> DataFrame:
    """Fill a missing original price, then drop a promotion price equal to it."""
    promotion, original = prices.filled_prices(F.col(PROMOTION), F.col(ORIGINAL))
    return df.withColumns({PROMOTION: promotion, ORIGINAL: original})


def reevaluate_price_swap(df: DataFrame) -> DataFrame:
    """Put the higher price in the original column, then drop an equal promotion price."""
    promotion, original = prices.ordered_prices(F.col(PROMOTION), F.col(ORIGINAL))
    return df.withColumns({PROMOTION: promotion, ORIGINAL: original})


def nullify_fake_original(df: DataFrame) -> DataFrame:
    return df.withColumn(ORIGINAL, prices.real_original(F.col(PROMOTION), F.col(ORIGINAL)))


def with_discount_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("discount_pct", prices.discount_pct(F.col(PROMOTION), F.col(ORIGINAL)))


def consistent_schema(df: DataFrame) -> DataFrame:
    """The four price columns with fixed types; unreadable numbers become null."""
    kinds = dict(df.dtypes)

    def number(column: str) -> Column:
        value = F.col(column)
        return strict_double(value) if kinds[column] == "string" else value.try_cast("double")

    return df.select(
        F.col("name").cast("string").alias("name"),
        number(PROMOTION).alias(PROMOTION),
        number(ORIGINAL).alias(ORIGINAL),
        F.col("condition").cast("string").alias("condition"),
    )


def select_canonical(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename to the four price columns, in order, and drop the rest."""
    return df.withColumnsRenamed(renames or {}).select(*PRICE_COLUMNS)


def parse_names(
    df: DataFrame, profile: str, run_date: datetime.date, keep: Sequence[str] = ()
) -> DataFrame:
    """Add the run date, brand, volume, unit, pack size and retailer.

    The 7-Eleven profile reads brands from its list and empties ``condition``.
    Columns named in ``keep`` stay, before the others.
    """
    name = F.col("name")
    seven = profile == "7e"
    parsed = df.withColumns(
        {
            "Date": F.lit(run_date),
            "Brand": names.brand_dictionary(name) if seven else names.brand_first_word(name),
            "Volume": names.volume(name, profile),
            "Unit": names.unit(name, profile),
            "Pack": names.pack(name, profile),
            "Retailer": F.lit(RETAILERS[profile]),
        }
    )
    if seven:
        parsed = parsed.withColumn("condition", F.lit(None).cast("string"))
    return parsed.select(*keep, *LISTING_COLUMNS)


def parse_names_go(df: DataFrame, name: str = "product_name_en") -> DataFrame:
    """Add volume, unit and product id to GO names."""
    return df.withColumns(
        {
            "Volume": names.volume(F.col(name), "go"),
            "Unit": names.unit(F.col(name), "go"),
            "product_id": names.go_product_id(F.col(name)),
        }
    )


def standardize(
    df: DataFrame, profile: str, run_date: datetime.date, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed price rows to standard listing rows, by the shop's rules; ``keep`` columns come first.

    Tops shows its prices in either order, so they are put in order; the other
    shops only fill. 7-Eleven and Tops tables hold each row once.
    """
    if profile not in NAME_PROFILES or profile not in RETAILERS:
        raise ValueError(f"unknown shop profile: {profile}")
    priced = reevaluate_price_swap(df) if profile == "tops" else reevaluate_price(df)
    rows = priced.select(*keep, *PRICE_COLUMNS)
    if profile in ("7e", "tops"):
        rows = rows.distinct()
    return parse_names(rows, profile, run_date, keep)
