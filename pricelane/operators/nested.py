"""Flattening of nested product feeds.

Feeds are read with a fixed schema: a field that a record lacks is null, and
no sample of the data decides which columns exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelane.fixed_values import FEED_PRICE_SCALE, FEED_PRICE_SCALE_VN
from pricelane.functions.prices import scaled_price

_MODEL = (
    "struct<item_id: bigint, model_id: bigint, name: string, name_tr: string, "
    "price: double, status: int, has_stock: boolean>"
)
_PRICE = "struct<single_value: double>"
FEED_SCHEMA = (
    "data struct<data: struct<"
    "item: struct<item_id: bigint, shop_id: bigint, title: string, title_tr: string, "
    "currency: string, price: double, price_before_discount: double, "
    f"item_rating: struct<rating_star: double>, models: array<{_MODEL}>>, "
    f"product_price: struct<price: {_PRICE}, price_before_discount: {_PRICE}>>>"
)
ITEM = "data.data.item"
PRICE = "data.data.product_price"


def json_items(df: DataFrame, text: str = "json") -> DataFrame:
    """Parse a column of feed records; unreadable records have a null ``data``.

    ``has_item`` tells whether the record's item object has any field at all, also
    one that the schema does not name. Amounts may be fractional.
    """
    fields = F.from_json(text, "data struct<data: struct<item: map<string, string>>>")
    return df.withColumns(
        {
            "record": F.from_json(text, FEED_SCHEMA),
            "has_item": F.coalesce(F.size(fields["data"]["data"]["item"]) > 0, F.lit(False)),
        }
    ).select("*", "record.data").drop("record", text)


def json_nonempty(items: DataFrame) -> DataFrame:
    """Records that carry an item with at least one field, whatever its name."""
    return items.where("has_item")


def json_flatten(items: DataFrame) -> DataFrame:
    """One flat row per record, prices in whole currency."""
    return items.select(
        F.col(f"{ITEM}.item_id").alias("item_id"),
        F.col(f"{ITEM}.shop_id").alias("shop_id"),
        F.col(f"{ITEM}.title").alias("title"),
        scaled_price(F.col(f"{ITEM}.price"), FEED_PRICE_SCALE).alias("price"),
        scaled_price(F.col(f"{ITEM}.price_before_discount"), FEED_PRICE_SCALE).alias(
            "price_before_discount"
        ),
    )


def json_optional_field(items: DataFrame) -> DataFrame:
    """One flat row per record of the feed whose prices may be absent."""
    def amount(field: str) -> Column:
        value = F.col(f"{PRICE}.{field}.single_value")
        return scaled_price(value, FEED_PRICE_SCALE_VN).alias(field)

    return items.select(
        *(F.col(f"{ITEM}.{f}").alias(f) for f in ("item_id", "shop_id", "title", "title_tr", "currency")),
        F.col(f"{ITEM}.item_rating.rating_star").alias("rating_star"),
        amount("price"),
        amount("price_before_discount"),
    )


def json_explode_models(items: DataFrame) -> DataFrame:
    """One row per selling option; an option without a price costs 0."""
    models = items.select(F.explode(f"{ITEM}.models").alias("model"))
    return models.select(
        "model.item_id",
        "model.model_id",
        "model.name",
        "model.name_tr",
        scaled_price(F.coalesce("model.price", F.lit(0)), FEED_PRICE_SCALE).alias("price"),
        "model.status",
        "model.has_stock",
    )
