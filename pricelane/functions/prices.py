"""Price text to numbers, and the rules between the two price columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelane.functions.text import none_if_empty, strict_double, strip_ws


def price_from_text(text: Column) -> Column:
    """Keep digits and dots only, then read a number ("฿ 1,290.00" is 1290.0)."""
    return F.regexp_replace(text, r"(?U)[^\d.]", "").try_cast("double")


def strip_currency(text: Column) -> Column:
    """Text without baht signs, thousands commas and outer white space; empty is null."""
    return none_if_empty(strip_ws(F.translate(text, "฿,", "")))


def price_strip_currency(text: Column) -> Column:
    return strict_double(strip_currency(text))


def price_drop_currency(text: Column) -> Column:
    """Like ``price_strip_currency``, but text with outer white space is no price."""
    return strict_double(F.translate(text, "฿,", ""))


def price_integer_strip(text: Column) -> Column:
    """Dong amounts: no decimals, dots and commas both group thousands."""
    return strip_ws(F.translate(text, "đ,.", "")).try_cast("bigint")


def scaled_price(amount: Column, scale: float) -> Column:
    return amount / F.lit(scale)


def filled_prices(promotion: Column, original: Column) -> tuple[Column, Column]:
    """A lone promotion price becomes the original; an equal promotion is dropped."""
    filled = F.coalesce(original, promotion)
    return F.nullif(promotion, filled), filled


def ordered_prices(promotion: Column, original: Column) -> tuple[Column, Column]:
    """The higher price is the original, the lower the promotion, if they differ."""
    high = F.greatest(original, promotion)
    low = F.least(original, promotion)
    return F.nullif(low, high), high


def real_original(promotion: Column, original: Column) -> Column:
    """An original price equal to the promotion price is no original price."""
    return F.nullif(original, promotion)


def discount_pct(promotion: Column, original: Column) -> Column:
    """Percent off, one decimal; null without an original price (or with a zero one)."""
    return F.round(F.try_divide(original - promotion, original) * 100, 1)
