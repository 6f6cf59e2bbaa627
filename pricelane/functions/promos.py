"""Promotion texts to labels and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelane.fixed_values import (
    NO_TIERS,
    PROMO_CHEAPER_WORD,
    PROMO_FLAG_WORDS,
    PROMO_GET_WORDS,
    PROMO_ONE_FOR_ONE,
    PROMO_SAVE_WORDS,
    PROMO_TYPOS,
)
from pricelane.functions.text import contains_any, first_group, none_if_empty, strip_ws


def promo_label(raw: Column) -> Column:
    """Standard label of a badge text; unknown texts stay as they are."""
    text = F.translate(F.upper(raw), " ", "")
    for typo, word in PROMO_TYPOS.items():
        text = F.replace(text, F.lit(typo), F.lit(word))
    count = first_group(text, r"(?U)\d", 0)
    one_for_one = (count == "1") | contains_any(text, PROMO_ONE_FOR_ONE)
    return (
        F.when(contains_any(text, PROMO_SAVE_WORDS), "Supersave")
        .when(
            contains_any(text, PROMO_GET_WORDS),
            F.when(count.isNull(), "Buy 1 Get")
            .when(one_for_one, "Buy 1 Get 1")
            .otherwise(F.concat(F.lit("Buy "), count, F.lit(" Get 1"))),
        )
        .when(
            text.contains(PROMO_CHEAPER_WORD),
            F.concat(F.lit("Buy "), F.coalesce(count, F.lit("2")), F.lit(" Cheaper")),
        )
        .otherwise(none_if_empty(strip_ws(raw)))
    )


def promo_flag(raw: Column) -> Column:
    return contains_any(F.upper(raw), PROMO_FLAG_WORDS)


def sentinel_null(text: Column, sentinel: str = NO_TIERS) -> Column:
    return F.nullif(text, F.lit(sentinel))
