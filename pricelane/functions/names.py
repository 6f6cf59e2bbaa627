"""Brand, volume, unit, pack size and product id out of a product name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelane.fixed_values import GO_PRODUCT_ID, NAME_PROFILES, THAI_BRANDS, NameProfile
from pricelane.functions.text import first_group


# Every pack notation starts with one of these; checking that first saves trying
# all notations at every place of the name.
_PACK_START = r"(?=[PTX\d(แ])"


def _quantity(name: Column, rules: NameProfile) -> Column:
    """The first number with its unit. Volume and unit both read this one match."""
    end = r"\b" if rules.word_end else ""
    return first_group(name, rf"(?iU)({rules.number})\s*({rules.units}){end}", 0)


def brand_first_word(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def brand_dictionary(name: Column) -> Column:
    """A known brand the name starts with, else its first word."""
    known = first_group(name, "^(" + "|".join(THAI_BRANDS) + ")")
    return F.coalesce(known, brand_first_word(name))


def volume(name: Column, profile: str) -> Column:
    """The first number directly before a unit.

    Shops with whole volumes get null for fractional text ("1.8 kg").
    """
    rules = NAME_PROFILES[profile]
    digits = F.regexp_extract(_quantity(name, rules), "(?U)^" + rules.number, 0)
    if "," in rules.number:
        digits = F.translate(digits, ",", "")
    if rules.whole_volume:
        return F.when(~digits.contains("."), digits.try_cast("bigint")).cast("double")
    return digits.try_cast("double")


def unit(name: Column, profile: str) -> Column:
    rules = NAME_PROFILES[profile]
    found = F.regexp_replace(_quantity(name, rules), r"(?U)^[\d.,]+\s*", "")
    if rules.unit_case == "upper":
        return F.upper(found)
    if rules.unit_case == "lower":
        return F.lower(found)
    return found


def pack(name: Column, profile: str) -> Column:
    forms = NAME_PROFILES[profile].pack_forms
    return F.upper(first_group(name, "(?iU)" + _PACK_START + "(" + "|".join(forms) + ")"))


def go_product_id(name: Column) -> Column:
    return first_group(name, "(?U)" + GO_PRODUCT_ID)
