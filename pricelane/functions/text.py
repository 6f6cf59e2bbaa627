"""Text helpers shared by all column rules.

Patterns carry ``(?U)`` so that digits, spaces and word boundaries are the
Unicode ones: shop names mix Thai and Latin text and use no-break spaces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number, nothing around it.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


# All Unicode white space, the no-break kinds included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_ws(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Regex group of the first match, null when nothing matches."""
    return none_if_empty(F.regexp_extract(text, pattern, group))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def has_digit(text: Column) -> Column:
    return text.rlike(r"(?U)\d")


def strict_double(text: Column) -> Column:
    """Plain numbers become doubles; anything else, padded text included, null."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def strict_long(text: Column) -> Column:
    """Whole numbers become longs; fractional or other text becomes null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))
