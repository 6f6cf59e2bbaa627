"""Rules over the text nodes of a page or card, held as ``array<string>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelane.fixed_values import (
    NOT_A_PRICE_WORDS,
    NO_TIERS,
    PRICE_LINE_WINDOW,
    PRICE_RANGE,
    TIER_WINDOW,
)
from pricelane.functions.text import bind, contains_any, has_digit, strip_ws


def _first(texts: Column, keep) -> Column:
    return F.get(F.filter(texts, keep), F.lit(0))


def _first_position(texts: Column, keep) -> Column:
    """1-based place of the first text that fits, null when none does."""
    place = F.array_position(F.transform(texts, keep), F.lit(True))
    return bind(place, lambda p: F.when(p > 0, p))


def _after(texts: Column, anchor: Column, count: int) -> Column:
    return F.slice(texts, (anchor + 1).cast("int"), count)


def _names_units(text: Column) -> Column:
    return F.lower(text).contains("unit") & has_digit(text)


def _bare(text: Column) -> Column:
    """Text without baht signs, thousands commas and outer white space."""
    return strip_ws(F.translate(text, "฿,", ""))


def _number(text: Column) -> Column:
    """A number the way a lenient reader takes it: "_" may group digits, Thai digits count."""
    plain = r"(?U)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\z"
    latin = F.translate(text, "๐๑๒๓๔๕๖๗๘๙_", "0123456789")
    return F.when(text.rlike(plain), latin.try_cast("double"))


def texts_name(texts: Column, longer_than: int = 10) -> Column:
    """The first text of more than ``longer_than`` characters that is no price, points or delivery note."""
    return _first(
        texts,
        lambda t: (F.length(t) > longer_than)
        & ~t.contains("฿")
        & ~F.lower(t).contains("points")
        & ~t.contains("Today"),
    )


def texts_prices(texts: Column, between: tuple[float, float] = PRICE_RANGE) -> Column:
    """All numbers inside the open range ``between``, in page order."""
    low, high = between
    candidates = F.filter(
        texts, lambda t: has_digit(t) & ~contains_any(F.lower(t), NOT_A_PRICE_WORDS)
    )
    numbers = F.transform(candidates, lambda t: bind(_bare(t), _number))
    return F.filter(numbers, lambda v: (v > low) & (v < high))


def texts_condition(texts: Column, tagged: Column) -> Column:
    """The tagged offer text, else the first text that counts units."""
    return F.coalesce(tagged, _first(texts, _names_units))


def price_lines(lines: Column, name: Column, window_lines: int = PRICE_LINE_WINDOW) -> Column:
    """Number lines among ``window_lines`` after the product code, else after the name's last line."""
    coded = _first_position(lines, lambda t: t.contains("Code :") | t.contains("Code:"))
    named = F.array_max(
        F.transform(lines, lambda t, i: F.when((name != "") & t.contains(name), i + 1))
    )
    window = _after(lines, F.coalesce(coded, named.cast("bigint")), window_lines)
    return F.filter(F.transform(window, _bare), lambda t: t.rlike(r"(?U)^\d+(\.\d+)?\z"))


def price_line_pair(found: Column) -> tuple[Column, Column]:
    """(promotion, original) of found price lines: a single line counts twice."""
    first = F.get(found, F.lit(0))
    return first, F.coalesce(F.get(found, F.lit(1)), first)


def quantity_tiers(texts: Column, window_texts: int = TIER_WINDOW) -> Column:
    """Unit label -> price text from the "buy more, save more" block, as a map.

    The block is the ``window_texts`` texts after its heading.

    Labels and prices pair up in order; a repeated label keeps its last price
    and its first place.
    """
    anchor = _first_position(
        texts, lambda t: F.lower(t).contains("buy more") & F.lower(t).contains("save more")
    )
    block = _after(texts, anchor, window_texts)
    return bind(block, lambda b: bind(_tier_pairs(b), _tier_map))


def _tier_pairs(block: Column) -> Column:
    labels = F.filter(block, _names_units)
    split_sign = F.transform(block, lambda t, i: F.when(
        t.contains("฿") & ~_names_units(t),
        F.when((t == "฿") & (i + 1 < F.size(block)), F.concat(F.lit("฿ "), F.get(block, i + 1)))
        .otherwise(t),
    ))
    amounts = F.filter(split_sign, lambda t: t.isNotNull())
    return F.filter(
        F.arrays_zip(labels.alias("label"), amounts.alias("amount")),
        lambda p: p["label"].isNotNull() & p["amount"].isNotNull(),
    )


def _tier_map(pairs: Column) -> Column:
    def last_amount(label: Column) -> Column:
        return F.element_at(F.filter(pairs, lambda p: p["label"] == label), -1)["amount"]

    kept = F.array_distinct(F.transform(pairs, lambda p: p["label"]))
    return bind(kept, lambda k: F.map_from_arrays(k, F.transform(k, last_amount)))


def tiers_json(tiers: Column) -> Column:
    """The tier map as JSON text with ", " and ": " separators; no tiers gives "{}"."""
    def quoted(text: Column) -> Column:
        listed = F.to_json(F.array(text))
        return bind(listed, lambda t: F.substring(t, F.lit(2), F.length(t) - 2))

    members = F.transform(
        F.map_entries(tiers),
        lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])),
    )
    inner = F.coalesce(F.array_join(members, ", "), F.lit(""))
    empty = NO_TIERS
    return F.concat(F.lit(empty[0]), inner, F.lit(empty[1]))
