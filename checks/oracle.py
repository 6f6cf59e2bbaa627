"""SQL text shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from checks.inputs import LISTING_SQL, RUN_DATE, SIGHTINGS_SQL
from pricelane.fixed_values import NAME_PROFILES, RETAILERS, THAI_BRANDS

# Dates are compared as text.
DATE = f"'{RUN_DATE.isoformat()}'"
CARD = (
    "0 as url_no, 'https://shop.example/c' as url, cast(seq//50 as integer) as page_no, "
    "cast(seq%50 as integer) as pos"
)
PRODUCT = (
    "cast(seq as integer) as url_no, 'https://shop.example/p/'||seq as url, 1 as page_no, "
    "0 as pos"
)


def on_listing(select: str, **ctes: str) -> str:
    """A query with the ``listing`` view, and further views, in front."""
    views = [f"listing as ({LISTING_SQL})"] + [f"{n} as ({q})" for n, q in ctes.items()]
    return "with " + ", ".join(views) + " " + select


def num(x: str) -> str:
    plain = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"(case when regexp_matches({x}, '{plain}') then try_cast({x} as double) end)"


def digits_price(x: str) -> str:
    return f"try_cast(regexp_replace({x}, '[^0-9.]', '', 'g') as double)"


def strip_currency(x: str) -> str:
    return f"nullif(trim(replace(replace({x}, '฿', ''), ',', '')), '')"


def strip_price(x: str) -> str:
    return num(strip_currency(x))


def group(x: str, pattern: str, index: int) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {index}), '')"


def _quantity(profile: str) -> str:
    rules = NAME_PROFILES[profile]
    return rf"(?i)({rules.number})\s*({rules.units})" + (r"\b" if rules.word_end else "")


def volume(profile: str, name: str = "name") -> str:
    digits = f"replace({group(name, _quantity(profile), 1)}, ',', '')"
    if NAME_PROFILES[profile].whole_volume:
        digits = f"(case when regexp_matches({digits}, '^[0-9]+$') then {digits} end)"
    return f"try_cast({digits} as double)"


def unit(profile: str, name: str = "name") -> str:
    found = group(name, _quantity(profile), 2)
    return {"upper": f"upper({found})", "lower": f"lower({found})"}.get(
        NAME_PROFILES[profile].unit_case, found
    )


def pack(profile: str) -> str:
    return f"upper({group('name', '(?i)(' + '|'.join(NAME_PROFILES[profile].pack_forms) + ')', 1)})"


def brand(profile: str) -> str:
    first = "string_split(name, ' ')[1]"
    if profile != "7e":
        return first
    return f"coalesce({group('name', '^(' + '|'.join(THAI_BRANDS) + ')', 1)}, {first})"


def filled(source: str, rest: str = "name, condition") -> str:
    return (
        f"select {rest}, nullif(promotion_price, coalesce(original_price, promotion_price)) as "
        "promotion_price, coalesce(original_price, promotion_price) as original_price "
        f"from ({source})"
    )


def ordered(source: str, rest: str = "name, condition") -> str:
    return (
        f"select {rest}, nullif(least(original_price, promotion_price), "
        "greatest(original_price, promotion_price)) as promotion_price, "
        f"greatest(original_price, promotion_price) as original_price from ({source})"
    )


def parsed(source: str, profile: str, keep: str = "") -> str:
    condition = "cast(null as varchar)" if profile == "7e" else "condition"
    retailer = RETAILERS[profile].replace("'", "''")
    return (
        f"select {keep + ', ' if keep else ''}name, promotion_price, original_price, {condition} as condition, "
        f"{DATE} as \"Date\", {brand(profile)} as \"Brand\", {volume(profile)} as \"Volume\", "
        f"{unit(profile)} as \"Unit\", {pack(profile)} as \"Pack\", "
        f"'{retailer}' as \"Retailer\" from ({source})"
    )


def standard(source: str, profile: str, keep: str = "") -> str:
    priced = (ordered if profile == "tops" else filled)(source, "name, condition" + (f", {keep}" if keep else ""))
    if profile in ("7e", "tops"):
        priced = f"select distinct name, promotion_price, original_price, condition from ({priced})"
    return parsed(priced, profile, keep)


def first_of(source: str, key: str, order: str) -> str:
    return (
        f"select * from ({source}) qualify row_number() over (partition by {key} order by {order}) = 1"
    )


def searched(search: str, offered: str) -> str:
    """Left join on the name, flag, whole rows once."""
    return (
        "select distinct s.product_name, o.original_price, o.promotion_price, "
        "o.name is not null as \"Found\" "
        f"from ({search}) s left join ({offered}) o on s.product_name = o.name"
    )


def search_list(name: str = "family_name") -> str:
    return (
        f"select {name} as product_name from listing "
        "union all select 'No such item '||seq from listing"
    )


PRICE_ROWS = (
    f"select seq, name, family_name, {digits_price('promotion_text')} as promotion_price, "
    f"{digits_price('original_text')} as original_price, "
    "case when badge_text <> '  ' then badge_text end as condition from listing"
)
FAMILY_ROWS = (
    f"select seq, family_name as name, {digits_price('promotion_text')} as promotion_price, "
    f"{digits_price('original_text')} as original_price, "
    "case when badge_text <> '  ' then badge_text end as condition from listing"
)

SIGHTING_PRICES = (
    f"select order_no, line_no, supplier, name, {digits_price('promotion_text')} as promotion_price, "
    f"{digits_price('original_text')} as original_price, condition from ({SIGHTINGS_SQL})"
)

LABEL = (
    "case when t like '%SAVE%' or t like '%ประหยัด%' then 'Supersave' "
    "when t like '%GET%' or t like '%แถม%' then case when n = '' then 'Buy 1 Get' "
    "when n = '1' or t like '%1แถม1%' or t like '%1GET1%' then 'Buy 1 Get 1' "
    "else 'Buy '||n||' Get 1' end "
    "when t like '%CHEAPER%' then 'Buy '||(case when n = '' then '2' else n end)||' Cheaper' "
    "else nullif(trim(badge_text), '') end"
)
LABELLED = (
    f"select *, {LABEL} as label from (select *, regexp_extract(t, '[0-9]') as n from "
    "(select *, replace(replace(upper(badge_text), ' ', ''), 'BUV', 'BUY') as t from listing))"
)
# Labels of badge addresses /b/0 .. /b/6; the same texts in the same places for all rows.
BADGE_LABELS = (
    f"select distinct '/b/'||(seq%9) as badge_url, label from ({LABELLED}) where seq%9 < 7"
)

# -- extraction, seen from the listing ------------------------------------------
_P, _O = "promotion_text", "original_text"
CARD_7E = (
    f"select {CARD}, name, {_P}, {_O}, case when seq%4=0 then 'BUY1GET1' end as condition "
    "from listing"
)
DETAIL_7E = (
    f"select {PRODUCT}, name, {_P}, {_O}, "
    "case seq%3 when 1 then '1GET1' when 2 then '2GET1' end as condition from listing"
)


def _ranged(x: str) -> str:
    value = strip_price(x)
    return f"(case when {value} > 5 and {value} < 10000 then {value} end)"


def card_makro(name: str = "name") -> str:
    return (
        f"select {CARD}, {name} as name, least({_ranged(_P)}, {_ranged(_O)}) as promotion_price, "
        f"greatest({_ranged(_P)}, {_ranged(_O)}) as original_price, "
        "case seq%3 when 0 then 'Buy2more' when 1 then '2+ Units each' end as condition "
        f"from listing where coalesce({_ranged(_P)}, {_ranged(_O)}) is not null"
    )


def _line(x: str) -> str:
    text = strip_currency(x)
    return f"(case when regexp_matches({text}, '^[0-9]+(\\.[0-9]+)?$') then {text} end)"


PRICE_MAKRO = (
    f"select {PRODUCT}, name, coalesce({_line(_P)}, {_line(_O)}) as promotion_text, "
    f"coalesce(case when {_line(_P)} is not null then {_line(_O)} end, {_line(_P)}, {_line(_O)}) "
    "as original_text from listing"
)
TIERS_MAKRO = (
    f"select {PRODUCT}, name, case when seq%4=0 then null "
    "when seq%4=1 then '{\"1 - 1 units\": \"฿ '||seq||'b\"}' "
    "else '{\"1 - 1 units\": \"฿ '||seq||'a\", \"2+ units\": \"฿ '||seq||'b\"}' end as condition "
    "from listing"
)
CARD_BIGC = (
    f"select {CARD}, name, coalesce(trim(replace({_P}, '฿', '')), 'N/A') as promotion_text, "
    f"coalesce(replace({_O}, '฿', ''), 'N/A') as original_text, "
    "case when seq%10=9 then 'null' else '/b/'||(seq%9) end as badge_url from listing"
)
DETAIL_BIGC = (
    f"select {PRODUCT}, name, {strip_price(_P)} as promotion_price, "
    f"{strip_price(_O)} as original_price, "
    "case when seq%10=9 then 'null' else '/b/'||(seq%9) end as badge_url "
    "from listing where seq%11<>0 and seq%13<>0"
)
DETAIL_BIGC_BY_ID = (
    f"select {PRODUCT}, name, {_P}, coalesce({_O}, case when {_P} is null then '15' end) as {_O}, "
    "case when seq%2=0 then 'https://www.bigc.co.th/b/1' else 'https://cdn.example/b/2' end "
    "as condition from listing"
)


def card_lotus(name: str = "name") -> str:
    return (
        f"select {CARD}, {name} as name, {strip_price(_P)} as promotion_price, "
        f"{num(f'coalesce({strip_currency(_O)}, {strip_currency(_P)})')} as original_price, "
        "case when seq%3=1 then 'Buy 2 Get 1' end as condition from listing where seq%17<>0"
    )


DETAIL_LOTUS = (
    f"select {PRODUCT}, name, case when {_O} is not null then {strip_price(_P)} end as "
    f"promotion_price, {num(f'coalesce({strip_currency(_O)}, {strip_currency(_P)})')} as "
    "original_price, case when seq%3=1 then 'Save 20' end as condition "
    "from listing where seq%12<>0"
)


def _tops(first: str, second: str, rest: str) -> str:
    return (
        f"case when {_P} is not null and {_O} is not null then {num(first)} end as promotion_price, "
        f"{num(f'coalesce({second}, {first})')} as original_price {rest}"
    )


_PT, _OT = f"trim(replace({_P}, '฿', ''))", f"trim(replace({_O}, '฿', ''))"
CARD_TOPS = f"select {CARD}, name, {_tops(_PT, _OT, 'from listing')}"
_PR, _OR = f"replace({_P}, '฿', '')", f"replace({_O}, '฿', '')"
DETAIL_TOPS = (
    f"select {PRODUCT}, name, {_tops(_PR, _OR, '')}, case when seq%2=0 then '2 for99' end "
    "as condition from listing where seq%14<>0"
)
_GO_PRICE = "(seq%9+1)||lpad(cast(seq%1000 as varchar), 3, '0')||'000'"
CARD_GO = (
    f"select {CARD}, family_name||' 3.5 Liters - '||(seq//2) as product_name_vi, "
    f"cast({_GO_PRICE} as bigint) as sale_price, "
    f"case when seq%2=1 then '9'||{_GO_PRICE} end as original_price, "
    "case when seq%3=0 then '-5%' end as discount_pct from listing"
)


def typed(source: str, read) -> str:
    return (
        f"select * exclude (promotion_text, original_text), {read('promotion_text')} as "
        f"promotion_price, {read('original_text')} as original_price from ({source})"
    )


# -- feed records ---------------------------------------------------------------
def scaled(value: str, scale: int) -> str:
    return f"cast({value} as double) / cast({scale} as double)"


HAS_DATA = "seq%11<>0"
HAS_ITEM = "seq%11<>0 and seq%7<>0"
# An item object with any field: also one that the schema does not name, or a null.
NOT_EMPTY = "seq%11<>0 and (seq%7<>0 or seq%17=0 or seq%19=0)"
HALF = "case when seq%13=0 then 0.5 else 0.0 end"
FEED_FLAT = (
    f"select case when {HAS_ITEM} then cast(seq as varchar) end as item_id, "
    f"case when {HAS_ITEM} then cast(seq%100 as varchar) end as shop_id, "
    f"case when {HAS_ITEM} then name end as title, "
    f"case when {HAS_ITEM} then {scaled('(seq+1)*12345+' + HALF, 100000)} end as price, "
    f"case when {HAS_ITEM} and seq%5<>0 then {scaled('(seq+1)*23456+' + HALF, 100000)} end as "
    "price_before_discount from listing"
)
FEED_OPTIONAL = (
    f"select case when {HAS_ITEM} then cast(seq as varchar) end as item_id, "
    f"case when {HAS_ITEM} then cast(seq%100 as varchar) end as shop_id, "
    f"case when {HAS_ITEM} then name end as title, case when {HAS_ITEM} then family_name end as title_tr, "
    f"case when {HAS_ITEM} then 'VND' end as currency, case when {HAS_ITEM} then cast(seq%50 as double)/10 end as rating_star, "
    f"case when {HAS_ITEM} and seq%6<>0 then {scaled('(seq+1)*1234567', 100000000)} end as price, "
    f"case when {HAS_ITEM} and seq%8<>0 then {scaled('(seq+1)*7654321', 100000000)} end as price_before_discount "
    f"from listing where {NOT_EMPTY}"
)
FEED_MODELS = (
    "select cast(seq as varchar) as item_id, seq*10+i as model_id, family_name||' / '||i as name, "
    "case when i=1 then family_name end as name_tr, "
    f"case when i<>2 then {scaled('(seq+1)*150000', 100000)} else cast(0 as double) end as price, "
    "cast(i as integer) as status, i=0 as has_stock "
    "from (select *, unnest(range(0, seq%3+1)) as i from listing where "
    f"{HAS_ITEM} and seq%4<>0)"
)
