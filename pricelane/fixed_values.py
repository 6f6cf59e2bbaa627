"""Shop names, patterns, word lists, CSS hooks and placeholders.

These are facts about the shops' pages and about the output tables. Changing
one changes results, so they are kept together here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

# Retailer labels as they appear in output tables.
RETAILERS = {
    "7e": "7-Eleven",
    "makro": "Makro",
    "bigc": "BigC",
    "lotus": "Lotus's",
    "tops": "Tops",
}

# Columns of a cleaned price row and of the standard listing table, in order.
PRICE_COLUMNS = ("name", "promotion_price", "original_price", "condition")
LISTING_COLUMNS = PRICE_COLUMNS + ("Date", "Brand", "Volume", "Unit", "Pack", "Retailer")

# Placeholder texts written when a page lacks a field.
NO_NAME_CARD = "Unknown"
NO_NAME_DETAIL = "Unknown Name"
NO_NAME_TIERS = "Name not found"
NO_NAME_PRODUCT = "Unknown Product"
NO_TEXT = "N/A"
NO_BADGE = "null"
NO_TIERS = "{}"
NOT_COLLECTED = "Blocked or Not Found"

# Brands that 7-Eleven names start with (no space after them in many names).
THAI_BRANDS = ("ไฟน์ไลน์", "ไฮยีน", "เปา", "แอทแทค", "ไลปอนเอฟ")

# Pack notations, tried in this order at each position of the name.
PACK_FORMS = (
    r"PACK\s*\d*\s*FREE\s*\d+",
    r"PACK\s*\d*\s*\+\s*\d+",
    r"PACK\s*\d+",
    r"TWINPACK",
    r"\bX\s*\d+\b",
    r"P?\d+\s*\+\s*\d+",
    r"\(\d+\+\d+\)",
    r"\d+\s*FREE\s*\d+",
    r"\bPACK\b",
)
PACK_FORMS_X_PLUS = (
    r"PACK\s*\d*\s*FREE\s*\d+",
    r"PACK\s*\d*\s*\+\s*\d+",
    r"PACK\s*\d+",
    r"TWINPACK",
    r"\bX\s*\d+\s*\+\s*\d+",
    r"\bX\s*\d+\b",
    r"P?\d+\s*\+\s*\d+",
    r"\(\d+\+\d+\)",
    r"\d+\s*FREE\s*\d+",
    r"\bPACK\b",
)
PACK_FORMS_THAI = PACK_FORMS + (r"แพ็ก\s*\d+\s*ชิ้น",)


@dataclass(frozen=True)
class NameProfile:
    """How one shop writes volume, unit and pack size in a product name."""

    number: str
    units: str
    pack_forms: tuple[str, ...] = ()
    word_end: bool = False
    whole_volume: bool = False
    unit_case: str = "upper"  # "upper", "lower" or "as found"


# Number and unit notations; units are tried in this order.
NAME_PROFILES = {
    "7e": NameProfile(
        r"[\d,.]+", r"มล\.|ลิตร|ก\.ก\.|กรัม|ML|G|KG|L", PACK_FORMS_THAI, unit_case="as found"
    ),
    "makro": NameProfile(r"[\d.]+", r"ML|G|KG|L|GRAMS?", PACK_FORMS_X_PLUS),
    "bigc": NameProfile(r"[\d.]+", r"ML|G|KG|L|GRAMS?", PACK_FORMS, whole_volume=True),
    "lotus": NameProfile(r"[\d.]+", r"ML|G|KG|L|กรัม|GRAMS?", PACK_FORMS, whole_volume=True),
    "tops": NameProfile(r"[\d.]+", r"ML|G|KG|L|LTR|LITERS?|GRAMS?", PACK_FORMS_X_PLUS),
    "tops_base": NameProfile(r"\d+", r"ML|G|KG|L", word_end=True, whole_volume=True),
    "go": NameProfile(
        r"\d+(?:\.\d+)?", r"liters?|kg|g|ml|l", word_end=True, unit_case="lower"
    ),
}

# Product id at the end of a GO name.
GO_PRODUCT_ID = r"-\s*(\d+)\s*$"

# Words that decide a promotion label, after upper-casing and removing spaces.
PROMO_TYPOS = {"BUV": "BUY"}
PROMO_SAVE_WORDS = ("SAVE", "ประหยัด")
PROMO_GET_WORDS = ("GET", "แถม")
PROMO_ONE_FOR_ONE = ("1แถม1", "1GET1")
PROMO_CHEAPER_WORD = "CHEAPER"

# Words that mark a badge text as a promotion.
PROMO_FLAG_WORDS = ("BUY", "GET", "FREE", "1", "2", "ซื้อ", "แถม")

# Words that mark a text node as something other than a price.
NOT_A_PRICE_WORDS = ("buy", "get", "point")

# Catalogue prices outside this open range are not prices.
PRICE_RANGE = (5, 10000)

# Quantity-tier and price-line windows: number of entries read after the anchor.
TIER_WINDOW = 19
PRICE_LINE_WINDOW = 15

# Phrases of challenge and consent pages.
BIGC_BLOCK_TITLE = "Just a moment"
BIGC_BLOCK_HTML = ("Cloudflare", "Attention Required")
TOPS_BLOCK_TITLES = ("tops.co.th", "just a moment", "blocked", "checking")
TOPS_SITE = "tops.co.th"
LOTUS_BLOCK_TITLE = "Privacy Preference Center"

# Site prefix for relative badge addresses.
BIGC_SITE = "https://www.bigc.co.th"

# Feed prices are integers scaled by these factors.
FEED_PRICE_SCALE = 100_000.0
FEED_PRICE_SCALE_VN = 100_000_000.0
