"""Rules on page and badge addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelane.fixed_values import BIGC_SITE


def page_url(base: Column, page_no: Column) -> Column:
    """Address of one result page; a page parameter already there is replaced."""
    has_query = base.contains("?")
    clean = F.when(has_query, F.substring_index(base, "&page=", 1)).otherwise(base)
    joint = F.when(has_query, "&page=").otherwise("?page=")
    return F.concat(clean, joint, page_no.cast("string"))


def url_short(url: Column, characters: int = 50) -> Column:
    """The last part of an address, cut to ``characters``."""
    return F.substring(F.substring_index(url, "/", -1), 1, characters)


def is_merged_url(url: Column) -> Column:
    """More than one address glued together."""
    return F.size(F.split(url, "https://")) > 2


def badge_url_absolute(src: Column) -> Column:
    return F.when(src.startswith("/"), F.concat(F.lit(BIGC_SITE), src)).otherwise(src)
