"""Unions, order and previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)


def union_toggle(catalogue: DataFrame, watchlist: DataFrame, just_watchlist: bool) -> DataFrame:
    return watchlist if just_watchlist else union_sources(catalogue, watchlist)


def sort_name(df: DataFrame, then_by: Sequence[str] = ()) -> DataFrame:
    """By name, nulls first, in byte order; rows of one name by ``then_by``, or by a hash of the row.

    Either way rows of one name differ in what they are sorted by, so a very common name
    spreads over several sort ranges. Only rows that are equal throughout stay together.
    """
    if then_by:
        return df.orderBy(F.asc_nulls_first("name"), *then_by)
    hashable = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return df.orderBy(F.asc_nulls_first("name"), F.xxhash64(*hashable))


def ordered_head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ordered_tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows by ``order``, still in that order."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)
