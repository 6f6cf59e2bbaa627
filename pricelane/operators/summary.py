"""Counts, run summaries and watchlist coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricelane.fixed_values import NOT_COLLECTED


def listing_counts(listing: DataFrame) -> DataFrame:
    return listing.groupBy("Retailer").agg(F.count("*").alias("n_items"))


def attempts_per_address(attempts: DataFrame) -> DataFrame:
    """``url, ok, n, first_ts, last_ts`` over attempts ``url, ok, ts``."""
    return attempts.groupBy("url").agg(
        F.bool_or("ok").alias("ok"),
        F.count("*").alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def _totals() -> list[Column]:
    micros = F.unix_micros(F.max("last_ts").cast("timestamp")) - F.unix_micros(
        F.min("first_ts").cast("timestamp")
    )
    return [
        F.count_if("ok").alias("n_success"),
        F.count("url").alias("n_requested"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_attempts"),
        (micros / 1e6).alias("elapsed_seconds"),
    ]


def run_summary(attempts: DataFrame) -> DataFrame:
    """Totals of one run over its attempts ``url, ok, ts``.

    Attempts are first summed up per address, which avoids the row copies that
    several distinct counts side by side would need.
    """
    return attempts_per_address(attempts).agg(*_totals())


def observed_attempts(attempts: DataFrame, name: str = "run-totals") -> tuple[DataFrame, Observation]:
    """Attempts per address for the sink, and the run's totals, which come out of that write.

    The totals of ``run_summary`` without a scan of their own: ask the observation once the rows are written.
    """
    totals = Observation(name)
    return attempts_per_address(attempts).observe(totals, *_totals()), totals


def watchlist_coverage(watchlist: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row per watched address: its last good extraction, or a placeholder.

    ``attempts`` has ``url, attempt, ok`` and the price columns. The last good
    attempt is kept per task before the shuffle, so retries of one address
    never gather. A null attempt number is before all others; equal numbers are
    told apart by their values.
    """
    columns = ["name", "promotion_price", "original_price", "condition"]
    good = attempts.where(F.col("ok")).withColumn("collected", F.lit(True))
    latest = (
        good.groupBy("url")
        .agg(F.max_by(F.struct("collected", *columns), F.struct("attempt", *columns)).alias("row"))
        .select("url", "row.*")
    )
    name = F.when(F.col("collected"), F.col("name")).otherwise(NOT_COLLECTED)
    return (
        watchlist.select("url")
        .join(latest, "url", "left")
        .select("url", name.alias("name"), *columns[1:])
    )
