"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.session import scratch_path, stored

__all__ = ["documents", "give_back", "keyed_text", "map_slices", "native_words", "scratch_path", "stored", "table", "tidy", "worker_cache"]

#: Text that one call of a task function sees at once; a longer row comes alone.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null text: empty), whatever other columns are called."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def native_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array, by built-in functions."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, text: str = "text", most_rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of rows that stay below ``limit`` bytes of the ``text`` column, one row at least, and ``most_rows`` at most."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = size = 0
    for at, length in enumerate(lengths):
        if at > start and (size + length > limit or at - start == most_rows):
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += length
    if start < len(lengths):
        yield batch.slice(start)


def give_back() -> None:
    """What this process has freed goes back to the system; idle workers would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, if it has one
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task function ``run``, which gives free memory back when its task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def map_slices(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, limit: int = SLICE_BYTES, most_rows: int | None = None
) -> DataFrame:
    """``mapInArrow`` over bounded slices; ``work`` returns the output columns as lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit, most_rows=most_rows):
                columns = work(piece)
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(tidy(run), schema)


def worker_cache(owner: str) -> dict:
    """A dictionary of one operator that lives as long as the Python worker, for models and bounded caches.

    Workers go on from stage to stage; what another operator has kept goes when the next one asks.
    """
    name = "pricelane_worker_cache"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    kept = module.__dict__.setdefault("kept", {})
    if owner not in kept:
        kept.clear()
        give_back()
    return kept.setdefault(owner, {})
