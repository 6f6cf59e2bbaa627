"""Vectors as blocks of whole numbers, for the operators over embeddings.

A component ``c`` becomes ``floor(scale * c) + shift``. Vectors that are null, hold null or non-finite entries,
or have another length than most, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of numbers in one block.
BLOCK_BYTES = 1_000_000
#: Whole numbers are kept within these bounds, before ``shift``.
LIMIT = float(1 << 40)


def keyed_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Only ``vec_id`` and ``vector``, whatever other columns are called."""
    return df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def common_length(rows: DataFrame) -> int:
    """The length that most vectors have, the greater of equally frequent ones; 0 without vectors."""
    sizes = rows.where("vector is not null").groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.where("size > 0").agg(F.max(F.struct("n", "size")).alias("most")).first()["most"]
    return most["size"] if most else 0


def whole_numbers(vectors: pa.Array, length: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors that take part, their numbers as a matrix)."""
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(sizes == length)
    values = vectors.take(pa.array(right, pa.int64())).flatten().to_numpy(zero_copy_only=False).reshape(len(right), length)
    finite = np.isfinite(values).all(axis=1)  # a null entry has become not a number
    whole = np.clip(np.floor(scale * values[finite]), -LIMIT, LIMIT)
    return right[finite], whole.astype(np.int64) + shift


def vector_blocks(rows: DataFrame, length: int, scale: int, shift: int = 0) -> DataFrame:
    """``n, ids, numbers``: blocks of the vectors that take part, numbers as bytes of 64 bits each."""
    most = max(1, BLOCK_BYTES // (8 * max(1, length)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                piece = batch.slice(start, most)
                places, numbers = whole_numbers(piece.column("vector"), length, scale, shift)
                if len(places):
                    ids = piece.column("vec_id").take(pa.array(places, pa.int64())).to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([numbers.tobytes()], pa.binary())],
                        ["n", "ids", "numbers"],
                    )

    return rows.mapInArrow(run, "n long, ids array<long>, numbers binary")


def matrix(blob: bytes, length: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, length)
