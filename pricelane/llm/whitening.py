"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance is never built. A pass sends an orthonormal block Q to the tasks; each adds up XᵀXQ of its own
centred vectors, and the sums of d x width numbers meet in the driver. One round of the iteration is

1. a Chebyshev polynomial of the covariance applied to Q, by its three-term recurrence, one pass a degree. It is at
   most one on the unwanted part of the spectrum, from zero to the least Ritz value of the block, and grows fast above it;
2. QR of the filtered block, one pass, and the Rayleigh-Ritz step in the block's space.

Rounds go on until certified: the residuals of all wanted components are at rounding level, and a fresh random block,
filtered in the same way and kept orthogonal to the found components, shows no greater Ritz value than the least wanted one. If
it does, its vectors join the block and the rounds go on. Sums of the numbers are exact, so the mean is the exact
one; vectors are centred by its whole part first and the rest after, so that no digits are lost.

The block is a few columns wider than the number of components, so a driver needs some numbers a dimension, whatever
the number of vectors. Tasks read vectors from a table of blocks in the shared folder; an executor that is lost
costs the tasks it ran.

Defined results: vectors that are null, hold null or non-finite entries, or have another length than most take no part;
components without variance (below ``RELATIVE_ZERO`` of the greatest) do not come out, so equal vectors or
one vector give no rows; equal eigenvalues give any orthonormal components of their space; repeated rows each count and come
out; a null key stays null; a deviation beyond 64 bits is null; an empty table gives no rows; columns other than key and vector may
have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import stored, table
from pricelane.llm._vectors import common_length, keyed_vectors, matrix, vector_blocks

#: Whole numbers are ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Columns of the block beyond the wanted ones, degree of the polynomial, columns of the probing block.
GUARD, DEGREE, PROBES = 16, 12, 8
ROUNDS = 60
#: Residuals relative to the greatest eigenvalue: what counts as rounding level, and what certifies at least.
AIM, CERTIFIED = 2e-14, 1e-12
RELATIVE_ZERO = 1e-12
#: Partial sums that the driver adds itself; beyond that Spark adds them in two steps.
DIRECT_SUMS = 256


class Whitening(NamedTuple):
    n: int
    sums: np.ndarray  # exact, per dimension
    components: np.ndarray  # unit columns
    eigenvalues: np.ndarray  # falling
    total: float  # trace of the covariance
    residual: float  # greatest of the wanted ones, relative to the first eigenvalue
    passes: int  # over all vectors


class Blocks(NamedTuple):
    """Stored vectors with their exact sums."""

    frame: DataFrame
    length: int
    count: int  # of blocks
    n: int
    sums: np.ndarray


def centre(numbers: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Vectors minus the exact mean: first its whole part, then the rest."""
    whole = np.array([s // n for s in sums.tolist()], np.int64)
    rest = np.array([(s % n) / n for s in sums.tolist()])
    return (numbers - whole) - rest


def added_up(blocks: Blocks, work: Callable[[np.ndarray], np.ndarray], kind: str = "<f8") -> np.ndarray:
    """The sum over all blocks of what ``work`` makes of a block's numbers, flat."""
    length = blocks.length

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column("numbers"):
                part = work(matrix(blob.as_py(), length)).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()], pa.binary())], ["part"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column("part"):
                part = np.frombuffer(blob.as_py(), kind)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = blocks.frame.select("numbers").mapInArrow(own, "part binary")
    if blocks.count > DIRECT_SUMS:
        parts = parts.repartition(math.isqrt(blocks.count)).mapInArrow(together, "part binary")
    return sum(np.frombuffer(blob.as_py(), kind) for blob in parts.toArrow().column("part"))


def read_blocks(df: DataFrame, key: str, vector: str, scale: int, shift: int) -> Blocks | None:
    """The vectors that take part, stored as blocks; none if there is none."""
    rows = keyed_vectors(df, key, vector)
    length = common_length(rows)
    if not length:
        return None
    frame = stored(vector_blocks(rows, length, scale, shift), "vector-blocks")
    count, n = frame.agg(F.count("*"), F.sum("n")).first()
    if not count:
        return None
    empty = Blocks(frame, length, count, n, np.zeros(length, np.int64))
    return empty._replace(sums=added_up(empty, lambda x: x.sum(axis=0), "<i8"))


class Covariance:
    """The covariance as a function: ``product(Q)`` is one pass over all vectors."""

    def __init__(self, blocks: Blocks):
        self.blocks, self.passes = blocks, 0

    def _sum(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        n, sums = self.blocks.n, self.blocks.sums
        self.passes += 1
        return added_up(self.blocks, lambda x: work(centre(x, n, sums))) / n

    def product(self, block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            return x.T @ (x @ block)

        return self._sum(work).reshape(block.shape)

    def trace(self) -> float:
        return float(self._sum(lambda x: np.square(x).sum(keepdims=True))[0])

    def filtered(self, block: np.ndarray, image: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
        """A Chebyshev polynomial of the covariance times ``block``: small on [0, cut], one at ``top``.

        ``image`` is the product of ``block``, known from the step before.
        """
        half = cut / 2
        scale = first = half / (top - half)
        before, now = block, (image - half * block) * (first / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - scale)
            before, now = now, (self.product(now) - half * now) * (2 * after / half) - (scale * after) * before
            scale = after
        return now


def orthonormal(block: np.ndarray) -> np.ndarray:
    sizes = np.linalg.norm(block, axis=0)
    return np.linalg.qr(block / np.where(sizes > 0, sizes, 1))[0]


def ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values falling, vectors, their products, residual lengths) in the space of an orthonormal block."""
    inner = block.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, products = block @ turn, image @ turn
    return values, vectors, products, np.linalg.norm(products - vectors * values, axis=0)


def greater_outside(covariance: Covariance, found: np.ndarray, least: float, top: float, rng: np.random.Generator) -> np.ndarray | None:
    """Vectors orthogonal to ``found`` with a Ritz value above ``least``, from a fresh random block."""

    def outside(block: np.ndarray) -> np.ndarray:
        for _ in range(2):
            block = block - found @ (found.T @ block)
        return orthonormal(block)

    width = min(PROBES, len(found) - found.shape[1])
    if width <= 0 or least >= top:
        return None
    block = outside(rng.standard_normal((len(found), width)))
    block = outside(covariance.filtered(block, covariance.product(block), least, top, DEGREE))
    values, vectors, _, _ = ritz(block, covariance.product(block))
    above = values > least * (1 + 1e-9)
    return vectors[:, above] if above.any() else None


def fit_blocks(blocks: Blocks, n_components: int = COMPONENTS) -> Whitening:
    """Components and eigenvalues of stored vectors."""
    d = blocks.length
    covariance = Covariance(blocks)
    wanted = min(n_components, d)
    nothing = Whitening(blocks.n, blocks.sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 1)
    total = covariance.trace()
    if not total > 0:
        return nothing
    rng = np.random.default_rng(11)
    block = orthonormal(rng.standard_normal((d, min(d, wanted + GUARD))))
    values, vectors, products, residuals = ritz(block, covariance.product(block))
    last = math.inf
    for _ in range(ROUNDS):
        present = values[:wanted] > RELATIVE_ZERO * values[0]
        worst = float((residuals[:wanted][present] / values[0]).max())
        if worst <= AIM or worst <= CERTIFIED and worst > last / 2:  # no more to gain
            extra = greater_outside(covariance, vectors[:, :wanted], max(values[wanted - 1], RELATIVE_ZERO * values[0]), values[0], rng)
            if extra is None:
                return Whitening(blocks.n, blocks.sums, vectors[:, :wanted][:, present], values[:wanted][present], total, worst, covariance.passes)
            block = orthonormal(np.hstack([vectors, extra]))
            last = math.inf
        else:
            last = worst
            cut = max(values[-1], 1e-6 * values[0])
            block = orthonormal(covariance.filtered(vectors, products, cut, values[0], DEGREE)) if cut < values[0] else orthonormal(products)
        block = orthonormal(block)  # once more, for orthogonality to rounding
        values, vectors, products, residuals = ritz(block, covariance.product(block))
    raise RuntimeError(f"the components did not settle in {ROUNDS} rounds: relative residual {worst:.1e}")


def fit_whitening(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", n_components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> Whitening | None:
    """The whitening of all vectors of a table; none for a table without vectors."""
    blocks = read_blocks(df, key, vector, scale, shift)
    return None if blocks is None else fit_blocks(blocks, n_components)


def whitened_rows(numbers: np.ndarray, model: Whitening) -> np.ndarray:
    return centre(numbers, model.n, model.sums) @ (model.components / np.sqrt(model.eigenvalues))


def deviations(numbers: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S)², exact; none beyond 64 bits."""
    apart = numbers * model.n - model.sums
    about = np.square(apart.astype(float)).sum(axis=1)
    exact = np.square(apart).sum(axis=1)
    return [int(e) if a < 9.2e18 else None for e, a in zip(exact.tolist(), about.tolist())]


def identity_error(blocks: Blocks, model: Whitening) -> float:
    """The largest entry, by size, of the whitened vectors' covariance minus the identity; one pass."""
    k = len(model.eigenvalues)

    def work(numbers: np.ndarray) -> np.ndarray:
        w = whitened_rows(numbers, model)
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    found = added_up(blocks, work) / model.n
    mean = found[k * k :]
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(blocks: Blocks, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of each vector that takes part."""
    length, k = blocks.length, len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, blob in zip(batch.column("ids"), batch.column("numbers")):
                numbers = matrix(blob.as_py(), length)
                white = whitened_rows(numbers, model)
                edges = np.arange(len(numbers) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(deviations(numbers, model), pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(white.ravel()))],
                    ["vec_id", "deviation", "whitened"],
                )

    return blocks.frame.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components, one row each."""
    blocks = read_blocks(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", SCALE, SHIFT)
    model = None if blocks is None else fit_blocks(blocks)
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*(F.lit(float(e / model.total)) for e in model.eigenvalues))
    return whiten(blocks, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, "place").alias("explained"), F.lit(identity_error(blocks, model)).alias("identity_error"),
    )
