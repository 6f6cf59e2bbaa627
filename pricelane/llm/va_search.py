"""Exact top-k search by inner product over vector-approximation files.

Each dimension is cut into ``2 ** BITS`` cells of equal width between its least and greatest whole number; a vector's
approximation is one byte a dimension, kept in a column of its own beside the exact numbers. From the marks of its cells
follow the middle and the reach of a vector, and from these a lower and an upper bound of its score with any query.

1. The approximations alone are scanned. Each task keeps the ``k`` greatest lower bounds of each query; merged
   by Spark they give a score that the k-th result reaches at least.
2. The second scan picks, for each query, the vectors whose upper bound reaches that score, and reads their exact numbers in
   order of the bound, greatest first, until the k-th exact score is above the next bound. A task hands over at most
   ``k`` results a query; Spark ranks them.

Queries go to the tasks in blocks of bounded bytes; every block is held against all vectors. No pair of vectors becomes a
row unless it belongs to a task's results.

Defined results: vectors that are null, hold null or non-finite entries, or have another length than most take no part, nor do
null keys; all rows with a query's own key are the query's own; other repeated rows each take a rank; equal scores
go to the smaller key; an empty table gives no rows; with fewer than ``k`` other vectors all come out; scores are exact while
they and their bounds fit 53 bits; columns other than key and vector may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelane.llm._common import stored, table
from pricelane.llm._vectors import common_length, keyed_vectors, matrix, vector_blocks, whole_numbers

SCALE, TOP = 64, 20
#: Rows whose key is divisible by this are the queries of the checked search.
EVERY = 20
BITS = 6
#: Bytes of the numbers of one block of queries.
QUERY_BYTES = 16_000_000
#: Queries whose lower bounds travel together, and queries held against a block of vectors at once.
CHUNK, STRIPE = 64, 512
#: Exact vectors read at a time, in units of ``k``.
READ = 4


class Cells(NamedTuple):
    """The marks of all dimensions: cell c holds the whole numbers from marks[:, c] to before marks[:, c + 1]."""

    least: np.ndarray
    span: np.ndarray
    marks: np.ndarray

    @classmethod
    def between(cls, least: np.ndarray, greatest: np.ndarray, bits: int = BITS) -> Cells:
        span = greatest - least + 1
        n = 1 << bits
        return cls(least, span, least[:, None] - (-np.arange(n + 1)[None, :] * span[:, None] // n))

    def approximated(self, numbers: np.ndarray) -> np.ndarray:
        n = self.marks.shape[1] - 1
        return ((numbers - self.least) * n // self.span).astype(np.uint8)

    def middle_and_reach(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Twice the middle of a vector's cells, and twice how far its numbers may be from there."""
        place = np.arange(cells.shape[1])
        low = self.marks[place, cells]
        high = np.maximum(low, self.marks[place, cells.astype(np.int64) + 1] - 1)
        return (low + high).astype(float), (high - low).astype(float)


def extremes(rows: DataFrame, length: int, scale: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The least and the greatest whole number of each dimension, over all vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            _, numbers = whole_numbers(batch.column("vector"), length, scale, 0)
            if len(numbers):
                low = numbers.min(axis=0) if low is None else np.minimum(low, numbers.min(axis=0))
                high = numbers.max(axis=0) if high is None else np.maximum(high, numbers.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array(low), pa.array(high)], ["place", "low", "high"])

    found = rows.mapInArrow(run, "place int, low long, high long").groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow().sort_by("place")
    return (found.column("low").to_numpy(), found.column("high").to_numpy()) if len(found) else None


class File(NamedTuple):
    """A stored vector-approximation file: ``ids, cells, numbers`` in blocks."""

    blocks: DataFrame
    length: int
    cells: Cells


def write_file(vectors: DataFrame, length: int, scale: int = SCALE, bits: int = BITS) -> File | None:
    found = extremes(vectors, length, scale)
    if found is None:
        return None
    marks = Cells.between(*found, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [marks.approximated(matrix(blob.as_py(), length)).tobytes() for blob in batch.column("numbers")]
            yield pa.RecordBatch.from_arrays([batch.column("ids"), pa.array(cells, pa.binary()), batch.column("numbers")], ["ids", "cells", "numbers"])

    blocks = vector_blocks(vectors, length, scale).mapInArrow(run, "ids array<long>, cells binary, numbers binary")
    return File(stored(blocks, "va-file"), length, marks)


class Queries(NamedTuple):
    ids: np.ndarray
    numbers: np.ndarray


def stripes(queries: Queries) -> Iterator[slice]:
    return (slice(a, a + STRIPE) for a in range(0, len(queries.ids), STRIPE))


def thresholds(file: File, queries: Queries, k: int) -> np.ndarray:
    """For each query a doubled score that its k-th result reaches; the least number where there are fewer vectors."""
    length, marks, n = file.length, file.cells, len(queries.ids)
    numbers, sizes = queries.numbers.astype(float), np.abs(queries.numbers).astype(float)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        greatest = np.full((n, k), -np.inf)
        for batch in batches:
            for ids, blob in zip(batch.column("ids"), batch.column("cells")):
                keys = ids.values.to_numpy()
                middle, reach = marks.middle_and_reach(np.frombuffer(blob.as_py(), np.uint8).reshape(-1, length))
                for part in stripes(queries):
                    lower = numbers[part] @ middle.T - sizes[part] @ reach.T
                    lower[queries.ids[part, None] == keys[None, :]] = -np.inf
                    at = np.flatnonzero(lower.max(axis=1) > greatest[part].min(axis=1)) + part.start
                    if len(at):
                        greatest[at] = np.partition(np.hstack([greatest[at], lower[at - part.start]]), -k, axis=1)[:, -k:]
        chunks = range(0, n, CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array([greatest[c : c + CHUNK].tobytes() for c in chunks], pa.binary())], ["chunk", "greatest"])

    def together(group: pa.Table) -> pa.Table:
        chunk = group.column("chunk")[0].as_py()
        rows = min(CHUNK, n - chunk)
        best = np.full((rows, k), -np.inf)
        for blob in group.column("greatest"):
            best = np.partition(np.hstack([best, np.frombuffer(blob.as_py()).reshape(rows, k)]), -k, axis=1)[:, -k:]
        return pa.table({"chunk": [chunk], "kth": [best.min(axis=1).tolist()]}, schema=pa.schema([("chunk", pa.int64()), ("kth", pa.list_(pa.float64()))]))

    found = file.blocks.select("ids", "cells").mapInArrow(own, "chunk long, greatest binary").groupBy("chunk").applyInArrow(together, "chunk long, kth array<double>")
    return found.toArrow().sort_by("chunk").column("kth").combine_chunks().flatten().to_numpy()


def read_in_order(bounds: np.ndarray, keys: np.ndarray, numbers: np.ndarray, query: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int, read: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``best`` (scores, keys) with the vectors that belong among the best ``k``.

    Exact numbers are read in order of the bound, until the k-th result is certain.
    """
    scores, names = best
    order = np.lexsort((keys, -bounds))
    for at in range(0, len(order), READ * k):
        rows = order[at : at + READ * k]
        if len(scores) == k and (bounds[rows[0]] < 2 * scores[-1] or bounds[rows[0]] == 2 * scores[-1] and keys[rows[0]] > names[-1]):
            break
        read[0] += len(rows)
        scores, names = np.concatenate([scores, numbers[rows] @ query]), np.concatenate([names, keys[rows]])
        first = np.lexsort((names, -scores))[:k]
        scores, names = scores[first], names[first]
    return scores, names


def candidates(file: File, queries: Queries, least: np.ndarray, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the results of each task, ``k`` a query at most."""
    length, marks = file.length, file.cells
    numbers, sizes = queries.numbers.astype(float), np.abs(queries.numbers).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        nothing, read = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [0]
        for batch in batches:
            for ids, cells, blob in zip(batch.column("ids"), batch.column("cells"), batch.column("numbers")):
                keys, exact = ids.values.to_numpy(), matrix(blob.as_py(), length)
                middle, reach = marks.middle_and_reach(np.frombuffer(cells.as_py(), np.uint8).reshape(-1, length))
                for part in stripes(queries):
                    upper = numbers[part] @ middle.T + sizes[part] @ reach.T
                    some = (upper >= least[part, None]) & (queries.ids[part, None] != keys[None, :])
                    for row in np.flatnonzero(some.any(axis=1)):
                        at, query = np.flatnonzero(some[row]), row + part.start
                        best[query] = read_in_order(upper[row, at], keys[at], exact[at], queries.numbers[query], best.get(query, nothing), k, read)
        for query, (scores, names) in best.items():
            sure = 2 * scores >= least[query]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(sure.sum(), queries.ids[query])), pa.array(names[sure]), pa.array(scores[sure])], ["query_id", "vec_id", "score"]
            )

    return file.blocks.mapInArrow(run, "query_id long, vec_id long, score long")


def query_blocks(vectors: DataFrame, length: int, scale: int) -> Iterator[Queries]:
    """The queries, one row a key, in blocks of about ``QUERY_BYTES``."""
    rows = stored(vectors.groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    n = max(1, math.ceil(rows.count() * length * 8 / QUERY_BYTES))
    for block in range(n):
        found = vector_blocks(rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == block), length, scale).toArrow()
        if len(found):
            ids = np.concatenate([x.values.to_numpy() for x in found.column("ids")])
            numbers = np.concatenate([matrix(x.as_py(), length) for x in found.column("numbers")])
            order = np.argsort(ids)
            yield Queries(ids[order], numbers[order])


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE) -> DataFrame | None:
    """``query_id, rank, vec_id, score``: for each query its ``k`` best vectors of other keys.

    Both tables have ``vec_id, vector``; none if no vector takes part.
    """
    vectors = vectors.where("vec_id is not null")
    length = common_length(vectors)
    file = write_file(vectors, length, scale) if length else None
    if file is None:
        return None
    found = None
    for block in query_blocks(queries.where("vec_id is not null and vector is not null"), length, scale):
        own = stored(candidates(file, block, thresholds(file, block, k), k), "found")
        found = own if found is None else found.union(own)
    if found is None:
        return None
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_va_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every row whose key is divisible by 20."""
    vectors = keyed_vectors(table(spark, sf_dir, "embeddings"))
    found = top_inner_products(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long") if found is None else found


ORACLE_SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda c: cast(floor({SCALE} * cast(c as double)) as bigint)) as x from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
q as (select vec_id as query_id, x as y from v where vec_id % {EVERY} = 0),
s as (select query_id, vec_id, cast(list_sum(list_transform(list_zip(x, y), lambda p: p[1] * p[2])) as bigint) as score from q join v on query_id <> vec_id),
k as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from k where rank <= {TOP}"""
