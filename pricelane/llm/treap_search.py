"""Ranked lexical search over a K2-treap of the term-document grid.

Documents are indexed in ranges, as tasks read them. The grid of a range has a row for each of its terms, frequent ones
first, and a column for each document that has terms, by ascending key. A quadtree over the grid is kept as one four-bit
mask for each cell that is not empty, level by level, with term frequencies at the leaves; children are
found by counting bits. Each cell holds the greatest impact of a term on a document below it. Impacts need the mean length
of all documents, so they are set when the statistics of the whole corpus are known.

A search starts with the whole range for each item. Every term of the item has a path from the root to its row; all paths
halve the documents together, and the sum of weight times cell maximum bounds the score of every document in
that half. Halves are opened best first, many at a time, and dropped once the item has enough documents that no bound can
beat. A task carries the found documents from range to range, so later ranges are dropped earlier; at the end each task hands
over no more than the wanted number for an item, and Spark merges them.

Items are searched in blocks whose terms are counted before they are sent to the tasks; every block is searched in all ranges.

Defined results: a null text has no terms, like an empty one; documents without terms are no columns and count nowhere; texts of
any length are read whole; equal scores go to the smaller key, a null key last; repeated document rows each take a rank; rows of
one item are taken together, a null item takes no part; items without a known term and empty tables give no rows; columns other
than key and text may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelane.llm._common import documents, keyed_text, slices, stored, table

#: Documents returned for each item.
TOP = 50
#: Bytes of text whose documents make one range, about.
RANGE_BYTES = 6_000_000
#: Distinct (item, term) pairs of one block of items.
BLOCK_PAIRS = 1_000_000
#: Halves opened at a time.
STEP = 512
_NO_KEY = np.iinfo(np.int64).max

#: Separators to blanks, A-Z to a-z; bytes from 0x80 belong to terms.
_FOLD = bytes(c if chr(c).isalnum() or c >= 0x80 else 32 for c in range(256)).lower()
INDEX = "keys array<long>, lengths array<long>, n_docs long, n_terms long, terms binary, dfs array<long>, masks binary, tfs array<int>"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def gathered(x: np.ndarray) -> np.ndarray:
    """The bits at even places, together again."""
    x = x & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def tree_depth(n_rows: int, n_columns: int) -> int:
    return max(n_rows - 1, n_columns - 1, 1).bit_length()


def tree_masks(row: np.ndarray, column: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(masks of all inner cells from the root on, order of the points at the leaves); a mask has bit 2*row + column."""
    codes = (spread(row) << np.uint64(1)) | spread(column)
    order = np.argsort(codes, kind="stable")
    cells, levels = codes[order], []
    for _ in range(depth):
        above = cells >> np.uint64(2)
        starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
        levels.append(np.bitwise_or.reduceat(np.left_shift(1, (cells & np.uint64(3)).astype(np.int64)), starts).astype(np.uint8))
        cells = above[starts]
    return np.concatenate(levels[::-1]), order


def range_row(keys: list, texts: list[bytes]) -> dict | None:
    """The index of one range of documents; none if no document has a term."""
    words = [terms_of(t) for t in texts]
    ranked = sorted((i for i, w in enumerate(words) if w), key=lambda i: _NO_KEY if keys[i] is None else keys[i])
    if not ranked:
        return None
    lengths = np.array([len(words[i]) for i in ranked], np.int64)
    numbers = _Numbers()
    term = np.array([numbers[w] for i in ranked for w in words[i]], np.int64)
    del words
    pairs, tfs = np.unique(np.repeat(np.arange(len(ranked)), lengths) * len(numbers) + term, return_counts=True)
    column, term = np.divmod(pairs, len(numbers))
    dfs = np.bincount(term, minlength=len(numbers))
    frequent = np.argsort(-dfs, kind="stable")
    row_of = np.empty_like(frequent)
    row_of[frequent] = np.arange(len(frequent))
    masks, order = tree_masks(row_of[term], column, tree_depth(len(numbers), len(ranked)))
    names = list(numbers)
    return {
        "keys": [keys[i] for i in ranked], "lengths": lengths, "n_docs": len(ranked), "n_terms": int(lengths.sum()),
        "terms": b" ".join(names[i] for i in frequent), "dfs": dfs[frequent], "masks": masks.tobytes(), "tfs": tfs[order],
    }


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each range of documents; no shuffle."""
    rows = keyed_text(docs, key, text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    types = {"keys": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "n_docs": pa.int64(), "n_terms": pa.int64(), "terms": pa.binary(), "dfs": pa.list_(pa.int64()), "masks": pa.binary(), "tfs": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, RANGE_BYTES):
                found = range_row(piece.column("doc_id").to_pylist(), piece.column("text").cast(pa.binary()).to_pylist())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([found[c]], t) for c, t in types.items()], list(types))

    return rows.mapInArrow(run, INDEX)


class Statistics(NamedTuple):
    n_docs: int
    n_terms: int


def statistics(indexed: DataFrame) -> Statistics:
    """Documents with terms, and all their terms."""
    found = indexed.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return Statistics(found[0] or 0, found[1] or 0)


class Tree:
    """The treap of one range, ready for searches."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray, masks: np.ndarray, tfs: np.ndarray, n_rows: int, corpus: Statistics):
        self.keys, self.depth = keys, tree_depth(n_rows, len(keys))
        self.masks = masks
        counts = np.array([bin(m).count("1") for m in range(16)])[masks]
        self.first = 1 + np.cumsum(counts) - counts  # number of the first child; the root is 0
        codes, start, levels = np.zeros(1, np.uint64), 0, []
        while start < len(masks):
            levels.append(start)
            cell, quarter = np.nonzero((masks[start : start + len(codes), None] >> np.arange(4)) & 1)
            start += len(codes)
            codes = (codes[cell] << np.uint64(2)) | quarter.astype(np.uint64)
        m = 100 - 50 + (50 * lengths * corpus.n_docs) // corpus.n_terms
        tf = tfs.astype(np.int64)
        self.best = np.empty(len(masks) + len(tfs), np.int64)  # greatest impact below each cell
        self.best[len(masks) :] = 1_000_000_000 * tf // (1000 * tf + 20 * m[gathered(codes)])
        for start, end in reversed(list(zip(levels, [*levels[1:], len(masks)]))):
            below = self.best[self.first[start] : self.first[end] if end < len(masks) else len(self.best)]
            self.best[start:end] = np.maximum.reduceat(below, self.first[start:end] - self.first[start])

    def top(self, rows: np.ndarray, weights: np.ndarray, found: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """``found`` (score, key), best first, with the documents of this range that belong among the best ``k``.

        ``rows`` are the grid rows of the item's terms.
        """
        cells = np.zeros((1, len(rows)), np.int64)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([int(weights.sum()) * int(self.best[0])])
        low = np.array([self.keys[0]])
        best_score = np.array([s for s, _ in found], np.int64)
        best_key = np.array([x for _, x in found], np.int64)
        depth, below = self.depth, np.array([[0b0000, 0b0001], [0b0011, 0b0111]])  # bits before quarter [row][column]
        counts = np.array([bin(m).count("1") for m in range(16)])
        while len(bound):
            if len(bound) > STEP:
                at = np.argpartition(-bound, STEP)
                opened, rest = at[:STEP], at[STEP:]
            else:
                opened, rest = np.arange(len(bound)), np.zeros(0, np.int64)
            row_bit = (rows[None, :] >> (depth - 1 - level[opened])[:, None]) & 1
            here = cells[opened]
            mask = np.where(here >= 0, self.masks[here], 0)
            parts = []
            for half in (0, 1):
                there = (mask >> (2 * row_bit + half)) & 1
                child = np.where(there, self.first[here] + counts[mask & below[row_bit, half]], -1)
                parts.append((child, level[opened] + 1, 2 * column[opened] + half, np.where(there, self.best[child], 0) @ weights))
            child, deeper, columns, bounds = (np.concatenate(x) for x in zip(*parts))
            some = bounds > 0
            child, deeper, columns, bounds = child[some], deeper[some], columns[some], bounds[some]
            lows = self.keys[columns << (depth - deeper)]
            done = deeper == depth
            if done.any():
                best_score, best_key = np.concatenate([best_score, bounds[done]]), np.concatenate([best_key, lows[done]])
                best = np.lexsort((best_key, -best_score))[:k]
                best_score, best_key = best_score[best], best_key[best]
            going = ~done
            cells = np.concatenate([cells[rest], child[going]])
            level, column = np.concatenate([level[rest], deeper[going]]), np.concatenate([column[rest], columns[going]])
            bound, low = np.concatenate([bound[rest], bounds[going]]), np.concatenate([low[rest], lows[going]])
            if len(best_score) == k:
                last, last_key = best_score[-1], best_key[-1]
                open_ = (bound > last) | ((bound == last) & (low <= last_key))
                cells, level, column, bound, low = cells[open_], level[open_], column[open_], bound[open_], low[open_]
        return list(zip(best_score.tolist(), best_key.tolist()))


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, term``: the distinct terms of each item."""
    kind = dict(items.dtypes)[key]
    rows = items.select(F.col(key).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("item_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id"), batch.column("text").cast(pa.binary()).to_pylist()):
                found = sorted(set(terms_of(text)))
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), batch.column("item_id").type), pa.array(found, pa.binary())], ["item_id", "term"])

    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def document_frequencies(indexed: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term is; Spark adds up the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, dfs in zip(batch.column("terms"), batch.column("dfs")):
                names = terms.as_py().split(b" ")
                at = [i for i, name in enumerate(names) if name in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at], pa.binary()), dfs.values.take(pa.array(at, pa.int64()))], ["term", "df"])

    found = indexed.select("terms", "dfs").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    return dict(zip(found.column("term").to_pylist(), found.column("df").to_pylist()))


def search_block(indexed: DataFrame, corpus: Statistics, pairs: list[tuple], kind: str, k: int) -> DataFrame:
    """``item_id, doc_id, score``: for each item of a block, the best documents of each task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    df_of = document_frequencies(indexed, {term for _, term in pairs})
    weights = {term: w for term, df in df_of.items() if (w := weight(corpus.n_docs, df)) > 0}
    asked: dict[object, list[bytes]] = {}
    for item, term in pairs:
        if term in weights:
            asked.setdefault(item, []).append(term)
    output = f"item_id {kind}, doc_id long, score long"
    schema = to_arrow_schema(_parse_datatype_string(output))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[object, list[tuple[int, int]]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                names = row["terms"].as_py().split(b" ")
                row_of = {name: i for i, name in enumerate(names) if name in weights}
                keys = row["keys"].values.fill_null(_NO_KEY).to_numpy()
                lengths, tfs = row["lengths"].values.to_numpy(), row["tfs"].values.to_numpy()
                tree = Tree(keys, lengths, np.frombuffer(row["masks"].as_py(), np.uint8), tfs, len(names), corpus)
                for item, terms in asked.items():
                    own = [t for t in terms if t in row_of]
                    if own:
                        rows = np.array([row_of[t] for t in own], np.int64)
                        found[item] = tree.top(rows, np.array([weights[t] for t in own], np.int64), found.get(item, []), k)
        best = [(item, None if key == _NO_KEY else key, score) for item, own in found.items() for score, key in own]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*best) if best else ((), (), ()), schema)], schema=schema)

    return indexed.select("keys", "lengths", "terms", "masks", "tfs").mapInArrow(run, output)


def search(indexed: DataFrame, items: DataFrame, k: int = TOP, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item. ``indexed`` is a stored ``index``."""
    corpus = statistics(indexed)
    pairs = stored(item_terms(items, key, text), "item-terms")
    kind = dict(pairs.dtypes)["item_id"]
    n_blocks = max(1, math.ceil(pairs.count() / BLOCK_PAIRS))
    found = None
    for block in range(n_blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).toArrow()
        own = search_block(indexed, corpus, sorted(zip(rows.column("item_id").to_pylist(), rows.column("term").to_pylist())), kind, k)
        own = own if n_blocks == 1 else stored(own, "found")
        found = own if found is None else found.union(own)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return search(stored(index(documents(spark, sf_dir)), "treaps"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as t from documents where text is not null),
s as (select count(*) as n_docs, sum(len(t)) as n_terms from d where len(t) > 0),
p as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(t) as n, unnest(t) as term from d) group by all),
b as (select distinct item_id, unnest({_TERMS}) as term from benchmark where item_id is not null and text is not null),
w as (select term, cast(floor(1000 * ln((2.0::double * n_docs + 2) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from p group by term), s),
x as (select item_id, r, doc_id, w * cast((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) as bigint) as part
  from b join w using (term) join p using (term), s),
t as (select item_id, doc_id, cast(sum(part) as bigint) as score from x group by item_id, r, doc_id),
k as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id asc nulls last) as int) as rank, doc_id, score from t where score > 0)
select item_id, rank, doc_id, score from k where rank <= {TOP}"""
