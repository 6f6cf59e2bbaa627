"""Quality rules on repetition inside a text, from a suffix array over its words.

The suffix array is built by prefix doubling: words are ranked, then pairs of ranks at distances 1,
2, 4 ... until no rank is shared. The ranks of every round are kept, so the longest common prefix of
neighbours in the array is read off by halving steps. The deepest interval of common prefixes that a
suffix belongs to names the longest repeated stretch that starts there; the union of these stretches,
and the longest one, decide.

Defined results: a null text or one without words has zeros everywhere; a text of any length is read
whole; repeats never cross rows; repeated rows give repeated results; only the key and text columns
are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, keyed_text, map_slices

#: A repeated stretch counts from this many words on.
MIN_WORDS = 8
#: Largest share of the words that repeated stretches may cover, and longest repeat in words.
MAX_COVERED, MAX_LONGEST = 0.4, 300

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\v\f\r"


def rank_rounds(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``symbols`` and, for k = 0, 1, ..., ranks by the first 2**k symbols.

    Ranks are the first place of their group in the order, so unique suffixes keep theirs and only
    the others are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    starts = np.ones(n, bool)
    starts[1:] = symbols[order][1:] != symbols[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rounds, step = [rank.copy()], 1
    while True:
        alone = starts & np.append(starts[1:], True)
        at = np.flatnonzero(~alone)  # places in the order that are still shared
        if not len(at):
            return order, rounds
        suffix = order[at]
        ahead = suffix + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[suffix]
        again = np.argsort(first * (n + 1) + second)
        suffix, first, second = suffix[again], first[again], second[again]
        order[at] = suffix
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        starts[at] = new
        rank[suffix] = np.maximum.accumulate(np.where(new, at, 0))
        rounds.append(rank.copy())
        step *= 2


def neighbour_prefixes(order: np.ndarray, rounds: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix in the order with the one before it (0 for the first)."""
    n = len(order)
    found = np.zeros(n, np.int64)
    pairs = np.flatnonzero(rounds[0][order[1:]] == rounds[0][order[:-1]]) + 1
    a, b = order[pairs - 1].copy(), order[pairs].copy()
    length = np.zeros(len(pairs), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = np.zeros(len(pairs), bool)
        same[inside] = rounds[k][a[inside]] == rounds[k][b[inside]]
        step = same.astype(np.int64) << k
        a, b, length = a + step, b + step, length + step
    found[pairs] = length
    return found


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def longest_repeats(words_of: list[list[str]]) -> list[np.ndarray]:
    """For each text, the longest repeated stretch that starts at each of its words."""
    flat: list[int] = []
    used = 0
    for words in words_of:  # each text has symbols of its own, so no prefix is shared between texts
        ids: dict[str, int] = {}
        flat.extend([ids.setdefault(w, used + len(ids)) for w in words])
        used += len(ids)
    sizes = np.array([len(w) for w in words_of])
    ends = np.cumsum(sizes + 1) - 1  # a symbol of its own ends each text
    symbols = np.empty(len(flat) + len(sizes), np.int64)
    inner = np.ones(len(symbols), bool)
    inner[ends] = False
    symbols[inner] = flat
    symbols[ends] = used + np.arange(len(sizes))
    order, rounds = rank_rounds(symbols)
    before = neighbour_prefixes(order, rounds)
    deepest = np.empty(len(symbols), np.int64)
    deepest[order] = np.maximum(before, np.append(before[1:], 0))
    return [deepest[e - s : e] for e, s in zip(ends, sizes)]


def measure(text: str, min_words: int, words: list[str], deepest: np.ndarray) -> tuple:
    n = len(words)
    triples = np.flatnonzero(deepest >= 3)
    long = np.flatnonzero(deepest >= min_words)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return (
        n,
        sum(map(len, words)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        int(covered(triples, np.full(len(triples), 3), n).sum()),
        int(covered(long, deepest[long], n).sum()),
        int(deepest.max(initial=0)) if len(long) else 0,
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")


def repetition_measures(df: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``MEASURES`` of every row; no shuffle."""
    rows = keyed_text(df, key, text)

    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        words_of = [_WORD.findall(t) for t in texts]
        found = [measure(t, min_words, w, r) for t, w, r in zip(texts, words_of, longest_repeats(words_of))]
        return {"doc_id": batch.column("doc_id")} | dict(zip(MEASURES, map(list, zip(*found))))

    kind = dict(rows.dtypes)["doc_id"]
    return map_slices(rows, work, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def repetition_ok(max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> Column:
    """The method's verdict on a row of measures."""
    return (F.col("n_covered_words") <= F.lit(max_covered) * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document with its measures and verdict."""
    return repetition_measures(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & repetition_ok()).alias("kept"),
        "n_covered_words", "longest_repeat",
    )
