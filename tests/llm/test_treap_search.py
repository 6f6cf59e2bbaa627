"""The treap search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pricelane.llm import treap_search as ts
from pricelane.llm._common import stored
from test_llm_helpers import ODD, docs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k):
    words = [(key, Counter(terms(text))) for key, text in rows]
    words = [(key, c) for key, c in words if c]
    n_docs, n_terms = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item in sorted({i for i, _ in items if i is not None}):
        asked = {t for i, text in items if i == item for t in terms(text)}
        scored = []
        for key, c in words:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, r + 1, key, -s) for r, (s, _, key) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def found(spark, rows, items, k=5, parts=3):
    table = spark.createDataFrame(items, "item_id long, text string, term string") if items and len(items[0]) == 3 else spark.createDataFrame(items, "item_id long, text string")
    got = ts.search(stored(ts.index(docs(spark, rows).repartition(parts)), "treaps"), table, k).collect()
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got)


def random_rows(n, seed, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "été", "x1", "日本"]
    return [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_ranks_agree_with_all_scores(spark, monkeypatch, seed):
    monkeypatch.setattr(ts, "STEP", 4)
    rows = random_rows(300, seed)
    rows += [(1000 + i, rows[7][1]) for i in range(20)]  # ties
    items = [(i, text) for i, text in random_rows(8, 100 + seed)]
    assert found(spark, rows, items) == brute(rows, items, 5)


def test_odd_rows(spark):
    rows = [*ODD, (6, "A-b_C\x7fd"), (7, "x" * 300_000 + " " + "one " * 1000)]
    items = [(1, "ONE"), (1, "two"), (2, None), (3, "b C"), (None, "one"), (4, "nowhere"), (5, "")]
    assert found(spark, rows, items, 10) == brute(rows, items, 10)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "one")]) == []
    assert found(spark, [(1, None), (2, " ")], [(1, "one")]) == []
    empty = spark.createDataFrame([], "item_id string, text string")
    assert ts.search(stored(ts.index(docs(spark, [(1, "one")])), "treaps"), empty).collect() == []


def test_item_blocks_and_text_keys(spark, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK_PAIRS", 3)
    rows, items = random_rows(60, 9), random_rows(6, 10)
    table = spark.createDataFrame([(f"q{i}", text, 1) for i, text in items], "item_id string, text string, score int")
    got = ts.search(stored(ts.index(docs(spark, rows)), "treaps"), table, 4).collect()
    assert sorted((int(r["item_id"][1:]), r["rank"], r["doc_id"], r["score"]) for r in got) == brute(rows, items, 4)


def test_tree_holds_the_grid():
    rng = np.random.default_rng(3)
    cells = np.unique(rng.integers(0, 37 * 21, 200))
    row, column = np.divmod(cells, 21)
    depth = ts.tree_depth(37, 21)
    masks, order = ts.tree_masks(row, column, depth)
    tree = ts.Tree(np.arange(21), np.full(21, 5), masks, np.arange(1, 201)[: len(cells)][order].astype(np.int32) * 0 + 3, 37, ts.Statistics(21, 105))
    for r in range(37):
        want = sorted(column[row == r].tolist())
        got = tree.top(np.array([r]), np.array([1]), [], 50)
        assert [k for _, k in got] == want


def test_bits():
    x = np.array([0, 1, 5, 65535, 2**31 - 1])
    assert ts.gathered(ts.spread(x)).tolist() == x.tolist()
