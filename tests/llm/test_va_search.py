"""The search over approximations against all inner products."""

import numpy as np
import pytest

from pricelane.llm import va_search as va
from pricelane.llm._vectors import keyed_vectors

SCHEMA = "vec_id long, embedding array<float>, ids string, score int"


def found(spark, rows, k=20, parts=3, bits=None, monkeypatch=None):
    frame = keyed_vectors(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(parts))
    out = va.top_inner_products(frame, frame.where("vec_id % 20 = 0"), k)
    return [] if out is None else sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


def brute(rows, k=20):
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all()]
    out = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        own = next(v for i, v in sorted(good, key=lambda x: (x[0], x[1].tolist())) if i == q)
        scored = sorted((-int(own @ v), i) for i, v in good if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def vectors(n, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(8) * spread).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_all_products(spark, monkeypatch, bits):
    monkeypatch.setattr(va.Cells.between.__func__, "__defaults__", (bits,))
    monkeypatch.setattr(va.write_file, "__defaults__", (64, bits))
    rows = vectors(400, bits)
    assert found(spark, rows) == brute(rows)


def test_copies_and_ties(spark):
    rows = vectors(50, 1) + [(1000 + i, [0.5] * 8) for i in range(200)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [*vectors(45, 2), (60, None), (61, []), (80, [1.0] * 7), (81, [1.0] * 7 + [None]), (100, [float("nan")] * 8), (101, [float("inf")] * 8), (None, [1.0] * 8), (-20, [2.0] * 8), (5, [1.0] * 8), (20, [9.0] * 8)]
    assert found(spark, rows) == brute(rows)


def test_few_and_no_vectors(spark):
    assert found(spark, []) == [] and found(spark, [(0, None)]) == [] and found(spark, [(1, [1.0] * 8)]) == []
    rows = [(0, [1.0] * 8), (1, [2.0] * 8), (2, [-1.0] * 8)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(0, [1.0] * 8)]) == []


def test_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(va, "QUERY_BYTES", 200)
    rows = vectors(200, 3)
    assert found(spark, rows) == brute(rows)


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(4)
    numbers = rng.integers(-30, 30, (5000, 8))
    cells = va.Cells.between(numbers.min(axis=0), numbers.max(axis=0), 6)
    middle, reach = cells.middle_and_reach(cells.approximated(numbers))
    assert (np.abs(2 * numbers - middle) <= reach).all()
    query, read = numbers[0], [0]
    upper = middle @ query + reach @ np.abs(query)
    scores, keys = va.read_in_order(upper.astype(float), np.arange(5000), numbers, query, (np.zeros(0, int), np.zeros(0, int)), 20, read)
    want = sorted(zip((-(numbers @ query)).tolist(), range(5000)))[:20]
    assert list(zip((-scores).tolist(), keys.tolist())) == want and read[0] < 500
