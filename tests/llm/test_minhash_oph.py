import random

import numpy as np
import pytest

from pricelane.llm import minhash_oph
from test_llm_helpers import ODD, docs


def brute(rows, n_words, percent):
    sets = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        sets[key] = {tuple(w[i : i + n_words]) for i in range(len(w) - n_words + 1)} if len(w) >= n_words else ({tuple(w)} if w else set())
    links = []
    for a in sets:
        for b in sets:
            x = len(sets[a] & sets[b])
            if a != b and sets[a] and sets[b] and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                links.append((a, b))
    label, before = {k: k for k in sets}, None
    while label != before:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {k: (len(sets[k]), label[k], label[k] == k) for k in sets}


@pytest.mark.parametrize("n_words, percent", [(3, 85), (5, 80)])
def test_components_are_those_of_brute_force(spark, n_words, percent):
    rng = random.Random(n_words)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(99)) for _ in range(60)] for _ in range(4)]
    rows = []
    for k in range(70):  # near copies at all distances, chains among them
        words = list(base[k % 4])
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(9))
        rows.append((k, " ".join(words)))
    rows += [(100, "A b"), (101, "a B"), (102, ""), (103, None), (104, "one two three four"), (105, "One two THREE four")]
    got = minhash_oph.near_components(docs(spark, rows), n_words, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, n_words, percent)


def test_odd_rows(spark):
    got = minhash_oph.near_components(docs(spark, ODD)).collect()
    found = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got)
    assert found == [
        ("1", 0, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 1, "4", True), ("4", 1, "4", True),
        ("5", 1, "4", False), ("None", 1, "None", True),
    ]
    assert minhash_oph.near_components(docs(spark, ODD).limit(0)).count() == 0


def test_densified_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(200):
        words = [f"w{i}" for i in rng.integers(0, 10**9, 14)]
        other = words[:-1] + ["else"]
        row, hashed = minhash_oph.shingle_sets([" ".join(words), " ".join(other)], 3)
        bands = minhash_oph.band_hashes(row, hashed, 2)
        agree.append((bands[0] == bands[1]).mean())
    # 11 of 13 shingles are shared
    assert abs(np.mean(agree) - (11 / 13) ** minhash_oph.BINS_PER_BAND) < 0.1


def test_a_hot_text_is_one_node(spark):
    rows = [(k, "same words in every one of these rows") for k in range(300)] + [(1000, "quite another text stands here")]
    got = minhash_oph.near_components(docs(spark, rows))
    assert got.where("kept").count() == 2


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bitmaps_never_rule_out_a_link(spark, percent):
    rng = random.Random(percent)
    texts = []
    for size in (1, 2, 5, 30, 150, 900, 6000):  # far beyond the bitmap's bits too
        words = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        for changes in (0, 1, 2, 3, size // 60, size // 40, size // 30, size // 20):
            other = list(words)
            for _ in range(changes):
                other[rng.randrange(size)] = f"x{rng.randrange(10**9)}"
            texts.append(" ".join(other))
    row, hashed = minhash_oph.shingle_sets(texts, 3)
    sets = [set(hashed[row == k].tolist()) for k in range(len(texts))]
    parity = minhash_oph.parity_bitmaps(row, hashed, len(texts)).tolist()
    table = spark.createDataFrame([(k, len(sets[k]), parity[k]) for k in range(len(texts))], "k int, n long, p array<long>")
    one, two = table.toDF("a", "na", "pa"), table.toDF("b", "nb", "pb")
    parts = range(minhash_oph.PARITY_PARTS)
    likely = minhash_oph.may_link(percent, one["na"], [one["pa"][k] for k in parts], two["nb"], [two["pb"][k] for k in parts])
    kept = one.join(two, likely).select("a", "b").collect()
    linked = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if 100 * len(x & y) >= percent * len(x | y)}
    assert linked <= {tuple(r) for r in kept}
    assert len(kept) < 1.6 * len(linked)  # and few others pass


def test_near_misses_of_a_large_group_make_few_pairs(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"word{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(400):  # a third of the copies is close enough to others, the rest shares buckets only
        words = list(base)
        for at in rng.sample(range(150), rng.choice([2, 10, 13])):
            words[at] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    made, store = [], minhash_oph.stored

    def counted(df, name):
        out = store(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash_oph, "stored", counted)
    got = minhash_oph.near_components(docs(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 3, 85)
    assert sum(made) < 3 * len(rows)  # of 79,800 pairs


def test_texts_stay_in_place_while_the_nodes_are_few(spark, monkeypatch):
    rows, nodes = docs(spark, [(k, f"a b c d {k}") for k in range(20)]), docs(spark, [(k, "") for k in range(5)]).selectExpr("doc_id as node")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, joined in ((10, "BroadcastHashJoin"), (3, "SortMergeJoin")):
            monkeypatch.setattr(minhash_oph, "BROADCAST_NODES", most)
            sets = minhash_oph.sets_of(rows, nodes, 3)
            assert joined in sets._jdf.queryExecution().executedPlan().toString()
            assert sorted(r["node"] for r in sets.collect()) == [0, 1, 2, 3, 4]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
