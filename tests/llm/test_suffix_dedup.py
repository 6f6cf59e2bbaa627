import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pricelane.llm import suffix_dedup
from test_llm_helpers import ODD, docs


def brute(rows):
    first, out = {}, {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        drop = [False] * len(data)
        for p in range(len(data) - 49):
            if first.setdefault(data[p : p + 50], key) < key:
                drop[p : p + 50] = [True] * 50
        spans = sum(d and not (p and drop[p - 1]) for p, d in enumerate(drop))
        out[key] = (len(data), sum(drop), spans, hashlib.sha256(bytes(c for c, d in zip(data, drop) if not d)).hexdigest())
    return out


def found(df):
    rows = suffix_dedup.remove_repeats(df).withColumn("h", F.sha2("kept", 256)).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["h"]) for r in rows}


def test_removed_bytes_are_those_of_brute_force(spark):
    rng = random.Random(2)
    def prose(n):
        return "".join(rng.choice("abcé ") for _ in range(n))
    passages = [prose(n) for n in (49, 50, 51, 80, 400)]
    rows = [(k, "".join(rng.choice([prose(20), rng.choice(passages), prose(3)]) for _ in range(12))) for k in range(80)]
    rows += [(200, "a" * 300), (201, "b" + "a" * 120), (202, "ab" * 200), (203, "ab" * 40), (204, passages[4]), (205, passages[4]), (206, None), (207, "")]
    assert found(docs(spark, rows).repartition(7)) == brute(rows)


def test_odd_rows(spark):
    rows = [(k, t if not t else t * 40) for k, t in ODD]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect())
    assert got == sorted([("1", 0, 0), ("2", 0, 0), ("3", 120, 0), ("4", 280, 0), ("4", 280, 0), ("None", 280, 0), ("5", 280, 0)])
    assert suffix_dedup.remove_repeats(docs(spark, ODD).limit(0)).count() == 0


def test_packing_round_trip():
    import numpy as np

    entries = np.zeros(5, suffix_dedup.ENTRY)
    entries["doc"] = [-3, 7, 1 << 40, 0, 5]
    entries["place"] = [0, 1, 70000, 3, 4]
    assert (suffix_dedup.unpack(suffix_dedup.pack(entries)) == entries).all()


def test_surroundings_of_one_seed_are_told_apart(spark):
    # one sampled string in both, and surroundings whose 64-bit hashes share their upper half
    rows = [(1, "xqvxlbbbpslolnvdlwpwpxd  ophpicjgkkdjcyvmkdo agyzb"), (2, "vrcnjwyuzjlgoexdlwpwpxd  ophpicjgkkxu xxbpkbutpxcu")]
    assert found(docs(spark, rows)) == brute(rows)


def test_packing_keeps_the_whole_hashes():
    import numpy as np

    rng = np.random.default_rng(3)
    entries = np.zeros(1000, suffix_dedup.ENTRY)
    entries["seed"] = np.sort(np.frombuffer(rng.bytes(8000), "<u8"))
    entries["around"] = np.frombuffer(rng.bytes(8000), "<u8")
    for some in (entries, entries[:1], entries[::-1]):
        assert (suffix_dedup.unpack(suffix_dedup.pack(some)) == some).all()


def test_buckets_have_equal_weight():
    import numpy as np

    data = np.random.default_rng(4).integers(0, 256, 1_000_000).astype(np.uint8)
    seed = suffix_dedup.sampled(data, np.array([len(data)]))[4]
    sizes = np.bincount(np.searchsorted(suffix_dedup.seed_limits(50), seed, side="right"), minlength=50)
    assert len(sizes) == 50 and sizes.max() < 1.2 * sizes.mean()


def test_keys_without_an_order_of_numbers_are_refused(spark):
    with pytest.raises(ValueError, match="string"):
        suffix_dedup.remove_repeats(spark.createDataFrame([("a", "text")], "doc_id string, text string"))


def test_texts_are_shuffled_once(spark, tmp_path):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(200))
    rows = [(k, f"{k:02}" * 40 + shared + f"{k:02}" * 40) for k in range(30)]  # surroundings differ at both ends
    docs(spark, rows).write.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        removed = suffix_dedup.remove_repeats(spark.read.parquet(str(tmp_path / "docs")))
        assert removed.count() == 30 and len(removed.collect()) == 30
        plan = removed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") == 1
