import random
import re
from collections import Counter

import pytest

from pricelane.llm import repetition
from test_llm_helpers import ODD, docs


def covered(words, n):
    seen = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    return len({k + j for k in range(len(words) - n + 1) if seen[tuple(words[k : k + n])] > 1 for j in range(n)})


def longest(words):
    best = 0
    for a in range(len(words)):
        for b in range(a):
            k = 0
            while a + k < len(words) and words[a + k] == words[b + k]:
                k += 1
            best = max(best, k)
    return best


def test_measures_are_those_of_brute_force(spark):
    rng = random.Random(4)
    texts = ["", None, " ", "a", "a a a a", "x\nx\n\n x", "#a $b & |<>* %"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [" ".join(str(rng.randrange(99)) for _ in range(30)) * 3, "one two\n" * 40]
    rows = list(enumerate(texts))
    for r in repetition.repetition_measures(docs(spark, rows), min_words=4).collect():
        text = texts[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert (r["n_repeat_words"], r["n_covered_words"]) == (covered(words, 3), covered(words, 4))
        found = longest(words)
        assert r["longest_repeat"] == (found if found >= 4 else 0)


def test_odd_rows(spark):
    assert repetition.repetition_measures(docs(spark, ODD)).count() == len(ODD)
    assert repetition.repetition_measures(docs(spark, ODD).limit(0)).count() == 0


def test_labelled_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = repetition.op8_repetition(spark, folder).join(labels, "doc_id").collect()
    long_clean = [r for r in rows if r["quality"] == 1 and r["n_words"] >= 50]
    assert all(r["kept"] for r in long_clean)
    assert any(not r["kept"] for r in rows if r["quality"] == 0 and r["n_words"] >= 50)


@pytest.mark.parametrize("size", [5000])
def test_long_periodic_text(size):
    words = ["a", "b", "c"] * size
    deepest = repetition.longest_repeats([words])[0]
    assert deepest[0] == len(words) - 3
