import random
import re
import time

import pytest

from pricelane.llm import pii_crf
from pricelane.llm.pii_crf import KINDS, Span, base_spans
from test_llm_helpers import ODD, docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0,
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def naive(text):
    spans = [Span(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if holds(k, m[0])]
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choice("1234567890 .-+@ab%()1.2@é") for _ in range(rng.randint(1, 60)))
        assert base_spans(text) == naive(text), text


def test_long_runs_take_no_time():
    assert base_spans("a" * 500_000 + "1" * 500_000) == []
    assert len(base_spans("a" * 300_000 + "@b.c")) == 1


@pytest.fixture(scope="module")
def field(spark):
    rows = [(k, f"word here ab{k}.{k}@mail{k % 9}.example.com or 10.{k}.3.4 and 2024 then +1 (456) 555-{1000 + k} so 77 items") for k in range(200)]
    return pii_crf.train(docs(spark, rows))


@pytest.mark.parametrize(
    "text, kind, added",
    [
        ("Call +1 (456) 555-2186 or later (456) 555-2186 today", "phone", "(456) 555-2186"),
        ("mail rfmlrasf.67@mail6.example.com, so rfmlrasf.67 at work", "email", "rfmlrasf.67"),
        ("ip 42.144.35.254 and 42-144-35-254 too", "ip", "42-144-35-254"),
    ],
)
def test_repeats_in_another_dress_get_the_same_label(field, text, kind, added):
    spans = pii_crf.added_spans(text, base_spans(text), field)
    assert [(s.kind, text[s.start : s.end]) for s in spans] == [(kind, added)]


def test_clean_numbers_stay(field):
    for text in ("in 2024 and 2024 we had 77 of 77", "ip 1.2.3.4 in 2024, 12 or 12 or 99.5", "no numbers"):
        assert pii_crf.added_spans(text, base_spans(text), field) == []


def test_redaction_keeps_columns_and_nulls(spark, field):
    text = "é a@b.cd and +1 (456) 555-2186 é"
    df = spark.createDataFrame([(1, text, "x", len(text)), (2, None, "x", None), (3, "", "x", 0)], "doc_id long, text string, spans string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii_crf.redact(df, field).collect()}
    assert got == {1: ("é <EMAIL> and <PHONE> é", 23), 2: (None, None), 3: ("", 0)}


def test_odd_rows(spark):
    assert pii_crf.train(docs(spark, ODD)) is None
    found = pii_crf.find_spans(docs(spark, [*ODD, (9, "x" * 10 + " 1.2.3.4")]), None).collect()
    assert sum(len(r["spans"]) for r in found) == 1 and len(found) == len(ODD) + 1
    assert pii_crf.find_spans(docs(spark, ODD).limit(0), None).count() == 0


def test_query_counts_base_spans(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in pii_crf.op1_pii_crf(spark, folder).collect():
        base = naive(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.kind == k for s in base) for k in KINDS]


def test_texts_without_matches_are_scored(spark, field):
    strong = field._replace(node={**field.node, "at=True": field.node["at=True"] + [0.0, 9.0, 0.0, 0.0, 0.0]})
    for text in ("ask jane.doe@corp today", "ask jane.doe@corp, or 10.1.3.4 today"):  # no repeats, with and without a match
        spans = pii_crf.added_spans(text, base_spans(text), strong)
        assert [(s.kind, text[s.start : s.end]) for s in spans] == [("email", "jane.doe@corp")]
    df = spark.createDataFrame([(1, "ask jane.doe@corp today", 23)], "doc_id long, text string, n_chars long")
    assert [(r["text"], r["n_chars"]) for r in pii_crf.redact(df, strong).collect()] == [("ask <EMAIL> today", 17)]


def test_mentions_before_and_after_the_match_get_its_label(field):
    bare = ["see 456.555.2186 again"] * 20
    text = " then ".join([*bare, "+1 (456) 555-2186", *bare])
    spans = pii_crf.added_spans(text, base_spans(text), field)
    assert [(s.kind, text[s.start : s.end]) for s in spans] == [("phone", "456.555.2186")] * 40


def test_messages_settle(field):
    text = " ".join(f"+1 (456) 555-{2000 + k % 9} 555-{2000 + k % 7} {k}" for k in range(300))
    graph = pii_crf.build_graph(text, base_spans(text))
    assert abs(pii_crf.beliefs(graph, field) - pii_crf.beliefs(graph, field, 5 * pii_crf.ROUNDS)).max() < 1e-2


def test_long_words_take_no_time():
    began = time.perf_counter()
    assert pii_crf.build_graph("a" * 1_000_000, []) is None
    assert pii_crf.build_graph("x " + "a" * 1_000_000 + "@" + " y", []).starts == [2]
    assert time.perf_counter() - began < 3
