"""Small fixtures that the tests of this folder share."""

import re
import tracemalloc
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from pricelane.llm import _common, bpe_reuse, minhash_oph

#: Odd rows: null and empty texts, a null key, repeated rows, ties.
ODD = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (4, "one two"), (None, "one two"), (5, "One Two")]


def docs(spark, rows, clash=True):
    """Documents with columns whose names operators might use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ("bucket", "node", "size", "component", "tokens", "shard", "spans", "lang", "source")
    return df.select("doc_id", "text", *(F.lit("x").alias(c) for c in extra)) if clash else df


def test_fixture_has_clashing_names(spark):
    assert "bucket" in docs(spark, ODD).columns


class Plan:
    """Stands for a table: hands out the task function instead of a plan."""

    dtypes = [("doc_id", "bigint"), ("text", "string")]

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def own_mb():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_tasks_give_freed_memory_back(spark):
    """Idle workers would hold it through the next stages; the pipeline had 4 such workers an executor."""
    left = []

    def work(batch):
        held = [bytearray(b"x" * 2000) for _ in range(100_000)]
        left.append(held.pop())  # what lives on above the freed blocks keeps them from the system
        return {"doc_id": batch.column("doc_id")}

    run = _common.map_slices(Plan(), work, "doc_id long")
    before = own_mb()
    assert [b.num_rows for b in run([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a"]})])] == [1]
    assert own_mb() - before < 50


def test_many_short_rows_are_sketched_in_little_room(spark):
    run = minhash_oph.sketches(Plan(), 5)
    minhash_oph.probing()
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(6000)), "text": [f"a b c d e{i}" for i in range(6000)]})
    tracemalloc.start()
    try:
        got = sum(b.num_rows for b in run([rows]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == 6000 and peak < 40e6 and minhash_oph.probing().nbytes < 5e6


def test_slices_hold_few_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a"] * 7 + [None]})
    assert [p.num_rows for p in _common.slices(batch, most_rows=3)] == [3, 3, 2]
    assert [p.num_rows for p in _common.slices(batch, 2, most_rows=3)] == [2, 2, 2, 2]


def test_cached_ids_take_four_bytes_and_stay():
    own = bpe_reuse.Codec(bpe_reuse.default_tokenizer())
    text = " ".join(f"word{i} of some text" for i in range(2000))
    ids = own.encode(text)
    assert own.young and all(memoryview(found[0]).itemsize == 4 for found in own.young.values())
    assert ids == own.encode(text) == own.library.encode(text, add_special_tokens=False).ids and own.reused
