import re

import duckdb
import pytest

from pricelane.llm import spaced_seeds
from test_llm_helpers import ODD, docs

ITEM = " ".join(f"word{k}" for k in range(40))


def changed(text, every):
    return " ".join("other" if k % every == every - 1 else w for k, w in enumerate(text.split()))


@pytest.fixture()
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (None, ITEM)], "item_id long, text string")


def test_overlaps_survive_substitutions(spark, benchmark):
    rows = [(1, "x y " + ITEM + " z"), (2, "p q " + changed(ITEM, 7) + " r"), (3, changed(ITEM, 2)), (4, " ".join(ITEM.split()[5:30])), (5, "clean text " * 30)]
    got = {r["doc_id"] for r in spaced_seeds.matches(docs(spark, rows), benchmark).collect()}
    assert got == {1, 2, 4}
    left = spaced_seeds.without_matches(docs(spark, rows), benchmark)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5]
    assert left.columns == docs(spark, rows).columns


def test_odd_rows(spark, benchmark):
    rows = [*ODD, (8, ITEM), (8, ITEM), (None, ITEM)]
    assert [(r["doc_id"], r["item_id"]) for r in spaced_seeds.matches(docs(spark, rows), benchmark).collect()] == [(8, 1)]
    assert spaced_seeds.without_matches(docs(spark, rows), benchmark).count() == len(rows) - 2
    assert spaced_seeds.matches(docs(spark, rows).limit(0), benchmark).count() == 0
    assert spaced_seeds.matches(docs(spark, rows), benchmark.limit(0)).count() == 0


def test_short_items_word_for_word(spark):
    items = spark.createDataFrame(
        [(1, "What is the capital city of France?"), (2, "one two three four"), (3, "the end"), (4, "a b c d e f g h"), (5, "a b c d e f g h")],
        "item_id long, text string",
    )
    rows = [
        (1, "He asked: what is the capital city of France, twice. What is the capital city of France"), (2, "what is the capital town of France"),
        (3, "One, two. Three four"), (4, "one two three"), (5, "the end of the text"), (6, "x a b c d e f g h"), (7, None), (8, ""),
    ]
    got = spaced_seeds.matches(docs(spark, rows), items).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 7, 7, 2), (3, 2, 4, 4, 1), (6, 4, 8, 8, 1), (6, 5, 8, 8, 1)]
    found = spaced_seeds.matches(docs(spark, rows), items, min_tokens=1)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (3, 2), (5, 3), (6, 4), (6, 5)}


def test_short_items_agree_with_the_sql(spark, tmp_path):
    rows = [(k, " ".join(f"w{(k * 7 + j * j) % 11}" for j in range(k % 40))) for k in range(120)]
    items = [(k, " ".join(f"w{(k * 3 + j * j) % 11}" for j in range(k % 14))) for k in range(60)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = connection.execute(spaced_seeds.ORACLE_SQL).fetchall()
    got = spaced_seeds.op5_spaced_seeds(spark, str(tmp_path)).select("doc_id", "item_id", "agreeing", "compared", "n_hits").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len({r["item_id"] % 14 for r in got if r["item_id"] % 14 < 9}) > 2


def test_query_agrees_with_its_sql(spark, folder):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    want = connection.execute(spaced_seeds.ORACLE_SQL).fetchall()
    got = spaced_seeds.op5_spaced_seeds(spark, folder).select("doc_id", "item_id", "agreeing", "compared", "n_hits").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_no_python_on_the_main_path(spark, folder):
    plan = spaced_seeds.op5_spaced_seeds(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
