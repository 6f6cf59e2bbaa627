import json
import random

import pytest

from pricelane.sources import json_arrays, tables


def nasty(rng):
    pieces = ["}", "{", "[", "]", '"', "\\", "\\\"", "},{", "กรัม", "é", "\n", " ", "a", "b" * 40, "\\\\"]
    text = lambda: "".join(rng.choices(pieces, k=rng.randint(0, 12)))
    return {"id": rng.randint(0, 10**6), "t": text(), "m": [{text(): text()}, [text(), [1, {}]]], "n": None, "data": {"x": text()}}


def read(spark, path, block, cores_free=True):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        ranges = json_arrays.byte_ranges(spark, path)
        return ranges.rdd.getNumPartitions(), [r["record"] for r in json_arrays.read_records(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)


@pytest.mark.parametrize("seed", range(6))
def test_each_record_once_whatever_the_borders(spark, tmp_path, seed):
    rng = random.Random(seed)
    want = []
    for name in ("a", "b"):
        rows = [nasty(rng) for _ in range(60)]
        want += rows
        shown = json.dumps(rows, ensure_ascii=seed % 2 == 0, indent=[None, 1][seed % 3 == 0])
        (tmp_path / f"{name}.json").write_text("﻿ \n" * (seed == 4) + shown + "\n" * (seed % 2), encoding="utf-8")
    tasks, got = read(spark, str(tmp_path), rng.choice([64, 200, 900]))
    assert tasks > 4
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, map(json.loads, got))) == sorted(map(key, want))


def test_a_record_over_many_ranges(spark, tmp_path):
    rows = [{"a": 1}, {"long": "x}" * 5000, "deep": [[{"y": i} for i in range(300)]]}, {"b": "\\\""}, {}]
    (tmp_path / "f.json").write_text(json.dumps(rows))
    tasks, got = read(spark, str(tmp_path), 500)
    assert tasks > 10 and sorted(map(len, got)) == sorted(len(json.dumps(r)) for r in rows)
    assert all(json.loads(g) in rows for g in got)


@pytest.mark.parametrize("text, want", [
    ("[]", []), (" [ ] \n", []), ("{}", ["{}"]), ('{"a": [1]}\n{"b": 2}\n', ['{"a": [1]}', '{"b": 2}']), ("[1, \"x}\", null, {}]", ["{}"]), ("", []),
    ('[{"a": "[{"}, {"b": "\\\\"}]', ['{"a": "[{"}', '{"b": "\\\\"}']),
])
def test_small_files(spark, tmp_path, text, want):
    (tmp_path / "f.json").write_text(text)
    assert sorted(read(spark, str(tmp_path), 10**6)[1]) == sorted(want)
    if len(want) < 2 or "\n" not in text:
        assert sorted(read(spark, str(tmp_path), 64)[1]) == sorted(want)


def test_feed_items_of_an_array_file(spark, tmp_path):
    records = [{"data": {"data": {"item": {"item_id": i, "price": 100000 * i}}}} for i in range(5)] + [{"data": None}, {"other": 1}]
    (tmp_path / "f.json").write_text(json.dumps(records))
    items = tables.read_items(spark, str(tmp_path), arrays=True)
    assert sorted(r["data"]["data"]["item"]["item_id"] for r in items.where("has_item").collect()) == [0, 1, 2, 3, 4]
    assert items.count() == 7
