import heapq
import re
import zlib

from pricelane.llm import slot_sharding
from test_llm_helpers import ODD, docs


def placed(spark, rows, shards=4, slots=64):
    sized = slot_sharding.sized(docs(spark, rows), slots=slots)
    return slot_sharding.placed(sized, slot_sharding.first_map(slot_sharding.slot_bytes(sized), shards)).collect()


def test_map_is_the_greedy_one(spark, folder):
    rows = slot_sharding.sized(spark.read.parquet(f"{folder}/documents.parquet"), slots=64)
    per_slot = slot_sharding.slot_bytes(rows)
    heap = [(0, s) for s in range(7)]
    want = {}
    for size, slot in sorted((-r["bytes"], r["slot"]) for r in per_slot.collect()):
        load, shard = heapq.heappop(heap)
        want[slot] = shard
        heapq.heappush(heap, (load - size, shard))
    got = {r["slot"]: r["shard"] for r in slot_sharding.first_map(per_slot, 7).collect()}
    assert got == want


def test_places_have_no_gaps(spark):
    rows = [(k, "x" * (k % 50)) for k in range(500)] + [(7, "x" * 7)] * 3
    got = placed(spark, rows)
    assert len(got) == len(rows)
    for shard in range(4):
        own = sorted(r["place"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(loads) - min(loads) < 0.05 * sum(loads) / 4


def test_sizes_and_odd_rows(spark):
    rows = [*ODD, (9, "é🙂")]
    got = {str(r["doc_id"]): (r["size"], r["text_crc32"]) for r in placed(spark, rows)}
    assert got["9"] == (22, zlib.crc32("é🙂".encode()))
    assert got["1"] == (16, 0)
    assert len(placed(spark, rows)) == len(rows)
    assert placed(spark, []) == []


def test_rebalancing_moves_few_slots_and_versions_stay(spark, tmp_path):
    rows = slot_sharding.sized(docs(spark, [(k, "x" * (k * 37 % 400)) for k in range(2000)]), slots=256)
    per_slot = slot_sharding.slot_bytes(rows)
    path = str(tmp_path / "map")
    first = slot_sharding.store_version(slot_sharding.first_map(per_slot, 4), path)
    before = {r["slot"]: r["shard"] for r in first.collect()}
    second = slot_sharding.store_version(slot_sharding.rebalanced(first, per_slot, 5), path)
    after = {r["slot"]: (r["shard"], r["bytes"]) for r in second.collect()}
    assert {r["version"] for r in second.collect()} == {1}
    assert {r["slot"]: r["shard"] for r in slot_sharding.read_map(spark, path, 0).collect()} == before
    assert after.keys() == before.keys()
    moved = sum(before[s] != after[s][0] for s in before)
    assert moved < len(before) * 0.35
    loads = [sum(b for s, b in after.values() if s == shard) for shard in range(5)]
    assert max(loads) - min(loads) < 0.1 * sum(loads) / 5


def test_no_python_on_the_main_path(spark, folder):
    plan = slot_sharding.op3_slot_sharding(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)
