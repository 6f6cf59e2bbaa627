"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's key decides its slot, one of a fixed number. Bytes and rows are summed per slot; the slots,
largest first, are each given to the shard with the fewest bytes so far. The map is stored as a
table of versions. Rebalancing writes a new version in which some slots have another shard; records
never change their slot.

Defined results: a null text has size ``overhead``; a null key has a slot of its own like any key;
repeated rows each get a place; an empty table gives an empty map and no rows; only the key and text
columns are read. Ties between slots go by slot number, between shards by shard number, and rows of
equal key and text have no order among them that could be told apart.
Everything here is DataFrame functions; the map has at most ``slots`` rows, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelane.llm._common import documents, scratch_path

#: Slots are fixed for the life of a corpus; about two hundred for each of 40 shards.
SLOTS = 8192
SHARDS = 40
OVERHEAD = 16
#: Parts of a slot that are numbered apart, so that no task numbers a whole hot slot.
PARTS = 16

MAP_SCHEMA = "version int, slot int, shard int, n_rows long, bytes long"


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, overhead: int = OVERHEAD) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, part``; the text itself goes no further."""
    utf8 = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(utf8) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        slot_of(F.col(key), slots).alias("virtual_slot"),
    ).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text_crc32"), F.lit(PARTS)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each slot that has any; pre-aggregated in each task."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"))


def least_loaded(loads: Column) -> Column:
    """Number of the first shard with the fewest bytes."""
    return F.array_position(loads, F.array_min(loads)).cast("int") - 1


def first_map(per_slot: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 0: slots from large to small, each to the shard with the fewest bytes so far.

    One fold over an array of at most ``slots`` entries, as slots go on from each other's loads.
    """
    entries = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("b"), "slot", "n_rows")))
    def deal(state, entry):
        shard = least_loaded(state["loads"])
        loads = F.transform(state["loads"], lambda load, i: F.when(i == shard, load - entry["b"]).otherwise(load))
        return F.struct(loads.alias("loads"), shard.alias("shard"), F.array_append(state["dealt"], shard).alias("dealt"))
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.lit(0).alias("shard"), F.array().cast("array<int>").alias("dealt")
    )
    folded = per_slot.agg(entries.alias("entries")).select(
        "entries", F.aggregate("entries", start, deal, lambda state: state["dealt"]).alias("dealt")
    )
    pairs = folded.select(F.inline(F.arrays_zip("entries", "dealt")))
    return pairs.select(
        F.lit(0).alias("version"), "entries.slot", F.col("dealt").alias("shard"), "entries.n_rows", (-F.col("entries.b")).alias("bytes")
    )


def store_version(slot_map: DataFrame, path: str) -> DataFrame:
    """Append one version of the map; older versions stay readable beside it."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)
    return read_map(slot_map.sparkSession, path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest if none is named."""
    kept = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is not None:
        return kept.where(F.col("version") == version)
    newest = kept.agg(F.max("version").alias("newest"))
    return kept.join(newest, F.col("version") == F.col("newest"), "left_semi")


def rebalanced(slot_map: DataFrame, per_slot: DataFrame, shards: int) -> DataFrame:
    """The next version for slots of new sizes or for more shards: few slots move.

    In each shard slots keep their place, small ones first, until the shard has its share of the
    bytes; the slots beyond fill the shards that have less, largest first, in the same fold as
    ``first_map``. With fewer shards all slots of the shards that go are dealt anew.
    """
    current = per_slot.join(slot_map.select("slot", "shard", "version"), "slot", "left")
    share = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    version = F.coalesce(F.max("version").over(Window.partitionBy()), F.lit(-1)) + 1
    upto = F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "slot"))
    marked = current.select(
        "slot", "n_rows", "bytes", version.cast("int").alias("version"),
        F.when((F.col("shard") < shards) & (upto <= share), F.col("shard")).alias("kept"),
    )  # at most ``slots`` rows
    base = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda shard: F.aggregate(
            F.filter("stay", lambda s: s["kept"] == shard), F.lit(0).cast("long"), lambda total, s: total + s["bytes"]
        ),
    )
    def deal(state, entry):
        shard = least_loaded(state["loads"])
        loads = F.transform(state["loads"], lambda load, i: F.when(i == shard, load - entry["b"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.array_append(state["dealt"], shard).alias("dealt"))
    gathered = marked.groupBy("version").agg(
        F.collect_list(F.when(F.col("kept").isNotNull(), F.struct("slot", "kept", "n_rows", "bytes"))).alias("stay"),
        F.array_sort(F.collect_list(F.when(F.col("kept").isNull(), F.struct((-F.col("bytes")).alias("b"), "slot", "n_rows")))).alias("move"),
    )
    folded = gathered.withColumn("loads", base).withColumn(
        "dealt",
        F.aggregate("move", F.struct(F.col("loads"), F.array().cast("array<int>").alias("dealt")), deal, lambda s: s["dealt"]),
    )
    stay = folded.select("version", F.inline("stay")).select("version", "slot", F.col("kept").alias("shard"), "n_rows", "bytes")
    moved = folded.select("version", F.inline(F.arrays_zip("move", "dealt"))).select(
        "version", "move.slot", F.col("dealt").alias("shard"), "move.n_rows", (-F.col("move.b")).alias("bytes")
    )
    return stay.unionByName(moved)


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each row with its shard and its place there, counted from 0 without gaps.

    Rows are numbered inside parts of slots; a part's first place in its shard comes from the counts
    per part, of which there are at most ``slots * PARTS``. Nothing sorts a shard in one task.
    """
    counts = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n"))
    shards = slot_map.select(F.col("slot").alias("virtual_slot"), "shard")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.join(shards, "virtual_slot").select(
        "virtual_slot", "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_place")
    )
    inside = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(first, ["virtual_slot", "part"]).withColumn("place", (F.col("first_place") + F.col("inside")).cast("long"))


def op3_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, by version 0 of a stored slot map."""
    rows = sized(documents(spark, sf_dir))
    slot_map = store_version(first_map(slot_bytes(rows)), scratch_path(spark, "slot-map"))
    return placed(rows, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
