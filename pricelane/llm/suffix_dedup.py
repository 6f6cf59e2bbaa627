"""Removal of byte strings that an earlier document holds, by prefix doubling over sampled positions.

Each string of ``LENGTH`` bytes holds a sampled position: the one whose ``SEED`` bytes hash lowest among those
inside. It depends on the string alone, so equal strings sample the same place. Positions, not all bytes,
are then ranked and sorted:

1. rank by the ``SEED`` bytes at the position; positions whose rank one document holds alone are done;
2. rank pairs (seed, all bytes of the strings that sampled the position); of equal pairs only those of
   the smallest document go on, all others are repeats of it;
3. those that are left, where one seed has several surroundings, are ranked by each string of ``LENGTH``
   bytes that they stand for, which is the threshold.

A task drops repeats among its own texts before the shuffle, so a hot text or passage sends one entry per
slice of input. Entries travel packed: Spark deals them out by rank and a task sorts one bucket of bounded
size at a time. Texts are shuffled once, to be joined with what is to be removed.

Defined results: a null or empty text has no bytes; texts shorter than ``LENGTH`` keep everything; a text
of any length is read whole; matches never cross rows; repeated rows have one key, so none removes from the other;
a null key takes no part and keeps everything; rows of one key are taken to have one text; ties do not
occur, as only smaller keys remove; columns other than key and text may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, slices, stored

LENGTH, SEED = 50, 20
PLACES = LENGTH - SEED + 1
#: Bytes of text whose entries make one bucket, about.
BUCKET_BYTES = 6_000_000
SLICE_BYTES = 2_000_000
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(data: np.ndarray, rising: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * rising[: len(data)], out=sums[1:])
    return sums


def sampled(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, position, first string, last string, seed rank, surroundings rank) of all sampled positions.

    ``data`` holds the texts one after the other; places are offsets into it. A position samples the
    strings that start from ``first`` to ``last``.
    """
    n = len(data)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    rising, falling = powers(_P, n + 1), powers(_P_INVERSE, n + 1)
    sums = prefix_hashes(data, rising)
    seeds = mixed((sums[SEED:] - sums[: n - SEED + 1]) * falling[: n - SEED + 1])
    lowest = (seeds & ~np.uint64(0xFFFFFFFF)) | np.arange(len(seeds), dtype=np.uint64)
    reach = 1
    while reach < PLACES:  # the lowest of the next 1, 2, 4 ... places
        step = min(reach, PLACES - reach)
        lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
        reach += step
    long = np.flatnonzero(lengths >= LENGTH)
    counts = lengths[long] - LENGTH + 1
    text = np.repeat(long, counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    place = (lowest[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    text, place, first = text[at], place[at], start[at]
    last = np.append(start[at[1:] - 1], start[-1:])
    around = mixed((sums[last + LENGTH] - sums[first]) * falling[first] + (place - first).astype(np.uint64) * _M1 + (last - first).astype(np.uint64) * _M2)
    return text, place, first, last, seeds[place], around


ENTRY = np.dtype([("seed", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("place", "<u4"), ("before", "u1"), ("more", "u1")])


def pack(entries: np.ndarray) -> bytes:
    """Entries column by column; steps from seed to seed, keys and places in as few bytes as they need."""
    least = int(entries["doc"].min())
    far = entries["doc"].astype(np.uint64) - np.uint64(least % (1 << 64))
    steps = np.diff(entries["seed"], prepend=entries["seed"][:1])
    kinds = [max(1, (int(steps.max()).bit_length() + 7) // 8)]
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : kinds[0]]
    parts = [low.T.tobytes(), entries["around"].tobytes(), entries["before"].tobytes(), entries["more"].tobytes()]
    for column in (far, entries["place"]):
        kind = next(k for k in ("<u2", "<u4", "<u8") if int(column.max()) < 1 << (8 * int(k[2])))
        kinds.append(int(kind[2]))
        parts.append(column.astype(kind).tobytes())
    return np.array([len(entries), least, *kinds], "<i8").tobytes() + entries["seed"][:1].tobytes() + b"".join(parts)


def unpack(blob: bytes) -> np.ndarray:
    n, least, size, *kinds = np.frombuffer(blob, "<i8", 5).tolist()
    out, at = np.empty(n, ENTRY), 48
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :size] = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T
    out["seed"] = np.frombuffer(blob, "<u8", 1, 40) + np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)
    at += n * size
    for name, kind in (("around", "<u8"), ("before", "u1"), ("more", "u1")):
        out[name] = np.frombuffer(blob, kind, n, at)
        at += n * np.dtype(kind).itemsize
    for name, width in zip(("doc", "place"), kinds):
        column = np.frombuffer(blob, f"<u{width}", n, at)
        at += n * width
        out[name] = (column.astype(np.uint64) + np.uint64(least % (1 << 64))).astype(np.int64) if name == "doc" else column
    return out


def groups(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def settle(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries that repeat a smaller document, the others, which of these are open) after steps 1 and 2."""
    entries = entries[np.lexsort((entries["doc"], entries["around"], entries["seed"]))]
    new_seed = groups(entries["seed"])
    new_pair = groups(entries["seed"], entries["around"])
    pair_start = np.maximum.accumulate(np.where(new_pair, np.arange(len(entries)), 0))
    repeats = entries["doc"] > entries["doc"][pair_start]
    kept = ~repeats
    seed_no = np.cumsum(new_seed) - 1
    heads = np.flatnonzero(new_pair)
    starts = np.flatnonzero(new_seed[heads]) if len(heads) else np.zeros(0, int)
    head_docs = entries["doc"][heads]
    if len(starts):
        several = np.minimum.reduceat(head_docs, starts) < np.maximum.reduceat(head_docs, starts)
    else:
        several = np.zeros(0, bool)
    return entries[repeats], entries[kept], several[seed_no[kept]] if len(entries) else kept


def seed_limits(n_buckets: int) -> np.ndarray:
    """Seeds at which buckets of equal weight begin, without the first.

    A place whose seed hash is the share ``1 - q`` of the range is sampled with probability q^(w-1) (1 + (w-1)(1-q)),
    w = ``PLACES``, so sampled seeds are low ones.
    """
    q = 1 - np.linspace(0, 1, 1 << 17)
    below = 1 - (PLACES + 1) / 2 * q**PLACES + (PLACES - 1) / 2 * q ** (PLACES + 1)
    share = np.interp(np.arange(1, n_buckets) / n_buckets, below, 1 - q)
    return (share * 2.0**32).astype(np.uint64) << np.uint64(32)


def packed_entries(rows: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, blob``: entries dealt by rank; bucket -1 and below: repeats that a task found itself."""
    limits = seed_limits(n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                texts = piece.column("text").cast(pa.binary()).to_pylist()
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = np.array([len(t) for t in texts], np.int64)
                if not (lengths >= LENGTH).any():
                    continue
                data = np.frombuffer(b"".join(texts), np.uint8)
                text, place, first, last, seed, around = sampled(data, lengths)
                begins = np.cumsum(lengths) - lengths
                entries = np.empty(len(text), ENTRY)
                entries["seed"], entries["around"], entries["doc"] = seed, around, ids[text]
                entries["place"], entries["before"], entries["more"] = place - begins[text], place - first, last - first
                repeats, entries, _ = settle(entries)
                bucket = np.searchsorted(limits, entries["seed"], side="right")
                edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
                numbers = [b for b in range(n_buckets) if edges[b + 1] > edges[b]]
                blobs = [pack(entries[edges[b] : edges[b + 1]]) for b in numbers]
                if len(repeats):
                    numbers.append(-1 - int(ids[0]) % n_buckets)
                    blobs.append(pack(repeats))
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return rows.mapInArrow(run, "bucket long, blob binary")


SETTLED = pa.schema([("doc_id", pa.int64()), ("first", pa.int32()), ("more", pa.int32()), ("place", pa.int32()), ("seed", pa.int64())])


def settled(packed: DataFrame) -> DataFrame:
    """``doc_id, first, more, place, seed``: strings to remove (place and seed null), and open positions with their seed.

    The strings start from ``first`` to ``first + more``, a step that takes few bits to store.
    """

    def rows_of(entries: np.ndarray, is_open: bool) -> pa.RecordBatch:
        place = entries["place"].astype(np.int64)
        first = (place - entries["before"]).astype(np.int32)
        if is_open:
            where = pa.array(place.astype(np.int32)), pa.array(entries["seed"].view(np.int64))
        else:
            where = pa.nulls(len(entries), pa.int32()), pa.nulls(len(entries), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(entries["doc"]), pa.array(first), pa.array(entries["more"].astype(np.int32)), *where], schema=SETTLED
        )

    def finish(bucket: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate([unpack(b) for b in blobs])
        if bucket < 0:
            yield rows_of(entries, False)
            return
        repeats, others, is_open = settle(entries)
        yield rows_of(repeats, False)
        yield rows_of(others[is_open], True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                if bucket != current and blobs:
                    yield from finish(current, blobs)
                    blobs = []
                current = bucket
                blobs.append(blob)
        if blobs:
            yield from finish(current, blobs)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc_id long, first int, more int, place int, seed long")


def open_contexts(rows: DataFrame, open_places: DataFrame) -> DataFrame:
    """``seed, doc_id, place, first, last, around``: the bytes around open positions, zeros beyond the text.

    ``rows`` has ``__key, text``.
    """
    wanted = open_places.groupBy("doc_id").agg(F.collect_list(F.struct("seed", "place", "first", "last")).alias("open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                out = []
                for doc, text, places in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "open"))):
                    data = b"\0" * LENGTH + text.encode() + b"\0" * LENGTH
                    out.extend((p["seed"], doc, p["place"], p["first"], p["last"], data[p["place"] + SEED : p["place"] + 2 * LENGTH]) for p in places)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                names = ["seed", "doc_id", "place", "first", "last", "around"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    joined = rows.join(wanted, F.col("__key") == F.col("doc_id")).select("doc_id", "text", "open")
    return joined.mapInArrow(run, "seed long, doc_id long, place int, first int, last int, around binary")


def open_repeats(contexts: DataFrame, n_buckets: int) -> DataFrame:
    """``doc_id, first, last``: strings of open positions that a smaller document holds (step 3)."""
    left = LENGTH - SEED  # bytes before a position in ``around``
    width = LENGTH + left

    def finish(rows: pa.Table) -> pa.RecordBatch:
        n = rows.num_rows
        seed, doc, place, first, last = (rows.column(c).to_numpy() for c in ("seed", "doc_id", "place", "first", "last"))
        data = np.frombuffer(b"".join(rows.column("around").to_pylist()), np.uint8).reshape(n, width)
        rising, falling = powers(_P, width + 1), powers(_P_INVERSE, width + 1)
        sums = np.zeros((n, width + 1), np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * rising[None, :width], axis=1, out=sums[:, 1:])
        gone = np.zeros((n, PLACES), bool)
        for before in range(PLACES):  # strings that begin so many bytes before their position
            at = np.flatnonzero((place - before >= first) & (place - before <= last))
            if not len(at):
                continue
            begin = left - before
            string = mixed((sums[at, begin + LENGTH] - sums[at, begin]) * falling[begin]) ^ mixed(seed[at].astype(np.uint64))
            order = np.lexsort((doc[at], string))
            string, who = string[order], doc[at][order]
            start = np.maximum.accumulate(np.where(groups(string), np.arange(len(at)), 0))
            gone[at[order[who > who[start]]], before] = True
        row, before = np.nonzero(gone)
        starts = place[row] - before
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(starts.astype(np.int32)), pa.array(starts.astype(np.int32))], ["doc_id", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if parts and bucket[a] != current:
                    yield finish(pa.Table.from_batches(parts))
                    parts = []
                current = bucket[a]
                parts.append(batch.slice(a, b - a))
        if parts:
            yield finish(pa.Table.from_batches(parts))

    dealt = contexts.withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(n_buckets))).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc_id long, first int, last int")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: what is left of each text, as bytes.

    The key's order says which copy stays, so it has to be a whole number; other kinds of keys are refused.
    """
    kind = docs.select(F.col(key)).dtypes[0][1]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{key} is {kind}, a whole number is needed")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(32, math.ceil(size / BUCKET_BYTES))
    found = stored(settled(packed_entries(rows.where("doc_id is not null"), n_buckets)), "repeats").withColumn("last", F.col("first") + F.col("more"))
    # both joins take the same rows, under a name of their own that the optimizer keeps in both, so that their texts are shuffled once
    keyed = rows.where("doc_id is not null").withColumnRenamed("doc_id", "__key")
    again = open_repeats(open_contexts(keyed, found.where("seed is not null")), n_buckets)
    gone = found.where("seed is null").select("doc_id", "first", "last").union(again)
    by_doc = gone.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("gone"))  # no longer than the text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                out = []
                for doc, text, spans in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "gone"))):
                    data = text.encode()
                    if not spans:
                        out.append((doc, len(data), 0, 0, data))
                        continue
                    edges = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edges, [s["first"] for s in spans], 1)
                    np.add.at(edges, [s["last"] + LENGTH for s in spans], -1)
                    drop = np.cumsum(edges)[:-1] > 0
                    n_spans = int(drop[0]) + int((drop[1:] & ~drop[:-1]).sum())
                    out.append((doc, len(data), int(drop.sum()), n_spans, np.frombuffer(data, np.uint8)[~drop].tobytes()))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    joined = keyed.join(by_doc, F.col("__key") == F.col("doc_id"), "left").select(F.col("__key").alias("doc_id"), "text", "gone")
    nothing = F.lit(None).cast(joined.schema["gone"].dataType)
    return joined.union(rows.where("doc_id is null").select("doc_id", "text", nothing)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what repeated strings cost it."""
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
