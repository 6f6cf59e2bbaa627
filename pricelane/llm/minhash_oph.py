"""Near-duplicates by one-permutation hashing with optimal densification and star-shaped candidates.

One hash per shingle: its upper bits choose a bin, the least hash of a bin is the bin's value, and an empty
bin takes the value of a bin found along a probing sequence that only depends on the empty bin. Bands
of bins give buckets. Documents with equal shingle sets are one node, so copies meet in no bucket.

In a bucket only a few centers are compared with the other members, the most connected first, so the
pairs stay in proportion to the members. A center that has met all members of its bucket leaves it; buckets whose
members are all in one component are done. Rounds with more centers, those of small components first, go on until
every bucket is done, so no two members of a bucket in different components stay uncompared. Links are confirmed on full shingle sets.

Most members of a large bucket are near misses. A parity bitmap of each shingle set tells them apart where the
bucket is joined: every bit in which two bitmaps differ stands for a shingle of only one of the sets, so a pair
with too many such bits cannot be similar enough. The bound never drops a link; sets too large for the bitmap pass it.

With the defaults a pair at the threshold shares no bucket with a chance below one in a million.

Defined results: a null text, or one without words, has no shingles and is linked with nothing; fewer words
than a shingle needs are one shingle; a text of any length is read whole; a null key takes no part and stays;
repeated rows belong to one component; ties for a component's name go to the smallest key; an empty table
gives no rows; columns other than key and text may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pricelane.llm._common import documents, keyed_text, map_slices, stored, worker_cache

#: Words in a shingle and least similarity in percent, as the query takes them.
WORDS, PERCENT = 3, 85
BANDS, BINS_PER_BAND = 60, 8
BINS = BANDS * BINS_PER_BAND
#: 64-bit parts of a set's parity bitmap.
PARITY_PARTS = 4
#: Nodes whose keys are broadcast to the texts, 50 MB or so; beyond that the texts are shuffled to them.
BROADCAST_NODES = 2_000_000
_CACHED_WORDS = 500_000
_PROBES = 4096
#: Text and rows that are sketched at once; a row takes some 30 bytes a bin meanwhile, a byte of text some 40.
_SLICE_BYTES, _SLICE_ROWS = 1_000_000, 500

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> list[int]:
    import xxhash

    kept = worker_cache("minhash")
    known = kept.get("words")
    if known is None or len(known) > _CACHED_WORDS:
        known = kept["words"] = {}
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return out


def shingle_sets(texts: list[str], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of all texts, by row and then by hash."""
    split = [t.encode().lower().split() for t in texts]  # bytes: only A-Z changes, only ASCII white space splits
    sizes = np.array([len(s) for s in split], np.int64)
    flat = np.array(word_hashes([w for s in split for w in s]), np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    short = (sizes > 0) & (sizes < n_words)
    counts = np.where(short, 1, np.maximum(0, sizes - n_words + 1))
    row = np.repeat(np.arange(len(texts)), counts)
    first = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[row]
    hashed = np.zeros(len(row), np.uint64)
    ends = starts[row] + sizes[row]
    for k in range(n_words):
        at = first + k
        inside = at < ends
        word = np.where(inside, flat[np.minimum(at, max(0, len(flat) - 1))] if len(flat) else np.uint64(0), np.uint64(k))
        hashed = mixed(hashed * _STEP + word + np.uint64(1))
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    return row[new], hashed[new]


def probing() -> np.ndarray:
    """For each attempt and empty bin, the bin to look at; the same for all texts."""
    kept = worker_cache("minhash")
    if "probes" not in kept:
        probes = kept["probes"] = np.empty((_PROBES, BINS), np.int16)
        for start in range(0, _PROBES, 256):  # a part at a time, as 64-bit numbers take some room
            seeds = np.arange(start * BINS, (start + 256) * BINS, dtype=np.uint64).reshape(256, BINS)
            probes[start : start + 256] = (mixed(seeds * _STEP + np.uint64(7)) >> np.uint64(32)) % np.uint64(BINS)
    return kept["probes"]


def band_hashes(row: np.ndarray, hashed: np.ndarray, n_rows: int) -> np.ndarray:
    """Bucket numbers, one for each row and band; meaningless for rows without shingles."""
    bins = ((hashed >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    place = row * BINS + bins
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]  # hashes ascend, so the first of a bin is its least
    values = np.zeros((n_rows, BINS), np.uint64)
    filled = np.zeros((n_rows, BINS), bool)
    values.flat[place[first]] = hashed[first]
    filled.flat[place[first]] = True
    some = filled.any(axis=1)
    at_row, at_bin = np.nonzero(~filled & some[:, None])
    probes = probing()
    for attempt in range(_PROBES):
        if not len(at_row):
            break
        source = probes[attempt, at_bin]
        found = filled[at_row, source]
        values[at_row[found], at_bin[found]] = values[at_row[found], source[found]]
        at_row, at_bin = at_row[~found], at_bin[~found]
    if len(at_row):  # a sequence that met no filled bin: the first filled one
        values[at_row, at_bin] = values[at_row, filled[at_row].argmax(axis=1)]
    out = np.arange(BANDS, dtype=np.uint64)[None, :] * _STEP
    for k in range(BINS_PER_BAND):
        out = mixed(out * _M1 + values[:, k::BINS_PER_BAND])
    return out


def parity_bitmaps(row: np.ndarray, hashed: np.ndarray, n_rows: int) -> np.ndarray:
    """``PARITY_PARTS`` numbers for each row; a bit says whether an odd number of shingles fell on it."""
    bits = 64 * PARITY_PARTS
    place = row * bits + (mixed(hashed ^ _STEP) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=n_rows * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n_rows, bits), axis=1).view(np.int64)


def may_link(percent: int, n_a: Column, parity_a: list[Column], n_b: Column, parity_b: list[Column]) -> Column:
    """False only for sets that cannot be similar enough: too unlike in size, or in too many bits of their bitmaps."""
    apart = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(parity_a, parity_b)), F.lit(0))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & ((100 + percent) * apart <= (100 - percent) * (n_a + n_b))


def sketches(rows: DataFrame, n_words: int) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, parity, bands``: size, fingerprint, bitmap and buckets of each shingle set."""
    kind = dict(rows.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        row, hashed = shingle_sets(batch.column("text").to_pylist(), n_words)
        edges = np.searchsorted(row, np.arange(n + 1))
        prefix = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        one, two = prefix(mixed(hashed + np.uint64(11))), prefix(mixed(hashed ^ _M2))
        bands = band_hashes(row, hashed, n).astype(np.int64)
        return {
            "doc_id": batch.column("doc_id"), "n_shingles": pa.array(np.diff(edges)),
            "f1": pa.array((one[edges[1:]] - one[edges[:-1]]).astype(np.int64)), "f2": pa.array((two[edges[1:]] - two[edges[:-1]]).astype(np.int64)),
            "parity": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * PARITY_PARTS), pa.array(parity_bitmaps(row, hashed, n).ravel())),
            "bands": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel())),
        }

    return map_slices(rows, work, f"doc_id {kind}, n_shingles long, f1 long, f2 long, parity array<long>, bands array<long>", _SLICE_BYTES, _SLICE_ROWS)


def full_sets(rows: DataFrame, n_words: int) -> DataFrame:
    """``node, shingles``: the whole shingle sets of the rows."""
    kind = dict(rows.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> dict:
        row, hashed = shingle_sets(batch.column("text").to_pylist(), n_words)
        edges = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        return {"node": batch.column("doc_id"), "shingles": pa.ListArray.from_arrays(pa.array(edges), pa.array(hashed.astype(np.int64)))}

    return map_slices(rows, work, f"node {kind}, shingles array<long>", _SLICE_BYTES)


def sets_of(rows: DataFrame, nodes: DataFrame, n_words: int) -> DataFrame:
    """``full_sets`` of the rows whose key is a ``node`` of a stored table, once each."""
    wanted = nodes.select(F.col("node").alias("doc_id"))
    if wanted.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    return full_sets(rows.join(wanted, "doc_id", "left_semi"), n_words).dropDuplicates(["node"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` (its least node) of the nodes of edges ``a, b``: least labels with jumps."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{label}-edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).withColumn("component", F.least("node", "component")), label
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        least = labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        new = stored(least.join(jump, "component").select("node", "before", F.least("component", "beyond").alias("component")), label)
        if new.where("before != component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
        .where(100 * F.col("shared") >= percent * (F.size("sa") + F.size("sb") - F.col("shared"))).select("a", "b")
    )


def near_components(df: DataFrame, n_words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    rows = keyed_text(df, key, text)
    sketch = stored(sketches(rows, n_words), "sketches")
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "f1", "f2"]
    nodes = some.groupBy(*same).agg(F.min("doc_id").alias("node"))  # pre-aggregated in each task
    labels = node_components(rows, some, nodes, n_words, percent)
    named = nodes.join(labels, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return sketch.select("doc_id", *same).join(named, same, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def merged(components_of: DataFrame, links: DataFrame) -> DataFrame:
    """``component, into``: components that new links join, after two steps to the least neighbour.

    Two steps are enough for stars; what they leave apart stays right, as links are only ever added, and
    ``components`` names the final ones.
    """
    ends = links.join(components_of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(
        components_of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b"
    )
    both = stored(ends.select(F.explode(F.array(F.struct(F.col("ca").alias("x"), F.col("cb").alias("y")), F.struct(F.col("cb").alias("x"), F.col("ca").alias("y")))).alias("e")).select("e.*").distinct(), "joined")
    one = stored(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("label")), "joined")
    two = both.join(one.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("label"))
    return two.join(one.withColumnRenamed("label", "own"), "x").select(F.col("x").alias("component"), F.least("label", "own").alias("into"))


def node_components(rows: DataFrame, some: DataFrame, nodes: DataFrame, n_words: int, percent: int) -> DataFrame:
    """``node, component`` of the nodes that have links."""
    members = some.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select(
        F.col("doc_id").alias("node"), F.explode("bands").alias("bucket")
    )
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    live = stored(members.join(shared, "bucket").distinct(), "members")
    # the middle of a group meets most
    parts = [f"parity_{k}" for k in range(PARITY_PARTS)]  # plain columns: less to shuffle than an array
    about = some.select(F.col("doc_id").alias("node"), "n_shingles", *(F.col("parity")[k].alias(p) for k, p in enumerate(parts))).dropDuplicates(["node"])
    labels = stored(live.groupBy("node").agg(F.sum("size").alias("degree")).join(about, "node").withColumn("component", F.col("node")), "labels")
    live = live.select("bucket", "node")
    sets = stored(sets_of(rows, labels, n_words), "shingle-sets")
    links = tested = None
    centers_each = 1
    while True:
        marked = live.join(labels.select("node", "component"), "node")
        several = marked.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        several = stored(several.select("bucket"), "open-buckets")  # a plain table, so that the join can split a hot bucket
        live = stored(live.join(several, "bucket", "left_semi"), "members")
        # the small components of a bucket meet the others, so the large one need not
        known = labels.select("node", "component", "degree").join(labels.groupBy("component").agg(F.count("*").alias("weight")), "component")
        order = Window.partitionBy("bucket").orderBy("weight", F.desc("degree"), "node")
        ranked = live.join(known, "node").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= centers_each)
        center = stored(
            ranked.select("bucket", "node").join(labels, "node").select(
                "bucket", F.col("node").alias("center"), F.col("component").alias("of"), F.col("n_shingles").alias("n_center"), *(F.col(p).alias(f"{p}_center") for p in parts)
            ),
            "centers",
        )
        if center.isEmpty():
            break
        side = live.join(labels.select("node", "component", "n_shingles", *parts), "node")
        likely = may_link(percent, F.col("n_shingles"), [F.col(p) for p in parts], F.col("n_center"), [F.col(f"{p}_center") for p in parts])
        met = side.alias("s").join(center.alias("c"), (F.col("s.bucket") == F.col("c.bucket")) & (F.col("component") != F.col("of")) & likely)
        pairs = met.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = stored(confirmed(pairs, sets, percent), "links")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            into = merged(labels, found)
            labels = stored(labels.join(into, "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into"), "labels")
        live = live.join(center.select("bucket", F.col("center").alias("node")), ["bucket", "node"], "left_anti")
        centers_each *= 8
    if links is None:
        return nodes.select("node", F.col("node").alias("component")).limit(0)
    return components(links)


def op10_minhash_oph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component of near-duplicates."""
    return near_components(documents(spark, sf_dir))
