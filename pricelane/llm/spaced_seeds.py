"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits, in lower case. Fixed masks look at six of nine neighbouring
tokens and ignore the others, so a seed survives substitutions at the ignored places. Seeds of all test items
are joined with the seeds of all documents. Around each hit, the item's window of up to ``WINDOW`` tokens is
laid over the document at the hit's offset; the overlap counts if enough tokens agree. An item with fewer than nine
tokens has one seed of all its tokens, which documents must hold word for word; ``min_tokens`` says
from which length an item is more than a phrase of ordinary text.

Everything is DataFrame functions. The seeds of the items are broadcast only if their counted rows stay
below ``BROADCAST_SEEDS``; beyond that Spark joins by shuffling, with the same rows.

Defined results: null or empty texts have no seeds, nor have items with fewer than ``min_tokens`` tokens; texts of any length are read whole; places beyond a document's end count as disagreement; repeated rows
give one match per key and item; a null key takes no part and stays in ``without_matches``; empty tables
give no rows; columns other than key and text may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, table

SPAN = 9
#: Places of a window of ``SPAN`` tokens that each mask looks at.
MASKS = ((0, 1, 3, 4, 7, 8), (0, 2, 3, 5, 6, 8), (0, 1, 2, 5, 7, 8))
#: Tokens of an item around a hit, and the share of them that must agree.
WINDOW, MIN_SHARE = 20, 0.7
#: Tokens that an item needs to be looked for; shorter ones are ordinary phrases.
MIN_TOKENS = 4
#: Rows of 24 bytes, about 50 MB.
BROADCAST_SEEDS = 2_000_000


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seeds(rows: DataFrame, key: str) -> DataFrame:
    """``key, pos, seed`` for each window of a ``tokens`` column and each mask."""
    hashed = rows.select(key, F.transform("tokens", lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") >= SPAN)
    shifted = (F.slice("h", place + 1, F.size("h") - F.lit(SPAN - 1)).alias(f"t{place}") for place in range(SPAN))
    windows = hashed.select(key, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "w"))
    masked = (F.xxhash64(F.lit(number), *(F.col(f"w.t{place}") for place in mask)) for number, mask in enumerate(MASKS))
    return windows.select(key, "pos", F.explode(F.array(*masked)).alias("seed"))


def whole_seeds(rows: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """``key, pos, seed`` for each run of as many tokens as one of ``lengths`` says."""
    hashed = rows.select(key, F.transform("tokens", lambda w: F.xxhash64(w)).alias("h"))

    def runs(n: int) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size("h") - n), lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(-n), F.slice("h", i + 1, n)).alias("seed"))
        )
        return F.when(F.size("h") >= n, found).otherwise(F.array().cast("array<struct<pos:int,seed:bigint>>"))

    return hashed.select(key, F.inline(F.concat(*map(runs, lengths))))


def hits(docs: DataFrame, items: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``doc_id, item_id, pos, item_pos`` where a seed of a document is one of an item."""
    wanted, held = seeds(items, "item_id"), seeds(docs, "doc_id")
    short = items.where(F.size("tokens").between(max(1, min_tokens), SPAN - 1))
    lengths = sorted(r["n"] for r in short.select(F.size("tokens").alias("n")).distinct().collect())  # eight rows at most
    for n in lengths:
        wanted = wanted.unionByName(whole_seeds(short.where(F.size("tokens") == n), "item_id", [n]))
    if lengths:
        held = held.unionByName(whole_seeds(docs, "doc_id", lengths))
    wanted = wanted.select("item_id", F.col("pos").alias("item_pos"), "seed").distinct()
    if wanted.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    return held.join(wanted, "seed").select("doc_id", "item_id", "pos", "item_pos").distinct()


def agreement(doc: Column, item: Column, pos: Column, item_pos: Column, window: int = WINDOW) -> tuple[Column, Column]:
    """(tokens that agree, tokens compared) in the item's window around a hit."""
    length = F.least(F.size(item), F.lit(window))
    start = F.greatest(F.lit(0), F.least(item_pos - (window - SPAN) // 2, F.size(item) - length))
    offset = pos - item_pos
    same = F.filter(F.sequence(start, start + length - 1), lambda i: F.coalesce(F.get(item, i) == F.get(doc, i + offset), F.lit(False)))
    return F.size(same), length


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", min_share: float = MIN_SHARE, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``doc_id, item_id, agreeing, compared, n_hits``: the best confirmed window of each document and item."""
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where(F.col("doc_id").isNotNull())
    items = benchmark.select("item_id", tokens(F.col("text")).alias("tokens")).where("item_id is not null")
    found = hits(texts.select("doc_id", tokens(F.col("text")).alias("tokens")), items, min_tokens)
    # one list per document, no longer than its seeds that hit, so that its text is split once
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "pos", "item_pos")).alias("hits"))
    laid = (
        texts.join(by_doc, "doc_id").select("doc_id", tokens(F.col("text")).alias("doc_tokens"), "hits")
        .select("doc_id", "doc_tokens", F.inline("hits"))
        .join(items.withColumnRenamed("tokens", "item_tokens"), "item_id")
    )
    agreeing, compared = agreement(F.col("doc_tokens"), F.col("item_tokens"), F.col("pos"), F.col("item_pos"))
    scored = laid.select("doc_id", "item_id", agreeing.alias("agreeing"), compared.alias("compared"))
    return (
        scored.where(F.col("agreeing") >= F.lit(min_share) * F.col("compared"))
        .groupBy("doc_id", "item_id").agg(F.max("agreeing").alias("agreeing"), F.first("compared").alias("compared"), F.count("*").alias("n_hits"))
    )


def without_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key has no match."""
    bad = matches(docs, benchmark, key, text).select(F.col("doc_id").alias("__matched")).distinct()
    return docs.join(bad, docs[key] == F.col("__matched"), "left_anti")


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that overlap a benchmark item, with the item and how far they agree."""
    return matches(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    split = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    seed = " union all ".join(
        f"select k, i, {n} as mask, [{', '.join(f't[i + {p + 1}]' for p in mask)}] as seed from {{0}}" for n, mask in enumerate(MASKS)
    )
    half = (WINDOW - SPAN) // 2
    return f"""
with d as (select doc_id as k, {split} as t from documents where doc_id is not null),
b as (select item_id as k, {split} as t from benchmark where item_id is not null),
dw as (select k, t, unnest(range(len(t) - {SPAN - 1})) as i from d where len(t) >= {SPAN}),
bw as (select k, t, unnest(range(len(t) - {SPAN - 1})) as i from b where len(t) >= {SPAN}),
n as (select distinct len(t) as n from b where len(t) between {MIN_TOKENS} and {SPAN - 1}),
dn as (select k, t, n, unnest(range(len(t) - n + 1)) as i from d, n where len(t) >= n),
ds as ({seed.format("dw")} union all select k, i, -n, t[i + 1:i + n] from dn),
bs as ({seed.format("bw")} union all select k, 0, -len(t), t from b where len(t) between {MIN_TOKENS} and {SPAN - 1}),
h as (select distinct ds.k as doc_id, bs.k as item_id, ds.i as pos, bs.i as item_pos from ds join bs using (mask, seed)),
w as (select h.*, d.t as dt, b.t as bt, least(len(b.t), {WINDOW}) as n from h join d on d.k = doc_id join b on b.k = item_id),
s as (select *, greatest(0, least(item_pos - {half}, len(bt) - n)) as a from w),
x as (select doc_id, item_id, n, len(list_filter(range(a, a + n), lambda i: case when i + pos - item_pos < 0 then false else coalesce(bt[i + 1] = dt[i + pos - item_pos + 1], false) end)) as same from s)
select doc_id, item_id, cast(max(same) as int) as agreeing, cast(any_value(n) as int) as compared, count(*) as n_hits
from x where same >= {MIN_SHARE} * n group by doc_id, item_id"""


ORACLE_SQL = _sql()
