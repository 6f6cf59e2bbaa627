"""A corpus pipeline of five operators: toxicity, near-duplicates, decontamination, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame over all rows that its predecessor kept.
All stages but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage
changes it. Rows with a null key pass every stage that needs a key to compare by; repeated rows of one key
are one document and stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm import bpe_reuse, minhash_oph, pii_crf, spaced_seeds, toxicity_ordinal
from pricelane.llm._common import documents, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicates here: five words, similarity 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from the labelled documents among them."""
    model = toxicity_ordinal.train(docs, table(spark, sf_dir, "labels"))
    return toxicity_ordinal.without_toxic(docs.select(*COLUMNS), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near-duplicates."""
    found = minhash_oph.near_components(docs, NEAR_WORDS, NEAR_PERCENT)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.select(*COLUMNS).join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return spaced_seeds.without_matches(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_crf.redact(docs.select(*COLUMNS), pii_crf.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and whether they decode to the text again."""
    encoded = bpe_reuse.encode_documents(docs)
    return bpe_reuse.decode_documents(encoded).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Trained models, buckets and message passing are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
