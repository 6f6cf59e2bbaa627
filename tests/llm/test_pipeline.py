import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from pricelane.llm import minhash_oph, spaced_seeds, toxicity_ordinal

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = kept[name] = spark.read.parquet(path)
    return kept


def keys(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_and_decisions(spark, folder, stages):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in list(stages)[:-1]:
        assert stages[name].columns == docs.columns
    scored = toxicity_ordinal.score_rows(docs, toxicity_ordinal.train(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    assert keys(stages["toxicity"]) == keys(scored.where(F.col("p_toxic") < toxicity_ordinal.TOXIC_FROM))
    near = minhash_oph.near_components(stages["toxicity"], 5, 80)
    assert keys(stages["near_duplicates"]) == keys(near.where("kept"))
    bad = keys(spaced_seeds.matches(stages["near_duplicates"], spark.read.parquet(f"{folder}/benchmark.parquet")))
    assert keys(stages["decontamination"]) == keys(stages["near_duplicates"]) - bad
    assert keys(stages["personal_data"]) == keys(stages["decontamination"]) == keys(stages["tokens"])
    assert stages["personal_data"].where(F.col("text").rlike(r"\w@\w+\.\w")).count() == 0
    texts = {r["doc_id"]: r["h"] for r in stages["personal_data"].select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in stages["tokens"].collect()} == texts


def test_run_gives_the_last_stage(spark, folder, stages):
    got = driver.queries()["pipeline"](spark, folder)
    assert keys(got) == keys(stages["tokens"]) and got.columns == stages["tokens"].columns


def test_workers_need_no_import(folder, tmp_path):
    """Another session, started elsewhere, without the repository on the workers' path."""
    code = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {str(ROOT / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
for name in ("op1_pii_crf", "op2_toxicity_ordinal", "op11_whitening", "op12_treap_search", "op13_va_search", "pipeline"):
    print(name, entry.queries()[name](spark, {folder!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "pipeline" in done.stdout, done.stderr[-2000:]


def test_all_are_registered():
    names = set(driver.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
