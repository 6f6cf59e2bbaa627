import numpy as np

from pricelane.llm import toxicity_ordinal as tox
from test_llm_helpers import ODD, docs


def test_thresholds_are_ordered_and_weights_find_the_words():
    rng = np.random.default_rng(1)
    common, bad = [f"word{i}" for i in range(300)], ["aaargh", "brrrgh", "crrrgh"]
    texts, grades = [], []
    for k in range(600):
        grade = k % 4
        picked = list(rng.choice(common, 40)) + list(rng.choice(bad, grade, replace=False))
        texts.append(" ".join(picked))
        grades.append(grade)
    features, toxic = [np.unique(tox.text_features(t)) for t in texts], np.array(grades) > 0
    names, at = np.unique(np.concatenate(features), return_inverse=True)
    row = np.repeat(np.arange(len(texts)), [len(f) for f in features])
    counts = tox.Counts(len(texts), int(toxic.sum()), names, np.bincount(at[~toxic[row]], minlength=len(names)), np.bincount(at[toxic[row]], minlength=len(names)))
    wanted = names[counts.wanted()]
    model = tox.fit_ordinal([f[np.isin(f, wanted)] for f in features], np.array(grades))
    assert (np.diff(model.thresholds) > 0).all()
    scores = tox.text_scores(texts, model)
    over = tox.above(scores, model.thresholds)
    assert (over.sum(axis=1).round() == grades).mean() > 0.97


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = tox.keyed_text(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = tox.train(rows, labels.where("doc_id % 2 = 0"))
    held = tox.score_rows(rows, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    caught = [r["p_toxic"] >= tox.TOXIC_FROM for r in held if r["toxic"]]
    wrong = [r["p_toxic"] >= tox.TOXIC_FROM for r in held if not r["toxic"]]
    assert np.mean(caught) > 0.6  # some forty toxic rows to learn from
    assert np.mean(wrong) < 0.05


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, None), (None, 1), (77, 0)], "doc_id long, toxic int")
    model = tox.train(docs(spark, ODD), labels)
    assert not model.weights
    got = tox.score_rows(docs(spark, ODD), model).collect()
    assert len(got) == len(ODD) and {r["grade"] for r in got} == {0}
    kept = tox.without_toxic(docs(spark, ODD), model)
    assert kept.count() == len(ODD) and kept.columns == docs(spark, ODD).columns
    assert tox.score_rows(docs(spark, ODD).limit(0), model).count() == 0
    assert not tox.train(docs(spark, ODD).limit(0), labels.limit(0)).weights
