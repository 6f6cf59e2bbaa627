"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = logistic(threshold_k - score). One weight per feature serves all thresholds, which are
kept in order. Features are the distinct words of a text (letters only, lower case) and their first
four to six letters, as far as they pass a chi-square screen. The fit takes accelerated proximal steps
with an L1 penalty, so most weights are exactly 0 and long clean texts do not drift. It runs on a bounded
sample of labelled rows, whose features Spark counts and screens before the driver gets any; scoring reads all
rows and shuffles nothing.

Labels say toxic or not. Grades 1 to 3 of toxic rows come from the number of their features that the
sample holds nearly only in toxic rows, cut at its terciles over the toxic rows of the sample.

Defined results: a null or empty text has the score 0 of a text without features; a text of any length is
read whole; repeated rows get equal results; labels without a document, or with a null, are left out;
without labels of both kinds nothing is toxic; only the key and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import documents, keyed_text, map_slices, slices, stored, table, tidy, worker_cache

#: Labelled rows of each kind that the fit sees, about; rows are chosen by the hash of their key.
SAMPLE_ROWS = 3000
#: Chi-square of a feature's presence against toxic or not, from which the fit uses it.
MIN_CHI_SQUARE = 15.0
#: Log of how much more often toxic rows hold a feature, from which it marks them.
MARK_FROM = 3
GRADES = 4
#: Probability of any toxicity from which a text counts as toxic.
TOXIC_FROM = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 300_000


class OrdinalModel(NamedTuple):
    weights: dict[int, float]  # of features, not zero
    thresholds: np.ndarray  # ascending, one less than grades


def word_features(word: str) -> list[int]:
    """Numbers (32 bits) of a lower-case word and of its beginnings."""
    parts = ["w" + word, *(f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return [zlib.crc32(p.encode()) for p in parts]


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def text_features(text: str) -> np.ndarray:
    found = [b for w in words(text) for b in word_features(w)]
    return np.array(found, np.int64)


def above(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each row and threshold."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - scores[:, None], -30, 30)))


def fit_ordinal(
    features: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, rounds: int = 600, penalty: float = 2e-4
) -> OrdinalModel:
    """Weights and thresholds of least penalised loss over rows of features.

    Accelerated proximal gradient steps; parameters are the weights, the first threshold and the gaps
    to the next ones, which stay positive.
    """
    n, k = len(features), n_grades - 1
    used, at = np.unique(np.concatenate([*features, np.zeros(1, np.int64)]), return_inverse=True)
    at, m = at[:-1], len(used)
    row = np.repeat(np.arange(n), [len(f) for f in features])
    y, rows = grades.astype(int), np.arange(n)

    vector = np.ones(m)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        vector = np.bincount(at, np.bincount(row, vector[at], minlength=n)[row], minlength=m)
        size = np.linalg.norm(vector) or 1.0
        vector /= size
    step = 1 / (0.5 * (size / n + k))

    def slopes(point: np.ndarray) -> np.ndarray:
        scores = np.bincount(row, point[:m][at], minlength=n)
        below = np.column_stack([np.zeros(n), 1 - above(scores, np.cumsum(point[m:])), np.ones(n)])
        upper, lower = below[rows, y + 1], below[rows, y]
        by_score = 1 - upper - lower
        share = np.maximum(upper - lower, 1e-9)
        by_threshold = np.bincount(y + 1, -upper * (1 - upper) / share, minlength=k + 2)
        by_threshold += np.bincount(y, lower * (1 - lower) / share, minlength=k + 2)
        by_gap = np.cumsum(by_threshold[1:-1][::-1])[::-1]
        return np.concatenate([np.bincount(at, by_score[row], minlength=m), by_gap]) / n

    here = ahead = np.concatenate([np.zeros(m), np.ones(k)])
    pace = 1.0
    for _ in range(rounds):
        new = ahead - step * slopes(ahead)
        new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * penalty, 0)
        new[m + 1 :] = np.maximum(new[m + 1 :], 0.05)
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / after * (new - here)
        here, pace = new, after
    weights = {int(f): float(w) for f, w in zip(used, here[:m]) if w}
    return OrdinalModel(weights, np.cumsum(here[m:]))


class Counts(NamedTuple):
    """How many sampled rows of each kind hold which feature, for features that the fit or the grades need."""

    n: int
    n_bad: int
    names: np.ndarray  # ascending
    clean: np.ndarray
    bad: np.ndarray

    def wanted(self, least: float = MIN_CHI_SQUARE) -> np.ndarray:
        """Which features depend on the kind of row."""
        return chi_square(float(self.n), float(self.n_bad), self.clean.astype(float), self.bad.astype(float)) >= least

    def marks(self) -> np.ndarray:
        """Which features the sample holds nearly only in toxic rows."""
        return np.log((self.bad + 0.5) / self.n_bad) - np.log((self.clean + 0.5) / (self.n - self.n_bad)) > MARK_FROM


def chi_square(n, n_bad, clean, bad):
    """Of a feature's presence against the kind of row; for numbers, arrays or columns."""
    have = clean + bad
    gap = bad * n - have * n_bad
    return n * gap * gap / (have * (n - have) * (n_bad * (n - n_bad)) + 1e-9)


def toxic_grades(features: list[np.ndarray], toxic: np.ndarray, counts: Counts, n_grades: int = GRADES) -> np.ndarray:
    """Grade 0 for clean rows; 1 and up for toxic rows by the number of features that mark toxic rows."""
    marks = counts.names[counts.marks()]
    found = np.array([np.isin(f, marks).sum() for f in features])
    bounds = np.quantile(found[toxic], np.arange(1, n_grades - 1) / (n_grades - 1))
    return np.where(toxic, 1 + np.searchsorted(bounds, found, side="left"), 0)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_of_each: int = SAMPLE_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``toxic, features`` of about ``rows_of_each`` labelled rows of each kind; labelled keys of each kind.

    A key with several labels counts as toxic if one of them says so.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.lit(False), 1.0)
    for kind, size in sizes.items():
        share = share.when(F.col("toxic") == kind, min(1.0, rows_of_each / size))
    draw = (F.xxhash64(F.lit("sample"), "doc_id") / F.lit(2.0**64)) + 0.5
    chosen = known.where(draw <= share)  # about 2 * rows_of_each rows, whatever the input
    rows = keyed_text(docs).join(F.broadcast(chosen), "doc_id")

    def work(batch: pa.RecordBatch) -> dict:
        return {"toxic": batch.column("toxic"), "features": pa.array([np.unique(text_features(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.int64()))}

    return map_slices(rows.select("toxic", "text"), work, "toxic int, features array<long>"), sizes


def screened(rows: DataFrame, n: int, n_bad: int) -> Counts:
    """Counts of the features that pass the screen or mark toxic rows; Spark counts, the driver gets what passes."""
    counts = rows.select("toxic", F.explode("features").alias("name")).groupBy("name").agg(
        F.sum("toxic").cast("double").alias("bad"), F.sum(1 - F.col("toxic")).cast("double").alias("clean")
    )
    apart = F.log((F.col("bad") + 0.5) / n_bad) - F.log((F.col("clean") + 0.5) / (n - n_bad))
    near = (chi_square(F.lit(float(n)), F.lit(float(n_bad)), F.col("clean"), F.col("bad")) >= 0.999 * MIN_CHI_SQUARE) | (apart > 0.999 * MARK_FROM)
    found = counts.where(near).orderBy("name").toArrow()  # the bounds themselves are held in one place, here
    return Counts(n, n_bad, *(found.column(c).to_numpy() for c in ("name", "clean", "bad")))


def train(docs: DataFrame, labels: DataFrame, rows_of_each: int = SAMPLE_ROWS) -> OrdinalModel:
    """The model of a bounded sample; the driver holds the sample's screened features only.

    The sample takes clean rows more thinly, so all thresholds are moved by what that did to the odds.
    """
    rows, sizes = labelled_sample(docs, labels, rows_of_each)
    rows = stored(rows, "labelled")
    n_of = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n_of.get(0) or not n_of.get(1):
        return OrdinalModel({}, np.full(GRADES - 1, 30.0))
    counts = screened(rows, n_of[0] + n_of[1], n_of[1])
    names = counts.names

    def work(batch: pa.RecordBatch) -> dict:
        return {"toxic": batch.column("toxic"), "features": pa.array([f[np.isin(f, names)] for f in batch.column("features").to_numpy(zero_copy_only=False)], pa.list_(pa.int64()))}

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(work(batch))

    sample = rows.mapInArrow(tidy(run), "toxic int, features array<long>").toArrow()
    toxic = np.array(sample.column("toxic").to_pylist(), bool)
    features = [np.asarray(f, np.int64) for f in sample.column("features").to_pylist()]
    order = np.lexsort(([zlib.crc32(f.tobytes()) for f in features], toxic))  # not the order of arrival
    features, toxic = [features[i] for i in order], toxic[order]
    wanted = names[counts.wanted()]
    weights, thresholds = fit_ordinal([f[np.isin(f, wanted)] for f in features], toxic_grades(features, toxic, counts))
    thinned = np.log(sizes[0] / sizes[1]) - np.log((~toxic).sum() / toxic.sum())
    return OrdinalModel(weights, thresholds + max(0.0, float(thinned)))


def text_scores(texts: list[str], model: OrdinalModel) -> np.ndarray:
    """The score of each text: the weights of its features."""
    kept = worker_cache("toxicity")
    if kept.get("of") is not model.weights or len(kept["words"]) > _CACHED_WORDS:
        kept["of"], kept["words"] = model.weights, {}
    known: dict[str, tuple] = kept["words"]
    scores = []
    for text in texts:
        active: set[int] = set()
        for w in words(text):
            found = known.get(w)
            if found is None:
                found = known[w] = tuple(f for f in word_features(w) if f in model.weights)
            active.update(found)
        scores.append(sum(model.weights[f] for f in sorted(active)))  # one order of addition
    return np.array(scores, float)


def score_rows(df: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, severity, grade, p_toxic``; severity is the expected grade, grade the most likely one."""
    rows = keyed_text(df, key, text)
    shared = rows.sparkSession.sparkContext.broadcast(tuple(model))  # plain parts: features of the bounded sample at most

    def work(batch: pa.RecordBatch) -> dict:
        own = OrdinalModel(*shared.value)
        scores = text_scores(batch.column("text").to_pylist(), own)
        over = above(scores, own.thresholds)
        shares = -np.diff(np.column_stack([np.ones(len(scores)), over, np.zeros(len(scores))]), axis=1)
        return {
            "doc_id": batch.column("doc_id"), "score": pa.array(scores), "severity": pa.array(over.sum(axis=1)),
            "grade": pa.array(shares.argmax(axis=1).astype(np.int32)), "p_toxic": pa.array(over[:, 0]),
        }

    kind = dict(rows.dtypes)["doc_id"]
    return map_slices(rows, work, f"doc_id {kind}, score double, severity double, grade int, p_toxic double")


def without_toxic(df: DataFrame, model: OrdinalModel, text: str = "text", toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The rows of ``df`` whose text is not toxic, with all their columns; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        own = OrdinalModel(*shared.value)
        for piece in (p for batch in batches for p in slices(batch, text=text)):
            scores = text_scores([t or "" for t in piece.column(text).to_pylist()], own)
            clean = above(scores, own.thresholds)[:, 0] < toxic_from
            if clean.any():
                yield piece.filter(pa.array(clean))

    return df.mapInArrow(tidy(run), df.schema)


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected severity, most likely grade and whether it is toxic at all."""
    docs = documents(spark, sf_dir)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_rows(docs, model).select(
        "doc_id", F.round("severity", 6).alias("expected_severity"), "grade",
        (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"), (F.col("p_toxic") < TOXIC_FROM).alias("kept"),
    )
