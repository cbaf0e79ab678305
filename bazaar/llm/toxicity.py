"""Toxicity by class-conditional Kneser-Ney models.

Two character models, of toxic and of ordinary documents, back off to low-order
counts that both share, so rare expressions are smoothed alike in both. A text's feature is the
difference of the two length-normalised log-likelihoods; a logistic curve
fitted on held-back labelled documents turns it into a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import fold, materialize
from bazaar.llm.kneser_ney import Model, WordScores, build, collect_counts, count_ngrams, score_rows, words_of
from bazaar.llm.language_id import sampled

ORDER = 5
SHARED = 2              # orders whose counts both classes share
SAMPLE = 2500           # labelled documents per class, expected: 3/4 for the counts, 1/4 for the curve
_COUNTS = 0.75


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(class, text, part) of a bounded hash sample of the labelled documents.

    A document with several labels is toxic if any says so; rows without a label,
    an id or a text teach nothing.
    """
    marks = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("class")).where("class in (0, 1)")
             .where(fold("doc_id", 5) != 0))
    sizes = {r["class"]: (r["count"], sample) for r in marks.groupBy("class").count().collect()}
    if len(sizes) < 2:
        return None
    picked = sampled(marks, "class", sizes, seed=3)     # bounded: about 2 x sample rows
    return docs.where("text is not null").select("doc_id", "text").join(
        F.broadcast(picked.select("doc_id", "class", "part")), "doc_id").select("class", "text", "part")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (slope per column, intercept) of a class-balanced logistic regression."""
    a = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * w
        hess = (a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def features(docs: DataFrame, model: Model, weights: np.ndarray | None, keep: list[str], prefix: str = "") -> DataFrame:
    """The ``keep`` columns of whole rows, and margin and score of their texts (named with ``prefix``)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    def rate(scores: WordScores, texts: list[str | None]) -> list[tuple]:
        weights, out = shared.value[1], []
        for rows in scores.rows([words_of(t) for t in texts]):
            margin = 0.0
            if len(rows):
                s = scores.scores[rows].sum(0, dtype=np.float64)
                margin = float((s[1] - s[0]) / len(rows))
            x = 0.0 if weights is None else margin * weights[0] + weights[1]
            out.append((margin, float(1 / (1 + np.exp(-np.clip(x, -700, 700))))))
        return out
    return score_rows(docs, keep, "margin double, score double", (pa.float64(), pa.float64()),
                      lambda: WordScores(shared.value[0]), rate, prefix)


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER, sample: int = SAMPLE):
    """(model, weights), or None where a class has no labelled document."""
    picked = training_sample(docs, labels, sample)
    if picked is None:
        return None
    picked = materialize(picked, "toxicity-sample")
    counts = collect_counts(count_ngrams(picked.where(F.col("part") < _COUNTS), order))
    if len(np.unique(counts["class"])) < 2:
        return None
    model = build(counts, [0, 1], order, SHARED)
    held = features(picked.where(F.col("part") >= _COUNTS), model, None, ["class"]).toArrow()
    margin, y = held.column("margin").to_numpy(), held.column("class").to_numpy()
    if len(set(y.tolist())) < 2:       # too few rows to hold any back
        return model, np.array([40.0, -4.0])
    scale = np.abs(margin).max() or 1.0
    w = logistic(margin[:, None] / scale, y, ridge=1e-5)
    return model, np.array([max(w[0], 0.0) / scale, w[1]])


def toxicity(docs: DataFrame, labels: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, margin.

    Learns from the labels of the rows whose crc32(doc_id as text) mod 5 is not 0, of
    these from a hash sample of about ``sample`` documents per class. margin is
    the difference of the mean log10-likelihoods per word (toxic less ordinary),
    score its logistic value, predicted 1 where score >= 0.5.

    NULL texts, and texts without a letter, have margin 0 and the score of that. Where a
    class has no labelled document, every score is 0. Repeated rows are scored each; other
    columns, labels included, are no input of a score.
    """
    docs = docs.select("doc_id", "text")
    trained = train(docs, labels, order, sample)
    if trained is None:
        out = docs.select("doc_id", F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"))
    else:
        out = features(docs, *trained, ["doc_id"])
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "margin")


def ordinary_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text is not predicted toxic, unchanged; all of them where nothing could be learned."""
    trained = train(docs.select("doc_id", "text"), labels)
    if trained is None:
        return docs
    return features(docs, *trained, docs.columns, "_tox_").where("_tox_score < 0.5").select(*[f"`{c}`" for c in docs.columns])
