"""Language identification by interpolated Kneser-Ney character models.

One model per language, trained on a bounded sample of the labelled documents;
a text gets the language of the lowest cross-entropy per symbol. A text whose best
cross-entropy is beyond what held-back training texts show is rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import fold, materialize
from bazaar.llm.kneser_ney import Model, WordScores, build, collect_counts, count_ngrams, score_rows, words_of

ORDER = 5
SAMPLE = 400            # documents per language for the counts, expected
CALIBRATION = 200       # further documents per language for the rejection bound, expected
MARGIN = 1.75           # times the worst calibration cross-entropy; random letters lie beyond
SHORT = 20              # texts of fewer symbols are never rejected for their cross-entropy
UNKNOWN = "und"
_MODULUS = 1 << 30


def sampled(rows: DataFrame, key: str, sizes: dict, seed: int = 0) -> DataFrame:
    """Rows (key, doc_id, text) of a bounded sample, and ``part`` in [0, 1).

    A document is taken when the hash of its id falls below its class's rate, so
    the sample has ``sizes[class][1]`` documents at most in expectation.
    """
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(_MODULUS)) / _MODULUS
    rate = F.lit(None)
    for c, (count, want) in sizes.items():
        rate = F.when(F.col(key) == c, min(1.0, want / max(1, count))).otherwise(rate)
    rows = rows.withColumn("draw", draw).withColumn("rate", rate).where("draw < rate")
    return rows.withColumn("part", F.col("draw") / F.col("rate"))


def train(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE,
          calibration: int = CALIBRATION) -> tuple[Model, float] | None:
    """(model, rejection bound) from doc_id, text and lang; rows without
    lang or letters teach nothing. None without any label."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counted = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counted:
        return None
    langs = sorted(counted)
    total = sample + calibration
    picked = sampled(rows, "lang", {c: (n, total) for c, n in counted.items()})
    code = F.coalesce(*[F.when(F.col("lang") == c, i) for i, c in enumerate(langs)])
    picked = materialize(picked.select(code.alias("class"), "text", "part"), "language-sample")
    share = sample / total
    counts = collect_counts(count_ngrams(picked.where(F.col("part") < share), order))
    if not len(counts["n"]):
        return None
    model = build(counts, langs, order)
    held = score(picked.where(F.col("part") >= share), model, math.inf, [])
    worst = held.where(F.col("symbols") >= SHORT).agg(F.max("entropy")).first()[0]
    return model, MARGIN * worst if worst is not None else math.inf


RESULT = "lang_pred string, score double, entropy double, symbols long, accepted boolean"


def score(docs: DataFrame, model: Model, bound: float, keep: list[str], prefix: str = "") -> DataFrame:
    """The ``keep`` columns of whole rows, and lang_pred, score, entropy, symbols and accepted
    of their texts (named with ``prefix``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())

    def rate(scores: WordScores, texts: list[str | None]) -> list[tuple]:
        words, out, langs = [words_of(t) for t in texts], [], shared.value.classes
        for ws, rows in zip(words, scores.rows(words)):
            if not ws:
                out.append((UNKNOWN, 0.0, None, 0, False))
                continue
            n = sum(map(len, ws)) + len(ws)
            entropy = -scores.scores[rows].sum(0, dtype=np.float64) / n
            best = int(entropy.argmin())
            # posterior of equal priors; the evidence counts as that of 40 symbols at most
            gap = (entropy - entropy[best]) * min(n, 40)
            p = float(1 / (10.0 ** -gap).sum())
            out.append((langs[best], p, float(entropy[best]), n, n < SHORT or bool(entropy[best] <= bound)))
        return out
    return score_rows(docs, keep, RESULT, types, lambda: WordScores(shared.value), rate, prefix)


def language_id(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE,
                calibration: int = CALIBRATION) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, accepted, entropy, symbols.

    Learns from text and lang of the documents whose crc32(doc_id as text) mod 4 is not
    2: of these, a hash sample of about ``sample`` documents per language for the
    counts and ``calibration`` for the rejection bound. Every whole text is scored.

    NULL texts and texts without a letter are ``und`` with score 0, not accepted.
    score is the probability of the language among the learned ones; accepted is
    false where even the best language's cross-entropy is beyond the bound. Without any
    label every text is ``und``. Ties go to the first language by name. Repeated
    rows are scored each; other columns are ignored.
    """
    docs = docs.select("doc_id", "text", "lang")
    trained = train_on(docs, order, sample, calibration)
    if trained is None:
        out = docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                          F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("long").alias("symbols"),
                          F.lit(False).alias("accepted"))
    else:
        out = score(docs, *trained, ["doc_id"])
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score",
                      "accepted", "entropy", "symbols")


def train_on(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE, calibration: int = CALIBRATION):
    """:func:`train` on the learning fold of a documents table."""
    return train(docs.select("doc_id", "text", "lang").where(fold("doc_id", 4) != 2), order, sample, calibration)


def accepted_rows(docs: DataFrame) -> DataFrame:
    """The rows whose text has an accepted language, unchanged. Without any label nothing is known
    about languages, and every row stays."""
    trained = train_on(docs)
    if trained is None:
        return docs
    return score(docs, *trained, docs.columns, "_lid_").where("_lid_accepted").select(*[f"`{c}`" for c in docs.columns])
