"""The corpus pipeline: the stages of a training corpus over ``documents``.

Language ID (documents it rejects go), toxicity (documents it rejects go), n-gram Jaccard
join on five-word shingles at a similarity of 0.8 (one document of each group stays), and
packing of what is left. Each stage is written and reread as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm.common import documents, materialize
from bazaar.llm.jaccard_join import one_of_each
from bazaar.llm.language_id import accepted_rows
from bazaar.llm.packing import pack
from bazaar.llm.toxicity import ordinary_rows


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language explains."""
    return accepted_rows(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic by models of the labelled ones among ``docs``."""
    return ordinary_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group of near copies."""
    return one_of_each(docs, ngram=5, percent=80)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into sequences."""
    return pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("packing", pack_sequences),
]

ORACLE_SQL = None   # trained models and tokenization are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
