"""Exact length histogram of encoded documents.

Documents are aggregated by encoded length first; everything else is computed
from the histogram: suffix sums give, for every length as a context limit, the
documents that do not fit, the tokens kept when longer documents are cut
to the limit, and the quantile that the length is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.bpe import token_lengths
from bazaar.llm.common import materialize

_BLOCK = 256    # lengths per block of the two-level suffix sums


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs, tokens) of a table with a column n_tokens."""
    return (lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))
            .withColumn("tokens", F.col("n_tokens") * F.col("docs")))


def suffix_sums(histogram: DataFrame, block: int = _BLOCK) -> DataFrame:
    """Answers for every length L of the histogram as a context limit.

    Per row: n_tokens (L), docs, tokens; docs_ge and tokens_ge (documents of at
    least L tokens); docs_le (at most L); docs_cut (longer than L); kept_tokens (all
    tokens when longer documents are cut to L); lost_tokens; total_docs and
    total_tokens; quantile (share of documents of at most L tokens).

    The suffix sums run in two levels, so no task sees the whole histogram: inside
    blocks of ``block`` lengths, and over the blocks' totals.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("bd"), F.sum("tokens").alias("bt"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("bd").over(whole).alias("total_docs"), F.sum("bt").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    ge = (rows.withColumn("docs_in", F.sum("docs").over(inside))
          .withColumn("tokens_in", F.sum("tokens").over(inside)).join(blocks, "block"))
    ge = (ge.withColumn("docs_ge", F.col("docs_in") + F.col("docs_after"))
          .withColumn("tokens_ge", F.col("tokens_in") + F.col("tokens_after"))
          .withColumn("docs_cut", F.col("docs_ge") - F.col("docs"))
          .withColumn("docs_le", F.col("total_docs") - F.col("docs_cut"))
          .withColumn("kept_tokens", F.col("total_tokens") - F.col("tokens_ge") + F.col("tokens")
                      + F.col("docs_cut") * F.col("n_tokens")))
    return ge.select("n_tokens", "docs", "tokens", "docs_ge", "tokens_ge", "docs_le", "docs_cut", "kept_tokens",
                     (F.col("total_tokens") - F.col("kept_tokens")).alias("lost_tokens"),
                     "total_docs", "total_tokens", (F.col("docs_le") / F.col("total_docs")).alias("quantile"))


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """One row (docs_cut, kept_tokens, lost_tokens) for any context limit, also
    one that no document has as its length."""
    above = F.col("n_tokens") > limit
    return answers.agg(
        F.coalesce(F.sum(F.when(above, F.col("docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.when(above, F.col("docs") * limit).otherwise(F.col("tokens"))), F.lit(0)).alias("kept_tokens"),
        F.coalesce(F.sum(F.when(above, F.col("tokens") - F.col("docs") * limit)), F.lit(0)).alias("lost_tokens"))


def quantile_length(answers: DataFrame, q: float) -> DataFrame:
    """One row (n_tokens): the smallest length that at least a share ``q`` of the documents does not exceed."""
    return answers.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The answers of :func:`suffix_sums` over the documents' encoded lengths.

    NULL and empty texts have 0 tokens, repeated rows count each, other columns are
    ignored; an empty table gives no rows.
    """
    # written once: the sums read it twice, and the texts are not to be encoded again
    return suffix_sums(materialize(length_histogram(token_lengths(docs, path)), "token-lengths"))
