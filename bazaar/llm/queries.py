"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm.common import documents

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


JACCARD_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when coalesce(len(w), 0) = 0 then []
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) end) as s
  from words),
items as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as k
  from items a join items b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs where 100 * k >= 85 * (na + nb - k)),
reach(doc_id, r) as (
  select doc_id, doc_id from sets
  union
  select l.a, reach.r from reach join links l on l.b = reach.doc_id)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id, coalesce(d.n, 0)::bigint as n_links
from sets s
join (select doc_id, min(r) as component_id from reach group by 1) c using (doc_id)
left join (select a as doc_id, count(*) as n from links group by 1) d using (doc_id)
"""


@_query("op1_jaccard_join", JACCARD_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.jaccard_join import jaccard_join
    return jaccard_join(documents(spark, sf_dir))


@_query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.bpe import encode_digests
    return encode_digests(documents(spark, sf_dir))


@_query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.token_counts import token_counts
    return token_counts(documents(spark, sf_dir))


@_query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.packing import pack
    return pack(documents(spark, sf_dir))


@_query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.language_id import language_id
    return language_id(documents(spark, sf_dir))


@_query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.toxicity import toxicity
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.license_scan import license_scan
    return license_scan(documents(spark, sf_dir))


@_query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.fingerprints import fingerprints
    return fingerprints(documents(spark, sf_dir))


@_query("op7_hpy_model")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.hpy_model import score_corpus
    return score_corpus(documents(spark, sf_dir))


HAMMING_SQL = """
with codes as (
  select vec_id, list_transform(embedding, lambda x: x > 0) as b from embeddings),
pairs as (
  select q.vec_id as query_id, c.vec_id as neighbor_id,
    len(list_filter(list_zip(q.b, c.b), lambda p: p[1] <> p[2]))::int as distance
  from codes q, codes c where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by distance, neighbor_id)::int as rank from pairs)
select query_id, rank, neighbor_id, distance from ranked where rank <= 10
"""


@_query("op4_hamming_search", HAMMING_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.hamming_search import embedding_top_k
    return embedding_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SEARCH_SQL = r"""
with doc as (
  select doc_id, row_number() over () as r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents where text is not null),
corpus as (select count(*)::bigint as cn, sum(len(t))::bigint as cl from doc where len(t) > 0),
tf as (select r, doc_id, n, t, count(*)::bigint as tf
  from (select r, doc_id, len(t)::bigint as n, unnest(t) as t from doc) group by all),
item as (select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
  from benchmark),
weight as (select t, floor(1000 * ln((2 * cn + 2) / (2 * count(*) + 1)))::bigint as w
  from tf, corpus group by t, cn),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * cn) // cl)))))::bigint as score
  from item join tf using (t) join weight using (t), corpus group by item_id, doc_id, r)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 50
"""


@_query("op13_lexical_search", SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.lexical_search import rank_documents
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query("op12_spelling_groups")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.spelling_groups import spelling_groups
    return spelling_groups(documents(spark, sf_dir))


@_query("op11_html_text")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bazaar.llm.html_text import extract
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
