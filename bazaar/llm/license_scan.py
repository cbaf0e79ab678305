"""License scan with ordered signature rules (DataFrame expressions only).

Texts are normalised to lower-case words with single spaces. A text with none of the
gate words is done. Else the rules whose keyword occurs are matched; every match
is an interval of words. An interval inside another one of an equal or
stronger tier is suppressed; what remains gives labels and score. All of it is a
projection of each row: nothing is shuffled, and a very long text costs in proportion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.license_rules import GATES, Rule, rules

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"      # before lower-casing: A-Z are word characters
_TIERS = 5
_BLOCK = 64         # elements appended to one array before it is closed
_DETECTION = "array<struct<start:int,end:int,tier:int,rule:int,label:string,confidence:double,base:boolean>>"


def rule_table(table: list[Rule]) -> Column:
    """The rules as one constant array."""
    return F.array(*[F.struct(
        F.lit(r.keyword).alias("keyword"), F.lit(f"(?<![^ ])(?:{r.pattern})(?![^ ])").alias("pattern"),
        F.lit(r.label).alias("label"), F.lit(r.tier).alias("tier"), F.lit(i).alias("rule"),
        F.lit(r.confidence).alias("confidence"), F.lit(r.base).alias("base")) for i, r in enumerate(table)])


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" ")))


def _running(items: Column, zero: Column, advance: Callable[[Column, Column], Column],
             emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """``emit(state before, item)`` of every item, as arrays of ``kind``, joined; ``advance`` moves the state.

    An array that grows in an aggregate is copied with every element. Here only the states at
    the blocks' starts and the inside of a block grow, so the copies stay short.
    """
    def cut(all_items: Column) -> Column:
        return F.when(F.size(all_items) == 0, F.slice(F.array(all_items), 1, F.lit(0))).otherwise(F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(all_items, b * _BLOCK + 1, F.lit(_BLOCK))))

    def starts(blocks: Column) -> Column:
        return F.aggregate(
            blocks, F.struct(zero.alias("state"), F.slice(F.array(zero), 1, F.lit(0)).alias("starts")),
            lambda acc, block: F.struct(F.aggregate(block, acc["state"], advance).alias("state"),
                                        F.concat(acc["starts"], F.array(acc["state"])).alias("starts")),
            lambda acc: acc["starts"])

    def inside(block: Column, start: Column) -> Column:
        return F.aggregate(
            block, F.struct(start.alias("state"), F.array().cast(kind).alias("out")),
            lambda acc, item: F.struct(advance(acc["state"], item).alias("state"),
                                       F.concat(acc["out"], emit(acc["state"], item)).alias("out")),
            lambda acc: acc["out"])
    return _let(_let(items, cut), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), inside)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside a lambda an expression runs again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _detections(words: Column, rule: Column) -> Column:
    """The matches of one rule as word intervals [start, end]."""
    pairs = F.zip_with(
        F.regexp_extract_all(words, rule["pattern"], F.lit(0)), F.split(words, rule["pattern"]),
        lambda hit, gap: F.struct(_spaces(gap).cast("int").alias("gap"), _spaces(hit).cast("int").alias("size")))
    pairs = F.filter(pairs, lambda p: p["size"].isNotNull())       # what follows the last match

    def found(spaces: Column, pair: Column) -> Column:
        start = spaces + pair["gap"] - 1        # word positions: the spaces before a match, less the leading one
        return F.array(F.struct(
            start.alias("start"), (start + pair["size"]).alias("end"), rule["tier"].alias("tier"), rule["rule"].alias("rule"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence"), rule["base"].alias("base")))
    return _running(pairs, F.lit(0), lambda spaces, pair: spaces + pair["gap"] + pair["size"], found, _DETECTION)


def _unsuppressed(found: Column) -> Column:
    """Without the intervals that lie inside another one of an equal or stronger tier.

    In the order (start, longest first, tier, rule) an interval is inside an earlier one
    exactly when that one's end is not smaller; the furthest end per tier is enough.
    """
    order = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), d["tier"].alias("tier"), d["rule"].alias("rule"),
        d["label"].alias("label"), d["confidence"].alias("confidence"))))
    kept = "array<struct<label:string,confidence:double>>"

    def furthest(ends: Column, d: Column) -> Column:
        return F.transform(ends, lambda e, t: F.when(t >= d["tier"] - 1, F.greatest(e, -d["back"])).otherwise(e))

    def outside(ends: Column, d: Column) -> Column:
        one = F.array(F.struct(d["label"].alias("label"), d["confidence"].alias("confidence")))
        return F.when(F.get(ends, d["tier"] - 1) >= -d["back"], F.array().cast(kept)).otherwise(one)
    return _running(order, F.array(*[F.lit(-1)] * _TIERS), furthest, outside, kept)


def license_scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_kept.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. The base
    columns count all places of the contract's phrases; first_word and last_word are
    the smallest and largest start (NULL without any). labels adds the labels of the
    detections that stay (n_kept); score is the strongest confidence among them, else 0.
    NULL and empty texts have 0 words, no labels ('') and score 0. Repeated rows
    are scanned each; other columns are ignored.
    """
    table = rules() if table is None else table
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.trim(F.regexp_replace(text, _SEPARATORS, " ")).alias("words"))
    rows = rows.select(
        "doc_id", F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1).cast("long").alias("n_words"),
        F.concat(F.lit(" "), F.lower("words"), F.lit(" ")).alias("words"))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains(F.col("words"), F.lit(g))
    live = F.filter(rule_table(table), lambda r: F.contains(F.col("words"), r["keyword"]))
    found = F.flatten(F.transform(live, lambda r: _detections(F.col("words"), r)))
    rows = rows.select("doc_id", "n_words", F.when(gate, found).otherwise(F.array().cast(_DETECTION)).alias("found"))
    rows = rows.select("doc_id", "n_words", F.filter("found", lambda d: d["base"]).alias("base"),
                       _unsuppressed(F.col("found")).alias("kept"))
    base = F.array_sort(F.array_distinct(F.transform("base", lambda d: d["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(
        F.transform("base", lambda d: d["label"]), F.transform("kept", lambda d: d["label"]))))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda d: d["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda d: d["start"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.size("kept").cast("long").alias("n_kept"))
