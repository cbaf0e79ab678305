"""The license scan's base columns against brute force, and its suppression, on texts with many matches."""

import random
import re

from bazaar.llm.license_rules import rules

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute_base(text):
    words = words_of(text)
    starts = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(starts), starts[0][0] if starts else None, starts[-1][0] if starts else None,
            ",".join(sorted({label for _, label in starts})))


def brute_kept(text):
    """Every match of every rule as an interval of words, less those inside another of an equal or stronger tier."""
    words = " ".join(words_of(text))
    found = [(words[:m.start()].count(" "), words[:m.end()].count(" "), r.tier, i, r.label, r.confidence)
             for i, r in enumerate(rules()) if r.keyword in f" {words} " for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", words)]
    found.sort(key=lambda d: (d[0], -d[1], d[2], d[3]))
    return [d for k, d in enumerate(found) if not any(e[1] >= d[1] and e[2] <= d[2] for e in found[:k])]


def test_many_matches(spark):
    from bazaar.llm.license_scan import license_scan
    rng = random.Random(2)
    pieces = ["mit license", "MIT License,", "apache license 2.0", "gnu general public license", "word", "the license", "bsd", "GPL-3.0", "x"]
    texts = [" ".join(rng.choice(pieces) for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 130, 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in license_scan(docs).collect():
        text, kept = texts[r["doc_id"]], brute_kept(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert r["n_kept"] == len(kept)
        assert r["score"] == max((d[5] for d in kept), default=0.0)
        assert set(filter(None, r["labels"].split(","))) == {d[4] for d in kept} | set(filter(None, brute_base(text)[4].split(",")))


def test_base_columns_of_the_documents(spark):
    from bazaar.llm.queries import queries
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries()["op2_license_scan"](spark, sf).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(texts[r["doc_id"]])
