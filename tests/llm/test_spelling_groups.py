"""Spelling groups against brute force: counts, neighbours of one edit, forms, roots, awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np
from conftest_data import TEXTS


def brute_counts(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(counts):
    forms, rows = {}, []
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        rows.append((w, n, len(found)))
    out = []
    for w, n, k in rows:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, k, counts[forms[w]] if forms[w] else None))
    return out


COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def test_documents(spark, docs, empty):
    from bazaar.llm.spelling_groups import spelling_groups, word_counts
    rows = [(i, t) for i, t, _ in TEXTS] * 3
    many = docs.unionByName(docs).unionByName(docs)
    assert {r["word"]: r["n"] for r in word_counts(many).collect()} == brute_counts(rows)
    got = spelling_groups(many)
    assert got.columns == COLS
    assert key(got.collect()) == key(brute_groups(brute_counts(rows)))
    assert spelling_groups(empty).collect() == []


def test_deletions(spark):
    from bazaar.llm.spelling_groups import word_counts
    rows = [(i, f"word{'abcdefghij'[i % 10]} Straße ÉTUDE ×÷ÿÀzz {'q' * (5 + i % 3)}") for i in range(900)]
    got = word_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    want = brute_counts(rows)
    assert any(w not in ("qqqqq", "qqqqqq", "qqqqqqq") and len(w) == 5 for w in want)     # a deletion that is counted
    assert {r["word"]: r["n"] for r in got.collect()} == want


def test_neighbours_of_random_words(spark):
    from bazaar.llm.spelling_groups import near_words
    rng = np.random.default_rng(3)
    words = {}
    for length in (5, 6, 9, 10, 11, 19, 24):
        stems = ["".join(rng.choice(list("abéÿ"), length)) for _ in range(6)]
        for stem in stems:
            for _ in range(14):
                w = list(stem)
                for _ in range(rng.integers(0, 3)):
                    i = int(rng.integers(0, len(w)))
                    match rng.integers(0, 3):
                        case 0: w[i] = str(rng.choice(list("abzÀ")))
                        case 1: w.insert(i, w[i])
                        case _: del w[i]
                if len(w) >= 5:
                    words["".join(w)] = int(2 ** rng.integers(2, 9) + rng.integers(0, 3))
    words |= {"a" * 3000 + "b": 9, "a" * 3001: 3, "a" * 3002 + "b": 40, "b" + "a" * 3000: 3, "c" * 12 + "x" * 12: 4, "c" * 12 + "y" * 12: 4}
    got = near_words(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5))
    want = brute_groups(words)
    assert max(k for *_, k, _ in want) > 5 and any(r[1] and r[2] != r[1] for r in want)
    assert key(got.collect()) == key(want)


def test_group_cut_by_batches(spark):
    from bazaar.llm.spelling_groups import near_words
    words = {a + "ords": 3 + i for i, a in enumerate("abcdefghijklmnopqrstuvwxyzàé")} | {"words" + a: 3 for a in "abcxyz"}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert key(got) == key(brute_groups(words))
