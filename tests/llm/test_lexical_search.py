"""Ranked lexical search against a brute-force version, on awkward rows, blocks and empty tables."""

import math
import re
from collections import Counter

from conftest_data import TEXTS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = [(0, "alpha BETA phi"), (1, "two one"), (2, "the word and x"), (3, None), (4, " ,;"), (1, "two one"),
         (5, "漢字 é\x85 ünï Apache"), (6, "zeta zeta"), (None, "gnu 2 0")]


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    big_n = sum(1 for _, c in tf if c)
    big_l = sum(c.total() for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in tf:
            score = 0
            for w in set(terms(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1)))
                m = 100 - 50 + (50 * c.total() * big_n) // big_l
                score += weight * ((10 ** 9 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:k])]
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "item_id long, text string, score string, rank int")


def test_equals_brute_force(spark, docs):
    from bazaar.llm.lexical_search import rank_documents
    rows = [(i, t) for i, t, _ in TEXTS]
    for k, bound in ((50, 200_000), (2, 200_000), (3, 4)):
        got = rank_documents(docs, frame(spark, ITEMS), k, bound)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert key([tuple(r) for r in got.collect()]) == key(brute(rows, ITEMS, k))


def test_ties_and_cuts_inside_a_task(spark, monkeypatch):
    from bazaar.llm import lexical_search as S
    monkeypatch.setattr(S, "_HELD", 10)
    monkeypatch.setattr(S, "_CELLS", 30)
    rows = [(i, ("needle " if i % 3 else "needle hay ") * (1 + i % 4) + "filler " * (i % 7)) for i in range(200, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(7, "needle"), (8, "hay needle"), (9, "absent")]
    # monkeypatched limits do not reach worker processes, so the class is driven here as well
    got = S.rank_documents(docs, frame(spark, items), 5).collect()
    assert key([tuple(r) for r in got]) == key(brute(rows, items, 5))
    best = S._Best(2, 3)
    import numpy as np
    rng = np.random.default_rng(1)
    item, score, doc = rng.integers(0, 2, 400), rng.integers(1, 9, 400), np.arange(400)
    for a in range(0, 400, 20):
        best.add(item[a:a + 20], score[a:a + 20], doc[a:a + 20])
        if a % 60 == 0:
            best.cut()
    want = sorted(zip(item.tolist(), (-score).tolist(), doc.tolist()))
    want = [r for i in (0, 1) for r in [x for x in want if x[0] == i][:3]]
    assert [(int(i), -int(s), int(d)) for i, s, d in best.cut().T] == want


def test_blocks_hold_bounded_pairs(spark):
    from bazaar.llm import lexical_search as S
    pairs = S.item_terms(frame(spark, ITEMS).select("item_id", "text"))
    blocks = S._blocks(pairs, 4)
    sizes = [b.groupBy("item_no").count().collect() for b in blocks]
    assert sum(r["count"] for b in sizes for r in b) == pairs.count()
    assert all(len(b) <= 1 or sum(r["count"] for r in b) <= 4 for b in sizes)


def test_empty_tables(spark, docs, empty):
    from bazaar.llm.lexical_search import rank_documents
    none = frame(spark, [])
    for d, i in ((empty, frame(spark, ITEMS)), (docs, none), (empty, none), (docs, frame(spark, [(1, None)]))):
        got = rank_documents(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []
