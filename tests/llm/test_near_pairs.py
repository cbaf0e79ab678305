"""Sets that are almost similar enough meet once, however many paths they share; probes of the Hamming search."""

import math

import numpy as np

from test_operators import brute_jaccard, key


def test_near_pairs_are_sent_to_one_unit(spark, monkeypatch):
    from bazaar.llm import jaccard_join as J
    rng = np.random.default_rng(3)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(503)]
        for copy in range(2):
            words = list(base)
            for at in rng.choice(99, 5 + copy, replace=False) * 5 + 4:
                words[at] = f"c{copy}x{at}"
            rows.append((len(rows), " ".join(words), "en"))
    rows += [(len(rows), rows[0][1] + " and more", "en")]
    seen, write = {}, J.materialize

    def spy(df, label, **kw):
        seen[label] = write(df, label, **kw)
        return seen[label]
    monkeypatch.setattr(J, "materialize", spy)
    got = J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert key([tuple(r) for r in got.collect()]) == key(brute_jaccard(rows, 4, 85))
    # what passes the count filter goes to one unit (a third set may need one of its own), not one for each shared path
    sent = seen["jaccard-suspects"].groupBy("dig").count().collect()
    assert len(sent) >= 2 and max(r["count"] for r in sent) <= 2


def test_long_near_pairs_are_written_once(spark, monkeypatch):
    from bazaar.llm import jaccard_join as J
    rng = np.random.default_rng(5)
    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(903)]
        for copy in range(2):
            words = list(base)
            for at in rng.choice(179, 9 + copy, replace=False) * 5 + 4:
                words[at] = f"c{copy}x{at}"
            rows.append((len(rows), " ".join(words), "en"))
    seen, write = {}, J.materialize

    def spy(df, label, **kw):
        seen[label] = write(df, label, **kw)
        return seen[label]
    monkeypatch.setattr(J, "materialize", spy)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(size)
    spark.conf.set(size, 4)       # a task of a large table has many batches: equal pairs of one batch are one
    try:
        got = J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()
    finally:
        spark.conf.set(size, was)
    assert key([tuple(r) for r in got]) == key(brute_jaccard(rows, 4, 85))
    # each pair passes the count filter and shares many paths, but is written in one unit only
    sent = seen["jaccard-suspects"].where("other is not null").groupBy("dig", "other").count().collect()
    assert len(sent) >= 2 and all(r["count"] == 1 for r in sent)


def test_near_families_and_blocks_lose_no_link(spark, monkeypatch):
    from bazaar.llm import jaccard_join as J
    monkeypatch.setattr(J, "_SHORT", 90)
    rng = np.random.default_rng(4)
    rows = []
    for n in (12, 40, 80, 120):
        base = [f"n{n}w{i}" for i in range(n)]
        for _ in range(14):
            words = list(base)
            for at in rng.choice(n, max(1, n // int(rng.integers(12, 40))), replace=False):
                words[at] = f"x{rng.integers(5)}"
            rows.append((len(rows), " ".join(words), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = key(brute_jaccard(rows, 4, 85))
    assert key([tuple(r) for r in J.jaccard_join(df).collect()]) == want
    plain = J._suspects
    monkeypatch.setattr(J, "_suspects", lambda shared, percent, paths: plain(shared, percent, 5, paths))
    # without pivots every link is left to the second round
    monkeypatch.setattr(J, "_pivot_pairs", lambda *a: spark.createDataFrame([], "a long, b long"))
    assert key([tuple(r) for r in J.jaccard_join(df).collect()]) == want


def test_a_segment_has_no_more_values_than_codes():
    from bazaar.llm.hamming_search import segments
    for rows in (2, 50, 2060, 10260, 51300, 10**6):
        for bits in (1, 20, 64, 100):
            parts = segments(bits, rows)
            assert sum(p[2] for p in parts) == bits
            assert all(1 <= p[2] <= max(1, math.log2(rows)) for p in parts)


def test_codes_out_of_reach_are_dropped_where_they_are_met(spark, monkeypatch):
    from bazaar.llm import hamming_search as H
    rng = np.random.default_rng(6)
    codes = [int(c) for c in rng.integers(-2**63, 2**63, 400, dtype=np.int64)]
    codes[7] = codes[350] = codes[0]
    df = spark.createDataFrame([(i, [c]) for i, c in enumerate(codes)], "id long, code array<bigint>").repartition(2)
    met, plain = [], H._met

    def spy(*a):
        out = plain(*a)
        met.append(out.count())
        return out
    monkeypatch.setattr(H, "_met", spy)
    got = {(r["query_id"], r["rank"]): (r["distance"], r["neighbor_id"]) for r in H.top_k(df, df.where("id % 50 = 0"), 64, 5).collect()}
    want = {}
    for q in range(0, 400, 50):
        near = sorted((((codes[q] ^ c) & (2**64 - 1)).bit_count(), i) for i, c in enumerate(codes))[:5]
        want |= {(q, rank): hit for rank, hit in enumerate(near, 1)}
    assert got == want
    # without the reach half of all pairs and more come out of the joins
    assert sum(met) < 0.25 * 8 * 400
