"""Every operator on the awkward table of conftest, against brute force, and on an empty table."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest_data import TEXTS


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


def shingles(t, k):
    w = words(t)
    return set() if not w else {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_jaccard(rows, k, percent):
    sets = [shingles(t, k) for _, t, _ in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None, len(link[i])))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_jaccard_join(docs, empty):
    from bazaar.llm.jaccard_join import jaccard_join
    assert jaccard_join(empty).count() == 0
    for k, percent in ((4, 85), (5, 80)):
        got = [tuple(r) for r in jaccard_join(docs, k, percent).collect()]
        assert key(got) == key(brute_jaccard(TEXTS, k, percent))


def test_jaccard_join_random(spark):
    from bazaar.llm import jaccard_join as J
    rng = np.random.default_rng(5)
    base = [[f"w{rng.integers(400)}" for _ in range(n)] for n in (30, 60, 90, 700)]
    rows = []
    for i in range(90):
        w = list(base[i % 4])
        for at in rng.integers(0, len(w), rng.integers(0, 1 + len(w) // 25)):
            w[at] = f"x{rng.integers(9)}"
        rows.append((i, " ".join(w), "en"))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert key([tuple(r) for r in J.jaccard_join(df).collect()]) == key(brute_jaccard(rows, 4, 85))


def test_paths_cover_links():
    """Linked sets share a path, whatever their sizes."""
    from bazaar.llm import jaccard_join as J
    from bazaar.llm.textops import U64, mix
    rng, branching = np.random.default_rng(1), J.Branching(85)
    for n in [*range(1, 40), 77, 150, 333, 800]:
        for _ in range(4):
            a = np.unique(mix(rng.integers(0, 2**62, n).astype(U64)))
            d = J.max_difference(2 * len(a), 85)
            drop = rng.integers(0, d + 1)
            b = np.unique(np.r_[rng.permutation(a)[drop:], mix(rng.integers(0, 2**62, d - drop).astype(U64))])
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common) and common < max(len(a), len(b)):
                assert np.intersect1d(J.path_digests(a, 85, branching), J.path_digests(b, 85, branching)).size
            assert (common in (0,) or J.trie_links(a, [b], 85) ==
                    ([0] if 100 * common >= 85 * (len(a) + len(b) - common) else []))


def test_license_scan(docs, empty):
    from bazaar.llm.license_rules import GATES, rules
    from bazaar.llm.license_scan import license_scan
    assert license_scan(empty).count() == 0
    got = {r["doc_id"]: r for r in license_scan(docs).collect()}
    assert (got[4]["n_words"], got[5]["n_words"], got[4]["labels"], got[4]["score"]) == (0, 0, "", 0.0)
    assert got[13]["n_words"] == 20000 and got[13]["first_word"] is None
    assert (got[10]["base_labels"], got[10]["n_base"], got[10]["first_word"]) == ("apache", 1, 3)
    assert (got[11]["n_base"], got[11]["first_word"], got[11]["last_word"], got[11]["base_labels"]) == (3, 0, 5, "gpl,mit")
    for r in rules():       # no rule can match where all gates miss
        assert r.keyword in r.pattern or any(g.strip() in r.pattern or g.strip() in r.keyword for g in GATES) or "licen" in r.pattern


def test_bpe(docs, empty):
    from bazaar.llm.bpe import encode, encode_digests
    assert encode_digests(empty).count() == 0
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text, _ in TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    assert key([tuple(r) for r in encode_digests(docs).collect()]) == key(want)
    assert {r["doc_id"]: r["ids"] for r in encode(docs).collect()}[5] == []


def test_token_counts(docs, empty):
    from bazaar.llm.token_counts import at_limit, quantile_length, suffix_sums, token_counts
    assert token_counts(empty).count() == 0
    lengths = [3, 3, 0, 900, 17, 3, 256, 255, 17]
    hist = docs.sparkSession.createDataFrame([(n, c, n * c) for n, c in Counter(lengths).items()],
                                             "n_tokens long, docs long, tokens long")
    answers = suffix_sums(hist, block=16)
    for r in answers.collect():
        limit = r["n_tokens"]
        assert r["kept_tokens"] == sum(min(n, limit) for n in lengths)
        assert r["docs_ge"] == sum(n >= limit for n in lengths)
        assert r["tokens_ge"] == sum(n for n in lengths if n >= limit)
    assert tuple(at_limit(answers, 100).first()) == (3, sum(min(n, 100) for n in lengths), sum(max(0, n - 100) for n in lengths))
    assert quantile_length(answers, 0.5).first()[0] == 17


def test_packing(docs, empty):
    from bazaar.llm.packing import pack
    assert pack(empty).count() == 0
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack(docs, shard_bytes=4000).collect()
    ids = [(i, t.encode(x or "", add_special_tokens=False).ids + [2]) for i, x, _ in TEXTS]
    want, got = Counter(), Counter()
    for i, x in ids:
        want[i] += len(x)
    sequences = {}
    for r in rows:
        got[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        crcs = {zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], np.uint32).tobytes()) for i, x in ids if i == r["doc_id"]}
        assert r["ids_crc32"] in crcs
    assert want == got
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_language_and_toxicity(spark, docs, empty):
    from bazaar.llm.language_id import accepted_rows, language_id
    from bazaar.llm.toxicity import ordinary_rows, toxicity
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(1, 16)], "doc_id long, quality int, toxic int")
    assert language_id(empty).count() == 0 and toxicity(empty, labels).count() == 0
    got = {r["doc_id"]: r for r in language_id(docs).collect()}
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[12]["lang_pred"] == "und"
    assert got[1]["lang_pred"] in ("en", "de", "fr") and 0 <= got[1]["score"] <= 1
    kept = accepted_rows(docs)
    assert kept.columns == docs.columns and not {4, 5, 6, 12} & {r["doc_id"] for r in kept.collect()}
    rows = toxicity(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 5 == 0) for r in rows)
    assert ordinary_rows(docs, labels).columns == docs.columns
    assert ordinary_rows(docs, labels.limit(0)).count() == len(TEXTS)


def test_hpy_model(docs, empty):
    from bazaar.llm.hpy_model import score_corpus
    assert score_corpus(empty).count() == 0
    tokens = [(i, words(t) + [None]) for i, t, _ in TEXTS]
    held = {i: zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in tokens}
    c = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for _, ws in tokens)
    rows = score_corpus(docs).collect()
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in rows)


def test_fingerprints(docs, empty, monkeypatch):
    from bazaar.llm import fingerprints as P
    assert P.fingerprints(empty).count() == 0
    monkeypatch.setattr(P, "_BUCKET", 3)
    split = lambda t: {p for p in re.split(P._PARAGRAPH, t) if p}
    near = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    order = sorted(TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {}
    for r in P.fingerprints(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(TEXTS)
    for x, y in zip(order, order[1:] + order[:1]):
        a, b = x[1] or "", y[1] or ""
        cut = len(a) // 3
        edited = a[:len(a) - cut] + b[:cut]
        r = next(r for r in got[x[0]] if r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest())
        assert r["n_chars"] == len(a)
        assert abs(r["near_edited"] - near(split(a), split(edited))) < 1e-12
        assert abs(r["near_next"] - near(split(a), split(b))) < 1e-12
    assert got[1][0]["fingerprint"] == got[2][0]["fingerprint"] != got[3][0]["fingerprint"]


def test_hamming_search(spark):
    from bazaar.llm.hamming_search import embedding_top_k
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(60)] + [(60 + i, [1.0] * 20) for i in range(15)] + [(100, None), (101, []), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert embedding_top_k(df.limit(0)).count() == 0
    live = [(i, [v > 0 for v in e]) for i, e in rows if i is not None and e]
    want = []
    for i, e in live:
        if i % 25 == 0:
            ranked = sorted((sum(a != b for a, b in zip(e, f)), j) for j, f in live)[:4]
            want += [(i, r + 1, j, d) for r, (d, j) in enumerate(ranked)]
    assert sorted(tuple(r) for r in embedding_top_k(df, 4, 25).collect()) == sorted(want)


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline as C
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(1, 16)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now = docs
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, now, str(tmp_path))
        assert after.columns == docs.columns and after.count() <= now.count()
        now = after
    left = C.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert {1, 2, 3} & {r["doc_id"] for r in left} == {1} and sum(r["doc_id"] == 14 for r in left) == 1
    assert {r["doc_id"] for r in C.run(spark, str(tmp_path)).collect()} == {r["doc_id"] for r in now.collect()}


def test_hpy_contexts_are_words(spark):
    """Each of 200 words is learned as a context of its own: its follower is nearly certain, in held-out texts too."""
    from bazaar.llm.hpy_model import score_corpus
    is_held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    rows = [(i, f"x{i % 200} y{i % 200}") for i in range(4000)]
    scores = [r["score"] for r in score_corpus(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
              if is_held(r["doc_id"])]
    # the first word has 1/200; a follower shared by 16 classes of contexts would add about -1
    assert len(scores) > 400 and np.mean(scores) > math.log10(1 / 200) - 0.4


def test_hpy_contexts_are_normalised(spark, monkeypatch):
    """In every context, on a grid of four cells, the words and the unseen one add up to 1."""
    from bazaar.llm import hpy_model as H
    monkeypatch.setattr(H, "CELLS", 4.0)
    is_held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    rng = np.random.default_rng(2)
    vocab = [f"v{k}" for k in range(12)]
    held, train = (iter([i for i in range(6000) if is_held(i) == k]) for k in (True, False))
    rows = [(next(train), " ".join(vocab[int(k)] for k in rng.integers(0, 12, 8) * rng.integers(0, 2, 8))) for _ in range(300)]
    rows += [(next(held), f"{a} {b}") for a in [*vocab, "unseen"] for b in [*vocab, "unseen"]] + [(next(held), "")]
    asked, score_blocks = {}, H._score_blocks

    def spy(blocks, answers, s, side):
        assert side == 2
        got = {r["cell"]: r for r in answers.collect()}
        pairs = H.Pairs.read(blocks.collect()[0].asDict(), side)
        for cell, i, j in zip(pairs.cells.tolist(), pairs.bounds, pairs.bounds[1:]):
            for prev, p in zip(pairs.prev[i:j].tolist(), H._load(got[cell]["p"])[0]):
                asked.setdefault(prev, []).append(float(p))
        return score_blocks(blocks, answers, s, side)
    monkeypatch.setattr(H, "_score_blocks", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert H.score_corpus(docs).count() == len(rows)
    assert len(asked) == 14 and all(len(p) == 14 and abs(sum(p) - 1) < 1e-4 for p in asked.values())


def test_hpy_resample_is_the_conditional():
    """The tables of an entry follow S(n, t) p^t times the opening weights, by brute force over all seatings."""
    from bazaar.llm import hpy_model as H
    d, p, rest, n, draws = 0.6, 0.3, 4.0, 5, 200_000

    def seatings(sizes, left):
        """Weights of all seatings of the customers left: by tables."""
        if not left:
            return Counter({len(sizes): 1.0})
        out = seatings([*sizes, 1], left - 1)
        out = Counter({t: w * p * (H.STRENGTH + d * (rest + len(sizes))) for t, w in out.items()})
        for k, size in enumerate(sizes):
            for t, w in seatings(sizes[:k] + [size + 1] + sizes[k + 1:], left - 1).items():
                out[t] += w * (size - d)
        return out
    want = seatings([], n)
    got = Counter(H.resample(np.full(draws, n), np.full(draws, rest), np.full(draws, p), d, np.random.default_rng(1)).tolist())
    assert all(abs(got[t] / draws - w / sum(want.values())) < 0.005 for t, w in want.items())
    large = H.resample(np.array([1, 300, 10**6]), np.zeros(3), np.full(3, 1e-3), d, np.random.default_rng(1))
    assert large[0] == 1 and (large >= 1).all() and (large <= [1, 300, 10**6]).all()


def test_hpy_sweeps_keep_tables(spark, monkeypatch):
    """A sweep draws given the other tables: the context's total less the entry's own of the sweep before."""
    from bazaar.llm import hpy_model as H
    seen, seated = [], H._seated
    monkeypatch.setattr(H, "_seated", lambda active, before, *rest: seen.append(before) or seated(active, before, *rest))
    docs = spark.createDataFrame([(i, "a b a b c a") for i in range(50)], "doc_id long, text string").coalesce(1)
    assert H.score_corpus(docs).count() == 50
    assert len(seen) == H.SWEEPS == 4 and seen[0] is None and all(b.where("t is not null").count() == 1 for b in seen[1:])


def test_fingerprints_cut_at_every_sentence(spark):
    """Sentences that start with any letter, or in other scripts, are paragraphs of their own."""
    from bazaar.llm import fingerprints as P
    texts = ["One here. Two there! so it is? Zebra.\nLast. ", "Раз. Два! Три? Четыре.", "一。二！三？四。", "एक। दो। तीन।", "واحد؟ اثنان۔ ثلاثة."]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(P.F.size(P.digests(P.F.col("text")))).collect()] == [5, 4, 4, 3, 3]


def test_jaccard_overlaps_are_exact():
    """The bound of two sets of 100,001 common shingles is not rounded."""
    from bazaar.llm.jaccard_join import overlaps
    a = np.arange(100_001, dtype=np.uint64)
    assert int(overlaps([a, a])[0, 1] * (100 + 85)) == 100_001 * 185
