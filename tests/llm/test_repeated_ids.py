"""Missing and repeated ids in the Jaccard join, and texts of numbers in language ID."""

from test_operators import brute_jaccard, key

A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
B = "a clean text that has nothing to do with the other one at all and stays where it is for good"
C = "yet another text without any id whose words are not to be found in the two texts that came before"
ROWS = [(3, A), (7, A), (7, B), (None, A), (None, C), (None, C + " more"), (None, "  "), (None, None), (8, ""), (8, ""),
        (9, B + " x y"), (7, B), (12, "z")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, dig string, key int").repartition(3)


def test_one_row_of_each_group_stays(spark):
    from bazaar.llm.jaccard_join import one_of_each
    got = one_of_each(frame(spark, ROWS), 5, 80)
    assert got.columns == ["doc_id", "text", "dig", "key"]
    rows = [(r["doc_id"], r["text"]) for r in got.collect()]
    nameless = [t for i, t in rows if i is None and t and t.strip()]
    assert nameless in ([C], [C + " more"])
    assert key([(i, t) for i, t in rows if not (i is None and t in (C, C + " more"))]) == key(
        [(3, A), (7, B), (None, "  "), (None, None), (8, ""), (12, "z")])


def test_texts_without_ids_are_not_multiplied(spark):
    from bazaar.llm import jaccard_join as J
    rows = [(None, f"text number {i} with a few words of its own " + " ".join(f"w{i}x{k}" for k in range(12))) for i in range(40)] * 2
    rows += [(i, t) for i, (_, t) in enumerate(rows[:5])] + [(1, "w q r t y u i o p"), (1, "s d f g h j k l")]
    got = J.jaccard_join(frame(spark, rows))
    assert key([tuple(r) for r in got.collect()]) == key(brute_jaccard([(i, t, None) for i, t in rows], 4, 85))
    docs = frame(spark, rows).select("doc_id", "text").withColumn("key", J.F.xxhash64("text"))
    wanted = J._sets(docs, 4).groupBy("dig").agg(J.F.min("doc_id").alias("rep"), J.F.min("key").alias("rep_key")).where("rep is null")
    assert J._contents(docs, wanted, 4).count() == wanted.count() == 35


def test_numbers_are_no_letters(spark):
    from bazaar.llm.kneser_ney import words_of
    from bazaar.llm.language_id import language_id
    assert words_of("½ ² ① Ⅷ 12 ٣") == [] and words_of("a½b x² Straße") == ["a", "b", "x", "straße"]
    docs = spark.createDataFrame([(i, f"the word {i} is written in this text", "en") for i in range(20)]
                                 + [(100, "½ ² ① Ⅷ", "en"), (101, "३ ½", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id(docs).collect()}
    assert got[100] == got[101] == "und" and got[0] == "en"
