import random

from skyloom.llm import language

TEXTS = "doc_id long, text string, lang string, score string"
SYLLABLES = {"aa": ("ba", "do", "ki"), "bb": ("xu", "ze", "wy"), "cc": ("\u00f1o", "\u00e9r", "t\u00fc")}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def model(spark):
    rng = random.Random(4)
    rows = [(i, text(lang, rng.randint(5, 60), rng), lang, "") for i, lang in enumerate(list(SYLLABLES) * 20)]
    rows += [(900, None, "aa", ""), (901, "dodo", None, ""), (902, "", "bb", "")]
    return language.train(spark.createDataFrame(rows, TEXTS))


def test_languages_mixtures_and_undefined_texts(spark):
    rng = random.Random(9)
    known = model(spark)
    assert known.languages == ["aa", "bb", "cc"]
    mixed = text("aa", 30, rng) + " " + text("bb", 70, rng)
    docs = [(1, text("aa", 40, rng).upper()), (2, text("cc", 3, rng)), (3, mixed), (4, None), (5, ""), (6, "12 - 3!"), (7, "do"), (8, text("bb", 30000, rng)), (None, "xuze"), (1, "xuze")]
    frame = spark.createDataFrame([(*d, "clash", "clash") for d in docs], TEXTS)
    rows = language.identify(frame, known).collect()
    assert len(rows) == len(docs)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 1}
    assert {i: by_id[i]["lang_pred"] for i in (2, 3, 4, 5, 6, 7, 8, None)} == {2: "cc", 3: "bb", 4: "und", 5: "und", 6: "und", 7: "aa", 8: "bb", None: "bb"}
    assert sorted(r["lang_pred"] for r in rows if r["doc_id"] == 1) == ["aa", "bb"]
    shares = by_id[3]["languages"]
    assert set(shares) == {"aa", "bb"} and abs(shares["bb"] - 0.7) < 0.03
    assert set(by_id[8]["languages"]) == {"bb"} and by_id[4]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_long_texts_are_read_in_stretches(spark, monkeypatch):
    known = model(spark)
    rng = random.Random(1)
    whole = text("aa", 3000, rng) + text("cc", 2000, rng)
    once = known.words(whole)
    monkeypatch.setattr(language, "CHUNK", 600)
    assert abs(known.words(whole) - once).max() < 1e-3


def test_nothing_learned_and_empty_table(spark):
    empty = spark.createDataFrame([], TEXTS)
    known = language.train(empty)
    frame = spark.createDataFrame([(1, "abc", "aa", "")], TEXTS)
    assert [(r["lang_pred"], r["score"]) for r in language.identify(frame, known).collect()] == [("und", 0.0)]
    assert language.identify(empty, model(spark)).count() == 0


def test_number_signs_are_no_letters(spark):
    known = model(spark)
    docs = [(1, "½ ² 12"), (2, "²"), (3, "Ⅷ ⅻ ³"), (4, "½ dodo")]
    frame = spark.createDataFrame([(*d, "", "") for d in docs], TEXTS)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(frame, known).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "aa"
