import random

import corpus_pipeline
from skyloom.llm import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ten", "sur"]) for _ in range(rng.randint(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [[i, text(80), "aa", f"s{i % 4}"] for i in range(60)]
    passage, item = text(70), text(40)
    rows += [[100 + i, f"{text(60)} {passage} {text(60)}", "aa", "s1"] for i in range(3)]
    rows += [[200, rows[5][1], "aa", "s9"], [201, rows[6][1] + " x", "aa", None], [202, "123 456", "aa", "s1"], [203, None, "aa", "s1"]]
    rows += [[300, f"{text(30)} {item} {text(30)}", "aa", "s2"], [5, rows[5][1], "aa", "s1"]]
    return [(*r, len(r[1] or ""), "clash") for r in rows], passage, item


def test_stages(spark, tmp_path):
    rows, passage, item = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids[name] = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if k < 4:
            assert docs.columns == columns
    every = sorted(r[0] for r in rows)
    assert ids["language"] == [i for i in every if i not in (202, 203)]
    assert 200 not in ids["near_duplicates"] and ids["near_duplicates"].count(5) == 1
    assert set(range(60)) | {100, 101, 102, 300} <= set(ids["near_duplicates"])
    assert ids["repeated_strings"] == ids["near_duplicates"]
    assert ids["decontamination"] == [i for i in ids["repeated_strings"] if i != 300]
    cut = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/2").collect()}
    assert all(passage not in cut[i]["text"] and 300 < len(cut[i]["text"]) == cut[i]["n_chars"] for i in (100, 101, 102))
    assert cut[7]["text"] == rows[7][1]
    assert {"whole", "part_words", "taken"} <= set(docs.columns) and docs.where("taken <= 0").count() == 0
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_language_stage_keeps_mixed_languages_and_drops_made_up_strings(spark):
    rng = random.Random(2)
    syllables = {"aa": ["ka", "lo", "mi", "ten"], "bb": ["xu", "ze", "wy", "bor"], "cc": ["\u00f1o", "\u00e9r", "t\u00fc", "gan"], "dd": ["phi", "qua", "sed", "vo"]}
    words = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, words(lang, 100), lang) for i, lang in enumerate(list(syllables) * 60)]
    rows += [(1000 + k, " ".join(words(lang, 60) for lang in mixed), "aa") for k, mixed in enumerate((["aa", "bb", "cc"], list(syllables)))]
    rows += [(2000 + k, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(100)), "bb") for k in range(3)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t), "clash") for i, t, lang in rows], DOCS)
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in rows if r[0] < 2000]


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
