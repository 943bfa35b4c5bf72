from collections import defaultdict

from skyloom.llm import mixing

DOCS = "doc_id long, text string, source string, size string, target string"


def mixed(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)
    return mixing.mix(frame, **more).collect()


def brute_targets(sizes, share=1.5, most=2):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total, capped = share * sum(sizes.values()), {}
    while True:
        left = [s for s in sizes if s not in capped]
        rest = total - sum(capped.values())
        target = {s: weights[s] * rest / sum(weights[x] for x in left) for s in left}
        above = [s for s in left if target[s] > most * sizes[s]]
        if not above:
            return target | capped
        capped |= {s: most * sizes[s] for s in above}


def test_words_are_runs_of_other_than_ascii_blanks(spark):
    rows = mixed(spark, [(1, " a\tb\u00a0c \x0bd\x1ce ", "s"), (2, None, "s"), (3, "", "s"), (4, " \n", "s")])
    assert {r["doc_id"]: r["size"] for r in rows} == {1: 3, 2: 0, 3: 0, 4: 0}


def test_targets_and_taken_words(spark):
    texts = {"b": 40, "a": 400, "c": 300, None: 100, "\U0001f600": 7, "\uffff": 9}
    rows = []
    for source, words in texts.items():
        for part in (words // 3, words - words // 3):
            rows.append((len(rows), "w " * part, source))
    found = mixed(spark, rows)
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == texts[r["source"]]
    expected = brute_targets(sizes)
    for source in texts:
        assert abs(targets[source] - expected[source]) < 1e-6
        assert abs(taken[source] - targets[source]) <= 0.5
    again = mixed(spark, rows[::-1])
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_ranges_of_a_hot_source(spark, monkeypatch):
    rows = [(i, "w " * (i % 7), "hot" if i % 3 else "cold") for i in range(600)]
    whole = mixed(spark, rows)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    assert sorted(map(str, mixed(spark, rows))) == sorted(map(str, whole))


def test_nulls_repeats_and_empty_tables(spark):
    assert mixed(spark, []) == []
    rows = mixed(spark, [(None, None, None), (None, "a b", None), (7, "a b", "s"), (7, "a b", "s")])
    assert len(rows) == 4 and sum(r["taken"] for r in rows) == 9
    assert [r["taken"] for r in mixed(spark, [(1, None, "s")])] == [0]
