import random

import numpy as np

from skyloom.llm import quality

DOCS = "doc_id long, text string, score string"


def rows(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(2, 6)))
    for i in range(n):
        good = [word() for _ in range(rng.randint(1, 200))]
        kind = i % 5
        bad = {0: [w + "$$$" for w in good], 1: [word()] * 50, 2: [w.upper() + "!!" for w in good]}.get(kind)
        yield i, " ".join(bad or good), int(bad is None)


def trained(spark, **more):
    frame = spark.createDataFrame(list(rows(400, 1)), "doc_id long, text string, label int")
    return quality.train(frame, **more)


def test_held_out_accuracy_and_odd_texts(spark):
    model = trained(spark)
    test = list(rows(300, 2))
    odd = [(1000, None), (1001, ""), (None, test[4][1]), (5, test[4][1]), (1002, "$" * 3), (1003, " \n")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t, _ in test] + [(*o, "clash") for o in odd], DOCS)
    found = quality.score(frame, model).collect()
    assert len(found) == len(test) + len(odd)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 5)}
    assert np.mean([by_id[i]["predicted"] == label for i, _, label in test if i != 5]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert by_id[1000]["score"] == by_id[1001]["score"]


def test_ratios_use_all_rows_and_the_fit_a_bounded_part(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 64)
    a, b = trained(spark, max_fit_rows=100), trained(spark)
    assert (a.ratios == b.ratios).all() and not (a.weights == b.weights).all()


def test_indicators_do_not_depend_on_chunks_of_trigrams(monkeypatch):
    text = "ab " * 300
    whole = quality.indicators(text)
    monkeypatch.setattr(quality, "CHUNK", 60)
    assert set(quality.indicators(text)) <= set(whole) | set(quality.indicators(text[:62]))


def test_one_label_no_labels_and_empty_table(spark):
    labelled = "doc_id long, text string, label int"
    frame = spark.createDataFrame([(1, "a b", "")], DOCS)
    only = quality.train(spark.createDataFrame([(1, "a", 1), (2, "b", None)], labelled))
    none = quality.train(spark.createDataFrame([], labelled))
    assert quality.score(frame, only).first()["score"] > 0.99
    assert abs(quality.score(frame, none).first()["score"] - 0.5) < 1e-3
    assert quality.score(frame.where("doc_id > 1"), only).count() == 0


def test_labels_meet_their_documents(spark):
    docs = spark.createDataFrame([(1, "a", ""), (2, "b", ""), (None, "c", "")], DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9, 1)], "doc_id long, label int")
    assert sorted((r["doc_id"], r["label"]) for r in quality.labelled_rows(docs, labels).collect()) == [(1, 0), (1, 1)]


def test_dual_descent_separates_and_keeps_its_constraints():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 5, replace=False)).astype(np.int32) for _ in range(200)]
    labels = np.array([1.0 if r.min() < 5 else -1.0 for r in rows])
    values = [np.ones(5) for _ in rows]
    weights, bias = quality.dual_descent(rows, values, labels, 1.0, 200, 1)
    margins = np.array([weights[r].sum() + bias for r in rows])
    assert ((margins > 0) == (labels > 0)).mean() > 0.95
    # The primal is near the best that small changes of the weights can reach.
    loss = lambda w: w @ w / 2 + bias * bias / 2 + np.maximum(0, 1 - labels * np.array([w[r].sum() + bias for r in rows])).sum()
    base = loss(weights)
    for k in range(50):
        for step in (-0.05, 0.05):
            other = weights.copy()
            other[k] += step
            assert loss(other) > base - 0.05


def test_a_bounded_fit_takes_the_same_rows_under_any_partitioning(spark):
    frame = spark.createDataFrame(list(rows(300, 5)), "doc_id long, text string, label int")
    one = quality.train(frame.repartition(1), max_fit_rows=40)
    many = quality.train(frame.repartition(7, "doc_id"), max_fit_rows=40)
    assert np.array_equal(one.weights, many.weights) and one.bias == many.bias
