import hashlib
import random
import zlib

import numpy as np

from skyloom.llm import periodic_runs as pr


def brute_runs(ids):
    """Every maximal stretch of smallest period q and length >= max(6, 4q), by comparing all places for all periods."""
    n, found = len(ids), set()
    for q in range(1, n):
        j = 0
        while j + q < n:
            if ids[j] != ids[j + q]:
                j += 1
                continue
            start = j
            while j + q < n and ids[j] == ids[j + q]:
                j += 1
            length = j - start + q
            smallest = min(p for p in range(1, q + 1) if all(ids[i] == ids[i + p] for i in range(start, start + length - p)))
            if smallest == q and length >= max(6, 4 * q):
                found.add((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force_on_random_sequences():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(0, 90)
        alphabet = rng.randint(1, 4)
        ids = [rng.randrange(alphabet) for _ in range(n)]
        if n > 10 and rng.random() < 0.5:
            a, p = rng.randrange(n // 2), rng.randint(1, 6)
            ids = ids[:a] + [ids[a + (i - a) % p] for i in range(a, n)]
        assert pr.runs_of(np.array(ids, np.int64)) == brute_runs(ids), ids


def test_known_runs():
    ids = np.array([0] * 6 + [1, 2] * 4 + [3], np.int64)
    assert pr.runs_of(ids) == [(0, 6, 1), (6, 8, 2)]
    assert pr.runs_of(np.array([0] * 5, np.int64)) == []  # shorter than six words
    assert pr.runs_of(np.array([1, 2, 3] * 3 + [1, 2], np.int64)) == []  # length 11 < 4 * 3
    assert pr.runs_of(np.array([1, 2, 3] * 4, np.int64)) == [(0, 12, 3)]


def test_long_text_is_quick_and_whole():
    words = ["a", "b", "c"] * 20000 + ["x"] * 50000
    found = pr.describe(None, " ".join(words))
    assert found["n_runs"] == 2 and (found["start"], found["length"], found["period"]) == (0, 60000, 3)
    assert found["collapsed_sha256"] == hashlib.sha256(b"a b c x").hexdigest()


def test_planting_follows_the_id():
    h = next(d for d in range(1, 10000) if zlib.crc32(str(d).encode()) % 10 == 0)
    key = pr.plant_key(h)
    words = [f"w{i}" for i in range(40)]
    g = key // 10
    a = g % 40
    p = 1 + (40 - a) // (3 + g % 8)
    assert pr.planted(words, key) == words[:a] + [words[a + (i - a) % p] for i in range(a, 40)]
    assert pr.planted(words, None) == words and pr.planted([], key) == []


def test_query_rows(spark):
    rows = [
        (1, "x x x x x x y", "c1", 1), (1, "x x x x x x y", "c1", 1), (2, None, "c2", 2), (3, "", "c3", 3),
        (None, "a b a b a b a b a b", "c4", 4), (5, "one\ttwo three", "c5", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, start int")
    result = pr.periodic_runs(docs)
    assert result.columns == ["doc_id", "text", "n_runs", "start", *pr.NAMES]
    found = [{"doc_id": r[0], "clash": (r[2], r[3]), **dict(zip(pr.NAMES, r[4:]))} for r in result.collect()]
    assert len(found) == 6
    assert {r["clash"] for r in found} == {(f"c{i}", i) for i in range(1, 6)}
    one = [r for r in found if r["doc_id"] == 1]
    assert one[0] == one[1]
    one = one[0]
    assert one["n_runs"] == 1 and (one["start"], one["length"], one["period"], one["exponent_milli"]) == (0, 6, 1, 6000)
    assert one["collapsed_sha256"] == hashlib.sha256(b"x y").hexdigest()
    assert one["runs_sha256"] == hashlib.sha256(b"0,6,1\n").hexdigest()
    for r in found:
        if r["doc_id"] in (2, 3):
            assert r["n_runs"] == 0 and r["start"] is None and r["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
            assert r["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    nameless = [r for r in found if r["doc_id"] is None][0]
    assert (nameless["start"], nameless["length"], nameless["period"]) == (0, 10, 2)
    five = [r for r in found if r["doc_id"] == 5][0]
    assert five["n_words"] == 2 and five["n_runs"] == 0  # a no-break space is no blank


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pr.periodic_runs(docs).count() == 0
