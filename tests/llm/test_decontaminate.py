import random

import numpy as np
import pytest

from skyloom.llm import decontaminate as dc

DOCS = "doc_id long, text string, text_key string, coverage string"
ITEMS = "item_id {}, text string, tiles string"
RNG = random.Random(2)
WORDS = [f"w{i}" for i in range(4000)]


def words(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def brute_tiles(item, doc, least):
    """Greedy tiling by its definition: mark the longest unmarked match, again and again."""
    free_i, free_d, result = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0,)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and item[i + n] >= 0 and free_i[i + n] and free_d[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return result
        n, i, j = best
        for k in range(n):
            free_i[i + k] = free_d[j + k] = False
        result.append(best)


@pytest.mark.parametrize("seed", range(30))
def test_tiles_against_the_definition(seed):
    rng = random.Random(seed)
    item = [rng.randint(0, 4) for _ in range(rng.randint(3, 40))]
    doc = [rng.randint(-1, 4) for _ in range(rng.randint(0, 60))] + item[10:] + item[:12]
    found = dc.tiles(np.array(item), np.array(doc), 3)
    expected = brute_tiles(item, doc, 3)
    for n, i, j in found:
        assert n >= 3 and item[i : i + n] == doc[j : j + n] and min(item[i : i + n]) >= 0
    for side in (1, 2):
        marked = [p for t in found for p in range(t[side], t[side] + t[0])]
        assert len(marked) == len(set(marked))
    # Ties may be taken in another order, which can move the total by less than a tile.
    assert max(n for n, *_ in found) == expected[0][0]
    assert abs(sum(t[0] for t in found) - sum(t[0] for t in expected)) <= 3


def cases():
    items = [(i, words(60)) for i in range(8)]
    item = dict(items)
    docs = {
        1: words(200) + item[0] + words(200),
        2: words(50) + item[1][40:] + words(7) + item[1][20:40] + words(9) + item[1][:20],
        3: words(50) + item[2][:25] + words(100),
        4: words(400),
        5: [w for k in range(0, 60, 4) for w in item[3][k : k + 4] + ["and"]],
        6: item[5] + item[6],
        7: item[4][:40],
    }
    return items, docs


def judged(spark, docs, items, kind="long", **more):
    frame = spark.createDataFrame([(i, t, "clash", "clash") for i, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS.format(kind))
    return dc.decontaminate(frame, bench, **more).collect()


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 900])
def test_whole_reordered_and_partial_passages(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(dc.matches, "__defaults__", (0.5, dc.MIN_MATCH, block_bytes))
    items, docs = cases()
    rows = {r["doc_id"]: r for r in judged(spark, [(i, ", ".join(d).upper()) for i, d in docs.items()], [(i, " ".join(t)) for i, t in items])}
    assert {i for i, r in rows.items() if r["contaminated"]} == {1, 2, 6, 7}
    assert rows[1]["item_id"] == 0 and rows[1]["coverage"] == 1.0
    assert rows[2]["item_id"] == 1 and rows[2]["coverage"] == 1.0
    assert rows[6]["item_id"] == 5 and rows[6]["n_items"] == 2
    assert rows[4]["item_id"] is None and rows[4]["coverage"] == 0.0


def test_nulls_repeats_short_items_and_text_ids(spark):
    items, _ = cases()
    text = " ".join(items[0][1])
    docs = [(None, text), (1, None), (2, ""), (3, text), (3, text), (4, "yes no"), (5, "the " * 400)]
    bench = [("x", text), ("x", text), (None, text), ("y", None), ("z", "yes no"), ("t", "the " * 30)]
    rows = judged(spark, docs, bench, "string")
    assert len(rows) == len(docs)
    assert {(r["doc_id"], r["contaminated"]) for r in rows} == {(None, True), (1, False), (2, False), (3, True), (4, False), (5, True)}
    assert judged(spark, [], bench, "string") == []
    assert not any(r["contaminated"] for r in judged(spark, docs, [], "string"))
