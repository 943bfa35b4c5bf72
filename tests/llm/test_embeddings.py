import random

import numpy as np
import pytest

from skyloom.llm import embeddings

VECTORS = "vec_id long, vector array<float>, label int, node string"


def brute(rows, threshold=0.98):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (vec_id, v, label) in enumerate(rows) if vec_id is not None and label is not None and usable(v)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in good}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    near = {i: [j for j in good if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in good}
    root = {i: rows[i][0] for i in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for i in good:
            least = min([root[i], *(root[j] for j in near[i])])
            changed |= least != root[i]
            root[i] = least
    return sorted((str(rows[i][0]), len(near.get(i, ())), str(root[i])) for i in range(len(rows)))


def found(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], VECTORS)
    return embeddings.near_duplicates(frame, **more).collect()


def sample():
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        for centre in rng.standard_normal((8, 16)):
            rows += [(len(rows) + k, (centre + rng.standard_normal(16) * s).tolist(), label) for k, s in enumerate((0, 0.05, 0.1, 0.2, 1))]
    tight = rng.standard_normal(16)
    rows += [(1000 + k, (tight + rng.standard_normal(16) * 0.01).tolist(), 1) for k in range(150)]
    rows += [(2000 + k, rows[0][1], 1) for k in range(30)] + [(3000, rows[0][1], 2), (3001, [2 * x for x in rows[0][1]], 1)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 8]
    rows += [(4000 + k, v, 1) for k, v in enumerate(odd)] + [(5000, rows[0][1], None), (None, rows[0][1], 1), (1001, rows[5][1], 1), (2000, rows[0][1], 1)]
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("window, block", [(64, 512), (8, 40)])
def test_against_brute_force(spark, monkeypatch, window, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = sample()
    result = found(spark, rows, window=window)
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in result) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in result)


def star(spread, copies, dims, rng):
    base = rng.standard_normal(dims)
    base /= np.linalg.norm(base)
    off = rng.standard_normal((copies, dims))
    off -= np.outer(off @ base, base)
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    return [base.tolist()] + (spread * base + np.sqrt(1 - spread**2) * off).tolist()


@pytest.mark.parametrize("spread", [0.985, 0.9893])
def test_star_and_dense_topic_against_brute_force(spark, spread):
    """A base all copies link to but none of which link to each other; and a topic in which pairs lie around the threshold."""
    rng = np.random.default_rng(8)
    rows = [(i, v, label) for label in (1, 2) for i, v in enumerate(star(spread, 600, 256, rng), 10_000 * label)]
    rows += [(30_000 + i, v, 1) for i, v in enumerate(rng.standard_normal((200, 256)).tolist())]
    result = found(spark, rows)
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in result) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_passes_grow_with_the_table():
    assert embeddings.passes_for(1000, 0.98, 64) < embeddings.passes_for(10**9, 0.98, 64)
