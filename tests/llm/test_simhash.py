import itertools
import random

import pytest
import xxhash

from skyloom.llm import simhash
from skyloom.llm.common import Store

DOCS = "doc_id long, text string, fp string, root string"


def brute_print(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(list(root), 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    return {p: find(p) for p in root}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "\u00c9t\u00c9 a\u00a0b c d c d c d", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) % 2**64 == brute_print(text)


def test_shingle_hash_is_sparks(spark):
    hashed = spark.sql("select xxhash64('a b c')").first()[0]
    assert hashed % 2**64 == int(simhash.shingle_hashes("A b c", 3)[0])


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(0, 64, 3), radius):
        flipped = sum(1 << b for b in bits)
        assert any(not m & flipped for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_join_exactly_the_pairs_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        for _ in range(3):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2)))
            prints.append(p)
    signed = {p - 2**64 if p >> 63 else p for p in prints}
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), Store(spark), radius).collect()
    assert all(((e["a"] ^ e["b"]) % 2**64).bit_count() <= radius for e in edges)
    groups = lambda roots: sorted(sorted(x for x in roots if roots[x] == r) for r in set(roots.values()))
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        root[find(e["a"])] = find(e["b"])
    assert groups({p: find(p) for p in signed}) == groups({p - 2**64 if p >> 63 else p: (r - 2**64 if r >> 63 else r) for p, r in brute_components([p % 2**64 for p in signed], radius).items()})


def sample():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(20)]
    near = [b + " " + rng.choice(words) for b in base for _ in range(2)]
    return [None, "", "  ", *base, *near, base[3].upper(), base[3]]


def test_documents(spark):
    texts = sample()
    rows = [(i + 10, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, texts[5], "", ""), (None, "only here", "", ""), (11, "", "", "")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    prints = {brute_print(r[1]) for r in rows}
    roots = brute_components(prints, 2)
    least = {}
    for doc_id, text, *_ in rows:
        root = roots[brute_print(text)]
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    expected = sorted((str(i), f"{brute_print(t):016x}", str(least[roots[brute_print(t)]])) for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found) == expected
    kept = simhash.representatives(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp", "root"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(x) for x in least.values())


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.representatives(empty).count() == 0
