import random
import zlib
from collections import Counter

from skyloom.llm import spelling


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_scan_equals_all_pairs():
    rng = random.Random(11)
    for _ in range(200):
        alphabet = "abé"[: rng.randint(1, 3)]
        words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 30))})
        lcp, ends = spelling.ranges(words)
        for q in words + ["abab", ""]:
            assert spelling.scan(q, words, lcp, ends) == [w for w in words if distance(q, w) == 1], (q, words)


def brute(texts, most_in_group):
    counts = Counter()
    for doc_id, text in texts:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 31 == 0:
                    p = h % len(low)
                    low = low[:p] + low[p + 1:]
            counts[low] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in vocab if distance(w, v) == 1] for w in vocab}
    form = {}
    for w, n in vocab.items():
        top = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = top if top is not None and vocab[top] >= 10 * n else None
    rows = {}
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, n, len(near[w]), vocab[form[w]] if form[w] else None)
    return rows


def fixture():
    rng = random.Random(4)
    base = ["meanwhile", "together", "elephant", "ÉCOLEsauvage", "barricade", "barricades", "barracade", "quietness"]
    texts = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.3:
            w = rng.choice(base)
            k = rng.randrange(len(w))
            words.append(w[:k] + rng.choice("xyzé") + w[k + 1:])
        texts.append((i, " ".join(words) + "." if i % 7 else None))
    return texts + [(None, "meanwhile meanwhile"), (400, "")]


def test_query_equals_brute_force(spark):
    texts = fixture()
    docs = spark.createDataFrame([(d, t, "clash") for d, t in texts], "doc_id long, text string, n string")
    expected = brute(texts, 5000)
    for most in (5000, 1):  # 1: every group is hot and split by deletion variants
        got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(docs, most_in_group=most).collect()}
        assert got == expected
    assert any(v[0] is not None for v in expected.values())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(docs).count() == 0


def test_scan_of_all_queries_equals_one_by_one():
    rng = random.Random(12)
    for _ in range(200):
        alphabet = "abcé"[: rng.randint(1, 4)]
        words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(1, 40))})
        want = sorted((a, b) for a in words for b in words if a < b and distance(a, b) == 1)
        assert sorted(spelling.near_in_group(words, None)) == want
    groups = [(["abcdefgh", "abcdefgx", "abcdefghi"], 8), (["abcdefgh", "abcdefgx"], None), ([], None)]
    assert sorted(spelling.near_in_groups(groups)) == [("abcdefgh", "abcdefghi"), ("abcdefgh", "abcdefgx"), ("abcdefgh", "abcdefgx")]
