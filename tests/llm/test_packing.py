import itertools
import random
import zlib

import numpy as np

from skyloom.llm import packing


def best_subset(sizes, room):
    return max((sum(c) for r in range(len(sizes) + 1) for c in itertools.combinations(sizes, r) if sum(c) <= room), default=0)


def test_fill_finds_the_best_fit():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 10))]
        room = rng.randint(1, 100)
        counts = np.bincount(np.array(sizes, np.int64), minlength=101).astype(np.int64)
        got = packing.fill(counts, room, nodes=10**6)
        assert sum(got) <= room and sum(got) == best_subset(sizes, room)
        left = room - sum(got)
        rest = list(sizes)
        for g in got:
            rest.remove(g)
        assert all(r > left for r in rest)  # undominated: nothing more fits


def exact_bins(sizes, capacity):
    """Fewest bins, by trying every assignment (tiny inputs)."""
    best = len(sizes)
    for assign in itertools.product(range(len(sizes)), repeat=len(sizes)):
        loads = [0] * len(sizes)
        for s, b in zip(sizes, assign):
            loads[b] += s
        if max(loads, default=0) <= capacity:
            best = min(best, sum(1 for x in loads if x))
    return best


def test_packing_is_valid_and_near_fewest():
    rng = random.Random(5)
    for _ in range(60):
        sizes = np.array([rng.randint(1, 10) for _ in range(rng.randint(1, 6))], np.int64)
        sequence, offset = packing.pack_items(sizes, 10, nodes=10**5)
        loads = {}
        for s, q, o in sorted(zip(sizes, sequence, offset), key=lambda t: (t[1], t[2])):
            assert o == loads.get(q, 0)
            loads[q] = o + s
        assert max(loads.values()) <= 10
        assert len(loads) <= exact_bins(list(sizes), 10) + 1
        assert len(loads) >= -(-int(sizes.sum()) // 10)


def test_exact_fill_closes_a_sequence():
    sequence, offset = packing.pack_items(np.array([6, 5, 4, 3, 2], np.int64), 10, nodes=100)
    assert len(set(sequence.tolist())) == 2  # 6 + 4 and 5 + 3 + 2


def test_pieces_and_digests():
    ids = list(range(5000)) + [0]
    found = packing.pieces_of(ids, 2048)
    assert [(p, s, l) for p, s, l, _ in found] == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 905)]
    assert found[2][3] == zlib.crc32(np.array(ids[4096:], "<u4").tobytes())


def test_query_rows(spark):
    tokenizer = packing.tokenizer_of(packing.TOKENIZER_FILE)
    long_text = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, "Hello there", "c"), (1, "Hello there", "c"), (2, None, "c"), (3, "", "c"), (None, long_text, "c"), (4, "<|endoftext|> x", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    result = packing.pack(docs, group_items=3, nodes=100)
    assert result.columns == ["doc_id", "sequence_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    found = result.collect()
    texts = {r[0]: r[1] for r in rows}
    by_doc = {}
    for r in found:
        by_doc.setdefault(r[0], []).append(r)
    assert len(by_doc[1]) == 2 and sorted(r[2] for r in by_doc[None]) == list(range(len(by_doc[None])))
    for doc, pieces in by_doc.items():
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        for r in pieces:
            r = (r[0], None, *r[1:])
            assert r[5] == len(ids[r[4]:r[4] + 2048]) and r[6] == zlib.crc32(np.array(ids[r[4]:r[4] + 2048], "<u4").tobytes())
    assert {r[4] for r in by_doc[2]} == {1} and {r[4] for r in by_doc[3]} == {1}
    assert len(by_doc[None]) >= 2
    sequences = {}
    for r in found:
        sequences.setdefault(r[6], []).append((r[7], r[4]))
    for members in sequences.values():
        place = 0
        for o, length in sorted(members):
            assert o == place
            place += length
        assert place <= 2048


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0


def odd_texts():
    rng = random.Random(7)
    near = ["'", "s", "t", "re", "ve", "m", "ll", "d", "S", "R", "e", " ", "\n", "!", "1", "é", "É", "ß", "\x1c", "\x0b", "<|endoftext|>", "\x00"]
    far = [" ", "\n", "\x85", "\xa0", " ", "'", "S", "́", "Σ", "σ", "İ", "a", "é", "٣", "½", "😀", "가", "ᄀ", "ᅡ", "ﬁ", "µ", "×"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for chars in (near, far) for _ in range(1500)]
    return [*texts, "", " ", "'", "'s", "\n", "ΟΔΟΣ ΑΣ", "x" * 300]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    tokenizer, texts = packing.tokenizer_of(packing.TOKENIZER_FILE), odd_texts()
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for at_once in (packing.CUT_AT_ONCE, 100):
        monkeypatch.setattr(packing, "CUT_AT_ONCE", at_once)
        assert [ids.tolist() for ids in packing.encoder_of(packing.TOKENIZER_FILE)(texts)] == want


def test_each_word_is_encoded_once():
    class Counting:
        def __init__(self):
            self.inner, self.words = packing.tokenizer_of(packing.TOKENIZER_FILE), []

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode(self, text, **options):
            self.words += text.split(" ")
            return self.inner.encode(text, **options)

    counting = Counting()
    words = packing.Words(counting, most=50)
    for _ in range(3):
        words.ids(["one Two, one", "two ONE", "x" * 100])
    assert sorted(set(counting.words)) == [",", "one", "two", "x" * 100]
    assert counting.words.count("one") == counting.words.count("two") == 1
    assert "x" * 100 not in words.known
    words.ids([" ".join(f"w{chr(97 + i)}" for i in range(26)), "other text"])
    words.ids([" ".join(f"v{chr(97 + i)}" for i in range(26)), "other text"])
    assert len(words.known) <= 50


def test_other_tokenizers_encode_whole_texts(monkeypatch):
    texts = odd_texts()[:50]
    want = [ids.tolist() for ids in packing.encoder_of(packing.TOKENIZER_FILE)(texts)]
    monkeypatch.setattr(packing, "encodes_apart", lambda definition: False)
    assert [ids.tolist() for ids in packing.encoder_of(packing.TOKENIZER_FILE)(texts)] == want
