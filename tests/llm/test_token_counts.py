import random

import pytest

from skyloom.llm import token_counts as tc

DOCS = "doc_id long, text string, tree string, n_tokens string"
EDITS = "doc_id long, seq int, start int, length int, insert string"
ALPHABET = [*"ab c'sdtlremv  \n\t1\u00b2\u00e9\u00b2_-!?\u4e2d", "'ll", "'re", "  ", "\n\n"]


@pytest.fixture(scope="module")
def tokenizer():
    return tc.Tokenizer(tc.ranks_of())


@pytest.mark.parametrize("seed", range(8))
def test_tree_after_edits_is_that_of_the_new_text(tokenizer, seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice(ALPHABET) for _ in range(n))
    for _ in range(60):
        text = make(rng.choice([0, 1, 5, 50, 400, 3000]))
        tree = tc.Tree(*tokenizer.pieces(text))
        for _ in range(rng.randint(1, 5)):
            text, _ = tc.edit(text, tree, tokenizer, rng.randint(-2, len(text) + 2), rng.choice([0, 1, 2, 10, 500]), make(rng.choice([0, 1, 2, 8, 300])))
            assert tree.leaves() == tokenizer.pieces(text)
            assert tree.total == len(tokenizer.encoding.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_an_edit_encodes_its_surroundings_only(tokenizer):
    text = "some words and " * 2000
    tree = tc.Tree(*tokenizer.pieces(text))
    _, spent = tc.edit(text, tree, tokenizer, 15000, 4, "other")
    assert spent < 10


def test_documents_and_edits(spark):
    ranks = tc.ranks_of()
    texts = [(1, "one two three"), (2, None), (3, ""), (4, "long " * 5000), (None, "no id"), (1, "again one")]
    docs = spark.createDataFrame([(*t, "clash", "clash") for t in texts], DOCS)
    edits = [(1, 2, 0, 3, "uno"), (1, 1, 4, 3, None), (2, 1, 0, 0, "now text"), (3, 1, 5, 5, None), (4, 1, None, None, "x"), (None, 1, 0, 9, "z"), (77, 1, 0, 0, "q")]
    trees = tc.build(docs, ranks)
    rows = tc.apply_edits(tc.attach_edits(trees, spark.createDataFrame(edits, EDITS)), ranks).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows) == sorted(
        [("1", "uno  three"), ("1", "unoine"), ("2", "now text"), ("3", ""), ("4", "x" + "long " * 5000), ("None", "no id")])
    whole = {(r["doc_id"], r["text"]): r for r in tc.build(spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string"), ranks).collect()}
    for r in rows:
        assert r["n_tokens"] == whole[r["doc_id"], r["text"]]["n_tokens"] and r["tree"] == whole[r["doc_id"], r["text"]]["tree"]
    assert tc.build(docs.where("doc_id > 99"), ranks).count() == 0
