"""Token counts that follow edits: segment trees over pre-tokens, re-encoding only what an edit touches."""

from __future__ import annotations

import base64
import itertools
from pathlib import Path

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters behind a pre-token's end that the pattern may look at to end it there.
CONTEXT = 3
GROUP = 32
CACHE = 300_000
TREE = "struct<chars:array<int>,tokens:array<int>>"


class Tokenizer:
    """Pre-tokens and their token counts. ``ranks`` is the content of a tiktoken vocabulary file."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern, self.cache = regex.compile(pattern), {}

    def count(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            n = self.cache[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def pieces(self, text: str) -> tuple[list[int], list[int]]:
        """Length in characters and number of tokens of each pre-token."""
        found = self.pattern.findall(text)
        return list(map(len, found)), list(map(self.count, found))


_tokenizers: dict[tuple[int, str], Tokenizer] = {}


def _tokenizer(ranks: bytes, pattern: str) -> Tokenizer:
    """One tokenizer for each worker process."""
    key = (hash(ranks), pattern)
    if key not in _tokenizers:
        _tokenizers[key] = Tokenizer(ranks, pattern)
    return _tokenizers[key]


class Tree:
    """Segment tree over groups of pre-tokens with the characters and tokens below every node.

    Leaves are groups of ``GROUP`` to twice as many pre-tokens or fewer; an edit replaces pre-tokens in the groups it touches and
    renews the sums on their paths to the root. Only when an edit brings more groups than there are leaves is the tree laid out anew.
    """

    def __init__(self, chars: list[int], tokens: list[int]):
        self._lay([(chars[i : i + GROUP], tokens[i : i + GROUP]) for i in range(0, len(chars), GROUP)])

    def _lay(self, groups: list[tuple[list[int], list[int]]]) -> None:
        self.size = 1
        while self.size < len(groups):
            self.size *= 2
        self.groups = groups + [([], [])] * (self.size - len(groups))
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (chars, tokens) in enumerate(self.groups):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(chars), sum(tokens)
        for node in range(self.size - 1, 0, -1):
            self._renew(node)

    def _renew(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int, int]:
        """Group, index in the group and first character of the pre-token that holds character ``at``; the end if none does."""
        if at >= self.chars[1]:
            return self.size - 1, len(self.groups[-1][0]), self.chars[1]
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if first + self.chars[node] <= at:
                first += self.chars[node]
                node += 1
        for index, length in enumerate(self.groups[node - self.size][0]):
            if first + length > at:
                return node - self.size, index, first
            first += length
        raise AssertionError("sums do not match the pre-tokens")

    def ends_from(self, group: int, index: int, first: int):
        """(group, index, character) behind each pre-token from a place on."""
        for g in range(group, self.size):
            for i in range(index if g == group else 0, len(self.groups[g][0])):
                first += self.groups[g][0][i]
                yield g, i + 1, first

    def replace(self, low: tuple[int, int], high: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Put pre-tokens in place of those from ``low`` up to ``high``, both (group, index)."""
        (g, i), (h, j) = low, high
        chars = self.groups[g][0][:i] + chars + self.groups[h][0][j:]
        tokens = self.groups[g][1][:i] + tokens + self.groups[h][1][j:]
        room = h - g + 1
        span = max(GROUP, -(-len(chars) // room))
        new = [(chars[k : k + span], tokens[k : k + span]) for k in range(0, len(chars), span)]
        if span > 2 * GROUP:
            small = [(chars[k : k + GROUP], tokens[k : k + GROUP]) for k in range(0, len(chars), GROUP)]
            self._lay([x for x in self.groups[:g] if x[0]] + small + [x for x in self.groups[h + 1 :] if x[0]])
            return
        self.groups[g : h + 1] = new + [([], [])] * (room - len(new))
        nodes = set()
        for k in range(g, h + 1):
            self.chars[self.size + k], self.tokens[self.size + k] = sum(self.groups[k][0]), sum(self.groups[k][1])
            nodes.add((self.size + k) // 2)
        while nodes and max(nodes):
            for node in nodes:
                self._renew(node)
            nodes = {node // 2 for node in nodes if node > 1}

    def leaves(self) -> tuple[list[int], list[int]]:
        return list(itertools.chain.from_iterable(g[0] for g in self.groups)), list(itertools.chain.from_iterable(g[1] for g in self.groups))


def edit(text: str, tree: Tree, tokenizer: Tokenizer, start: int, length: int, insert: str) -> tuple[str, int]:
    """Replace ``length`` characters from ``start`` and bring the tree up to date; the new text and the pre-tokens encoded.

    Pre-tokens that end ``CONTEXT`` characters or more before the edit cannot change. From there the new text is cut until a cut
    behind the edit falls on an old one: the rest of both texts is the same, and so are its pre-tokens.
    """
    start = min(max(start, 0), len(text))
    end = min(start + max(length, 0), len(text))
    if start == end and not insert:
        return text, 0
    new, shift = text[:start] + insert + text[end:], len(insert) - (end - start)
    group, index, first = tree.find(max(start - CONTEXT, 0))
    # Replacing what lies behind a pre-token's end needs that pre-token's own end to be CONTEXT before the edit.
    old = tree.ends_from(group, index, first)
    place, chars, tokens = (group, index, first), [], []
    for match in tokenizer.pattern.finditer(new, first):
        chars.append(match.end() - match.start())
        tokens.append(tokenizer.count(match.group()))
        if match.end() < start + len(insert):
            continue
        while place[2] < match.end() - shift:
            place = next(old)
        if place[2] == match.end() - shift and place[2] >= end:
            break
    else:
        for place in old:
            pass
    tree.replace((group, index), place[:2], chars, tokens)
    return new, len(chars)


def ranks_of(path: str = VOCABULARY) -> bytes:
    """Content of a vocabulary file, which the driver sends to the tasks; it has a fixed size."""
    return Path(path).read_bytes()


def build(docs: DataFrame, ranks: bytes, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, text, tree, n_tokens): the pre-tokens of each document with their counts, and their sum.

    Null texts have an empty tree and 0 tokens. ``tree`` holds the leaves, from which the sums above are added up again without
    encoding anything; store it to follow later edits.
    """
    shared = _share(docs.sparkSession, ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tokenizer = _tokenizer(shared.value, pattern)
        for batch in batches:
            found = [tokenizer.pieces(t.as_py() or "") for t in batch.column("text")]
            trees = pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.list_(pa.int32())) for k in (0, 1)], ["chars", "tokens"])
            counts = pa.array([sum(f[1]) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), trees, counts], ["doc_id", "text", "tree", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, tree {TREE}, n_tokens long")


def _share(spark: SparkSession, ranks: bytes):
    return spark.sparkContext.broadcast(ranks)


def attach_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Add ``edits`` to each row of ``trees`` (doc_id, text, tree, n_tokens), in order of ``seq``.

    ``edits`` has (doc_id, seq, start, length, insert). A document's edits follow one upon the other, so they are gathered with it. Edits of
    a null or unknown doc_id change nothing; equal ``seq`` values are ordered by start, length and insert; rows that share a doc_id all get its
    edits.
    """
    listed = edits.where("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "length", "insert"))).alias("edits"))
    return trees.join(listed, "doc_id", "left")


def apply_edits(trees: DataFrame, ranks: bytes, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, text, tree, n_tokens, tokens_before, encoded): documents after their ``edits``.

    Each edit (start, length, insert) replaces characters of the text that the edits before it have left; ranges are cut to the text, null
    numbers count as 0, null inserts and texts as empty. ``encoded`` counts the pre-tokens that were encoded for it. Documents without edits stay as they are.
    """
    shared = _share(trees.sparkSession, ranks)
    kind = trees.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tokenizer = _tokenizer(shared.value, pattern)
        for batch in batches:
            texts, leaves, counts, encoded = [], [], [], []
            columns = [batch.column(c) for c in ("text", "tree", "edits", "n_tokens")]
            for text, held, edits, before in zip(*columns):
                new, held, edits, spent = text.as_py(), held.as_py(), edits.as_py() or (), 0
                if not edits:
                    texts.append(new)
                    leaves.append((held["chars"], held["tokens"]))
                    counts.append(before.as_py())
                else:
                    new, tree = new or "", Tree(held["chars"], held["tokens"])
                    for e in edits:
                        new, more = edit(new, tree, tokenizer, e["start"] or 0, e["length"] or 0, e["insert"] or "")
                        spent += more
                    texts.append(new)
                    leaves.append(tree.leaves())
                    counts.append(tree.total)
                encoded.append(spent)
            after = pa.StructArray.from_arrays([pa.array([x[k] for x in leaves], pa.list_(pa.int32())) for k in (0, 1)], ["chars", "tokens"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), after, pa.array(counts, pa.int64()), batch.column("n_tokens"), pa.array(encoded, pa.int64())],
                ["doc_id", "text", "tree", "n_tokens", "tokens_before", "encoded"])

    return trees.select("doc_id", "text", "tree", "n_tokens", "edits").mapInArrow(
        run, f"doc_id {kind}, text string, tree {TREE}, n_tokens long, tokens_before long, encoded long")
