"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Method (bin completion, branch and bound). Items are taken largest first. Each new sequence starts with the largest
item left; the search then enumerates fillings of the room beside it from the items left, sizes in decreasing
order and for each size every count from the most that fits down to none. A filling is complete only when no item
left fits in what remains (undominated by a filling that adds one more item). Branches are pruned when the waste
they must leave, room minus all smaller items still available, is no better than the incumbent's; the incumbent
starts as the first (greedy) filling and is replaced by every better fit; a filling without waste ends the search.
``nodes`` bounds the branches tried for one sequence; the incumbent, always a valid filling, is kept then.

Scale. Documents are tokenised where they are read (one row in, one row per piece out) and stored. Where the tokenizer's
own steps never look across a blank (``encodes_apart``), different words are encoded once and kept, up to a bound. A piece of full
length is a sequence of its own. The other pieces are dealt by their stored row number into groups of about
``group_items`` pieces, so that no document id, source or copy decides a group and a hot key is spread like any
other; each group is packed in one task. A group leaves at most one sequence less full than a global packing could.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm.common import Aside, Store

TOKENIZER_FILE = "word_bpe_49k.json"
CAPACITY = 2048
SEPARATOR = 0
ENCODE_AT_ONCE = 32
#: Words, and parts of unusual texts, whose ids a worker keeps, and the characters of the longest one it keeps.
KNOWN_WORDS, KNOWN_PARTS, KNOWN_CHARS = 500_000, 100_000, 64
#: Characters of texts that are cut into words at once, and words encoded at once.
CUT_AT_ONCE, WORDS_AT_ONCE = 2_000_000, 1000
#: The steps before the merges with which no id depends on what lies across a blank: every character of a word is
#: mapped on its own or with marks that follow it, blanks end a word, and are dropped.
APART = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None,
}


def tokenizer_of(name: str):
    """The tokenizer of a public vocabulary file, as the file defines it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task, as Spark counts
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True  # the strings of special tokens in a text are ordinary text
    return tokenizer


def encodes_apart(definition: dict) -> bool:
    """Whether a tokenizer (the content of its file) gives a text the ids of its parts between blanks, one behind the other."""
    special = all(t["special"] for t in definition["added_tokens"])  # ordinary text here
    return special and definition["model"]["type"] == "BPE" and not definition["model"]["dropout"] and all(definition[k] == v for k, v in APART.items())


class Parts(dict):
    """The ids of each part of a text as bytes (little-endian unsigned 32-bit words); new parts are encoded when asked for.

    At most ``most`` parts of ``KNOWN_CHARS`` characters or fewer are kept; then they are learned anew.
    """

    def __init__(self, tokenizer, most: int = KNOWN_PARTS):
        super().__init__()
        self.tokenizer, self.most = tokenizer, most

    def __missing__(self, part: str) -> bytes:
        ids = np.asarray(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()
        if len(part) <= KNOWN_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[part] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), "<u4")


#: ASCII and the letters of Latin-1, for which the pattern of ``APART`` needs only the class of each byte of the lower-cased text.
PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
BLANK, LETTER, DIGIT, OTHER = range(4)
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[[9, 10, 11, 12, 13, 32]], CLASSES[97:123], CLASSES[48:58], CLASSES[128:] = BLANK, LETTER, DIGIT, LETTER


def word_starts(data: np.ndarray) -> np.ndarray:
    """Where the words of the pattern of ``APART`` and the runs of blanks between them begin, in the bytes of a lower-cased plain text."""
    kinds = CLASSES[data]
    start = np.append(True, (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT))[: len(data)]
    at = np.flatnonzero(start & (data == ord("'")))
    one, two = (np.append(data, np.zeros(3, np.uint8))[at + k] for k in (1, 2))
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    short = at[np.isin(one, list(b"stmd"))]
    ends = np.concatenate([short + 2, at[pair] + 3])
    start[short + 1] = start[at[pair] + 1] = False
    start[ends[ends < len(data)]] = True
    return np.flatnonzero(start)


class Words:
    """Ids of plain texts from the ids of their different words, each of which is encoded once and kept."""

    def __init__(self, tokenizer, most: int = KNOWN_WORDS):
        self.tokenizer, self.most, self.known = tokenizer, most, {}
        self.last = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word
        self.last[[i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith("</w>")]] = True

    def learn(self, words: list[str]) -> None:
        for first in range(0, len(words), WORDS_AT_ONCE):
            some = words[first:first + WORDS_AT_ONCE]
            ids = np.asarray(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and (len(ends) == 0 or ends[-1] == len(ids)):
                self.known.update(zip(some, (part.tobytes() for part in np.split(ids, ends[:-1]))))
            else:  # a word without ids, or without an end of its own
                self.known.update((w, np.asarray(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in some)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        bodies = [text.lower().encode() for text in texts]
        joined = b"\n".join([*bodies, b""])
        starts = word_starts(np.frombuffer(joined, np.uint8))
        offsets = np.append(starts, len(joined)).astype(np.int32)
        cut = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined)).dictionary_encode()
        words = cut.dictionary.to_pylist()
        if len(self.known) + len(words) > self.most:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.known.update((w, b"") for w in new if w[0] in " \t\n\v\f\r")
        self.learn([w for w in new if w not in self.known])
        found = [self.known[w] for w in words]
        for word in new:
            if len(word) > KNOWN_CHARS:
                del self.known[word]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        of, flat = cut.indices.to_numpy(), np.frombuffer(b"".join(found), "<u4")
        n = sizes[of]
        upto = np.append(0, np.cumsum(n))
        ids = flat[np.arange(upto[-1]) + np.repeat((np.cumsum(sizes) - sizes)[of] - upto[:-1], n)]
        ends = np.cumsum([len(b) + 1 for b in bodies])[:-1]
        return np.split(ids, upto[np.searchsorted(starts, ends)])


def encoder_of(name: str) -> Callable[[list[str]], Iterator[np.ndarray]]:
    """Texts to the ids of each, as the vocabulary file's tokenizer gives them for whole texts."""
    import public_tokenizers

    tokenizer = tokenizer_of(name)
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        apart = encodes_apart(json.load(file))
    words, parts = Words(tokenizer), Parts(tokenizer)

    def by_words(texts: list[str]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for i, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= CUT_AT_ONCE or i == len(texts) - 1:
                plain = [PLAIN.fullmatch(t) is not None for t in held]
                found = iter(words.ids([t for t, p in zip(held, plain) if p])) if any(plain) else iter(())
                for t, p in zip(held, plain):
                    yield next(found) if p else parts.ids(t)
                held, size = [], 0

    if apart:
        return by_words

    def whole(texts: list[str]) -> Iterator[np.ndarray]:
        for first in range(0, len(texts), ENCODE_AT_ONCE):
            # encodings hold offsets and token strings too: only a few live at a time, their ids kept
            for found in tokenizer.encode_batch(texts[first:first + ENCODE_AT_ONCE], add_special_tokens=False):
                yield np.asarray(found.ids, "<u4")

    return whole


_encoders: dict[str, Callable] = {}


def _encoder(name: str) -> Callable:
    """One encoder for each worker process."""
    if name not in _encoders:
        _encoders[name] = encoder_of(name)
    return _encoders[name]


def pieces_of(ids: list[int] | np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of the ids as little-endian unsigned 32-bit words) for each cut of ``capacity`` ids."""
    found = []
    for piece, start in enumerate(range(0, len(ids), capacity)):
        part = np.asarray(ids[start:start + capacity], dtype="<u4")
        found.append((piece, start, len(part), zlib.crc32(part.tobytes())))
    return found


def fill(counts: np.ndarray, room: int, nodes: int) -> list[int]:
    """The sizes of the best filling of ``room`` found from ``counts`` (items left by size), by branch and bound."""
    sizes = np.nonzero(counts[1:room + 1])[0][::-1] + 1
    if len(sizes) == 0:
        return []
    have = counts[sizes]
    after = np.concatenate([np.cumsum((sizes * have)[::-1])[::-1], [0]])
    if after[0] <= room:
        return [int(s) for s, c in zip(sizes, have) for _ in range(int(c))]
    best: list = [room + 1, None]
    chosen: list[int] = []
    budget = [nodes]

    def search(i: int, left: int, spare: int) -> bool:
        """``spare``: the smallest size passed over while items of it were left."""
        budget[0] -= 1
        while i < len(sizes) and sizes[i] > left:
            i += 1
        if i == len(sizes) or left == 0:
            if spare <= left:  # one more item fits: dominated
                return False
            if left < best[0]:
                best[0], best[1] = left, list(chosen)
            return left == 0
        if left - min(left, after[i]) >= best[0]:
            return False
        size = int(sizes[i])
        most = min(int(have[i]), left // size)
        for take in range(most, -1, -1):
            chosen.extend([size] * take)
            done = search(i + 1, left - take * size, size if take < have[i] else spare)
            del chosen[len(chosen) - take:]
            if done or (budget[0] <= 0 and best[1] is not None):
                return done
        return False

    search(0, room, room + 1)
    return best[1]


def pack_items(lengths: np.ndarray, capacity: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item (lengths 1 .. capacity), items taken in the given order among equal sizes."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * capacity + 100))
    n = len(lengths)
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    by_size: dict[int, list[int]] = {}
    for index in range(n - 1, -1, -1):  # popped from the end: first rows first
        by_size.setdefault(int(lengths[index]), []).append(index)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    number, largest = 0, capacity
    while True:
        while largest > 0 and counts[largest] == 0:
            largest -= 1
        if largest == 0:
            break
        counts[largest] -= 1
        members = [by_size[largest].pop()]
        for size in fill(counts, capacity - largest, nodes):
            counts[size] -= 1
            members.append(by_size[size].pop())
        place = 0
        for index in members:
            sequence[index], offset[index] = number, place
            place += int(lengths[index])
        number += 1
    return sequence, offset


PIECES = "piece int, start long, length long, ids_crc32 long"


def tokenised(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the document's ids (null text: empty) and a separator id 0, cut into pieces of ``capacity``."""
    aside = Aside(docs)
    kept = [i for i, n in enumerate(aside.names) if n != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aside.df.schema.fields if f.name != "text")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer_file)
        for batch in batches:
            rows, cuts = [], []
            for row, ids in enumerate(encode([t if isinstance(t, str) else "" for t in batch["text"]])):
                for cut in pieces_of(np.append(ids, np.uint32(SEPARATOR)), capacity):
                    rows.append(row)
                    cuts.append(cut)
            out = batch.iloc[rows, kept].reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame(cuts, columns=["piece", "start", "length", "ids_crc32"])], axis=1)

    return aside, aside.df.mapInPandas(each, f"{schema}, {PIECES}")


def pack(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, capacity: int = CAPACITY,
         group_items: int = 20_000, nodes: int = 2_000) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    A document's tokens (``tokenizer_file`` read by ``public_tokenizers.path``, no special tokens added, their
    strings taken as text) end with id 0; a null or empty text is that one id. Documents longer than ``capacity``
    are cut into pieces of ``capacity`` tokens, the last one shorter; nothing else is cut. Every row is a document,
    repeated rows and null ids included, so each has its own pieces; the text itself is not repeated on its pieces
    (every column but ``text`` is). Sequences hold at most ``capacity`` tokens,
    offsets run gapless from 0 in each, and ``sequence_id`` numbers are unique (negative for full pieces, which
    are sequences alone). Other columns ride along, also when their names clash (renamed aside and back).
    Ties between equal sizes go by stored row order, so a rerun over the same stored table gives the same packing.
    """
    spark: SparkSession = docs.sparkSession
    store = Store(spark)
    aside, cut = tokenised(docs, tokenizer_file, capacity)
    pieces = store.keep(cut.withColumn("row_key", F.monotonically_increasing_id()))
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("row_key")).withColumn("offset", F.lit(0).cast("long"))
    items = pieces.where(F.col("length") < capacity).select("row_key", "length")
    total = items.count()
    groups = max(1, -(-total // group_items))
    numbered = items.withColumn("group", F.pmod(F.xxhash64("row_key"), F.lit(groups)))

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_key", kind="stable").reset_index(drop=True)
        sequence, offset = pack_items(frame["length"].to_numpy(np.int64), capacity, nodes)
        group = int(frame["group"].iloc[0])
        return pd.DataFrame({"row_key": frame["row_key"], "sequence_id": group * (1 << 32) + sequence, "offset": offset})

    placed = numbered.groupBy("group").applyInPandas(each, "row_key long, sequence_id long, offset long")
    packed = pieces.join(placed, "row_key").unionByName(full)
    names = [n for n in aside.names if n != "text"]
    original = [o for o, n in zip(aside.original, aside.names) if n != "text"]
    more = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(*names, *more).toDF(*original, *more)
