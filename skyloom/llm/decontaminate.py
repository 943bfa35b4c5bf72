"""Benchmark decontamination by greedy string tiling with Karp-Rabin matching (Wise, 1993)."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import Store, text_key

WORD = re.compile(r"\w+")
MIN_MATCH = 5
#: Text of the benchmark that one pass over the documents holds in memory.
BLOCK_BYTES = 16 * 1024 * 1024
BASE = 1_000_003
GAP = -1
FOUND = "text_key binary, item_id {kind}, coverage double, tiles array<struct<item_start:int,doc_start:int,words:int>>"


def window_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2^64, of each window of ``length`` token numbers."""
    if len(tokens) < length:
        return np.empty(0, np.uint64)
    values = (tokens.astype(np.int64) + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(len(tokens) - length + 1, np.uint64)
    for k in range(length):
        total = total * np.uint64(BASE) + values[k : k + len(total)]
    return total


def _matches(item: np.ndarray, doc: np.ndarray, item_free: np.ndarray, doc_free: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(words, item start, doc start) of each match of unmarked words of at least ``length`` that cannot be longer."""
    def windows(tokens, free):
        open_runs = np.convolve(free, np.ones(length, np.int64), "valid") == length
        return zip(np.flatnonzero(open_runs).tolist(), window_hashes(tokens, length)[open_runs].tolist())

    if len(item) < length or len(doc) < length:
        return []
    starts = defaultdict(list)
    for at, value in windows(item, item_free):
        starts[value].append(at)
    found = []
    for j, value in windows(doc, doc_free):
        for i in starts.get(value, ()):
            if i and j and item_free[i - 1] and doc_free[j - 1] and item[i - 1] == doc[j - 1]:
                continue  # part of the match that begins one word earlier
            end = min(len(item) - i, len(doc) - j)
            same = (item[i : i + end] == doc[j : j + end]) & item_free[i : i + end] & doc_free[j : j + end]
            words = end if same.all() else int(same.argmin())
            if words >= length:
                found.append((words, i, j))
    return found


def tiles(item: np.ndarray, doc: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiling: (words, item start, doc start), longest first, none overlapping in either text.

    Matches of a search length are looked up by Karp-Rabin hash and marked longest first; a match that others have
    partly covered is kept for the next search. A match of more than twice the search length raises
    the length, else it is halved down to ``least``. Negative numbers match nothing.
    """
    item_free, doc_free = (item >= 0).copy(), (doc >= 0).copy()
    result, length = [], max(least, min(20, len(item)))
    while True:
        found = _matches(item, doc, item_free, doc_free, length)
        longest = max(found, default=(0,))[0]
        if longest > 2 * length:
            length = longest
            continue
        covered = False
        for words, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if item_free[i : i + words].all() and doc_free[j : j + words].all():
                item_free[i : i + words] = doc_free[j : j + words] = False
                result.append((words, i, j))
            else:
                covered = True
        if covered:
            continue  # what is left of partly covered matches may still be long enough
        if length == least:
            return result
        length = max(least, length // 2)


class Index:
    """The seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]], least: int):
        self.least, self.vocabulary, self.items = least, {}, []
        number = self.vocabulary.setdefault
        for item_id, text in items:
            words = WORD.findall((text or "").lower())
            if len(words) >= least:
                self.items.append((item_id, np.array([number(w, len(self.vocabulary)) for w in words], np.int64)))
        hashes = [window_hashes(tokens, least) for _, tokens in self.items]
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        pairs = np.unique(np.rec.fromarrays([np.concatenate(hashes or [np.empty(0, np.uint64)]), owner], names="seed,item"))
        self.seeds, first = np.unique(pairs["seed"], return_index=True)
        self.first, self.owner = np.append(first, len(pairs)), pairs["item"]

    def search(self, text: str, threshold: float):
        """(item id, coverage, tiles) of each item of which tiles cover at least ``threshold``."""
        words = WORD.findall(text.lower())
        if len(words) < self.least or not len(self.seeds):
            return
        tokens = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(GAP)), np.int64, len(words))
        known = np.convolve(tokens >= 0, np.ones(self.least, np.int64), "valid") == self.least
        at = np.flatnonzero(known)
        if not len(at):
            return
        hashes = window_hashes(tokens, self.least)[at]
        place = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        hit = self.seeds[place] == hashes
        at, place = at[hit], place[hit]
        by_item = defaultdict(list)
        for start, seed in zip(at.tolist(), place.tolist()):
            for item in self.owner[self.first[seed] : self.first[seed + 1]].tolist():
                by_item[item].append(start)
        for item, starts in by_item.items():
            item_id, item_tokens = self.items[item]
            # Words outside shared seeds cannot be part of a tile; a gap stands for each run of them.
            near = np.unique(np.add.outer(np.array(starts), np.arange(self.least)))
            gaps = np.flatnonzero(np.diff(near) > 1) + 1
            if np.isin(item_tokens, tokens[near]).sum() < threshold * len(item_tokens):
                continue
            where, part = np.insert(near, gaps, -1), np.insert(tokens[near], gaps, GAP)
            found = tiles(item_tokens, part, self.least)
            coverage = sum(t[0] for t in found) / len(item_tokens)
            if found and coverage >= threshold:
                yield item_id, coverage, [{"item_start": i, "doc_start": int(where[j]), "words": n} for n, i, j in found]


def matches(docs: DataFrame, benchmark: DataFrame, store: Store, threshold: float = 0.5, least: int = MIN_MATCH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(text_key, item_id, coverage, tiles) for each text and benchmark item with enough of the item in the text.

    The benchmark is read in blocks of bounded text, each held by every task in turn while the documents are scanned once
    for it, so documents are never shuffled. The blocks grow in number, not in size.
    """
    spark, kind = docs.sparkSession, benchmark.schema["item_id"].dataType.simpleString()
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    schema, keyed = FOUND.format(kind=kind), docs.where("text is not null").select(text_key(F.col("text")).alias("text_key"), "text")
    found = None
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(Index([tuple(r) for r in part.select("item_id", "text").collect()], least))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows = [
                    (key.as_py(), *match) for key, text in zip(batch.column("text_key"), batch.column("text")) for match in index.search(text.as_py(), threshold)
                ]
                if rows:
                    keys, ids, coverage, spans = zip(*rows)
                    span = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array(ids), pa.array(coverage, pa.float64()), pa.array(spans, span)], ["text_key", "item_id", "coverage", "tiles"])

        here = store.keep(keyed.mapInArrow(run, schema).dropDuplicates(["text_key", "item_id"]))
        found = here if found is None else found.union(here)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, least: int = MIN_MATCH) -> DataFrame:
    """One row per document: doc_id, text_key, contaminated, item_id, coverage, n_items.

    A document is contaminated when tiles of at least ``least`` words cover ``threshold`` of the words of a benchmark item, in
    any order. Words are runs of letters, digits and underscores, lower-cased. item_id is the item with the highest coverage, the
    least id among equals; it is null, and coverage 0, when no item reaches the threshold. Items of fewer than ``least`` words
    and null texts match nothing. Repeated documents are judged alike; repeated items and null item ids count once per id. Empty tables give no
    rows, or no contaminated ones. Other columns are ignored.
    """
    store = Store(docs.sparkSession)
    found = matches(docs, benchmark, store, threshold, least)
    first = F.min(F.struct((-F.col("coverage")).alias("order"), "item_id"))
    best = found.groupBy("text_key").agg(first["item_id"].alias("item_id"), F.max("coverage").alias("coverage"), F.count(F.lit(1)).alias("n_items"))
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"))
    return keyed.join(best, "text_key", "left").select(
        "doc_id", "text_key", F.col("coverage").isNotNull().alias("contaminated"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
    )
