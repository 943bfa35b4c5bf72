"""Spelling variants: words one edit apart, each rare one pointed at its common form.

Method (sorted-list dynamic programming). Within a group of words, the words are sorted; for each query word the
sorted list is scanned as if it were a trie. The edit rows of the banded dynamic programme (band width one: only
distances 0 and 1 matter) are kept per prefix length, so a vocabulary word reuses the rows of its predecessor up to
their longest common prefix and only computes the rows past it. When a row's smallest entry exceeds one edit, every
following word that shares this prefix is skipped at once (the end of that prefix's range is precomputed from the
adjacent common prefixes).

Groups. Cut the shorter word of a pair one edit apart (length m >= 7) into thirds A, B, C at floor(m / 3) and
floor(2m / 3): the edit touches one third, so the pair shares A and B (a prefix), or B and C (a suffix, aligned from
the end), or A and C. Each word therefore joins up to six groups: these three keys for m its length and its length
minus one (the suffix key written backwards, so that the sorted scan shares prefixes); a group compares only pairs
whose shorter word has length m. Groups of one word hold no pair and never leave the aggregate. A group of
more than ``most_in_group`` words is split: its words join instead the groups of their deletion variants (the word
and the word without one of its code points), which any two words one edit apart share; such a group holds at most
one word per inserted code point and place, so its size is bounded by the alphabet and the word length. No pair list
of a group is ever built; only pairs the scan confirms leave a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skyloom.llm.common import Store, ascii_lower

RUN = "([A-Za-z\\u00C0-\\u00FF]+)"
SHORTEST, LEAST_COUNT, FACTOR = 7, 2, 10
FAR = 2


def step(row: tuple[int, int, int], j: int, char: str, query: str) -> tuple[int, int, int]:
    """Band row j (distances of the vocabulary prefix of length j to query prefixes j-1, j, j+1) from row j - 1."""
    a, b, c = row
    lq = len(query)

    def cost(x: int) -> int:
        return (0 if query[x] == char else 1) if 0 <= x < lq else FAR

    low = j if j - 1 == 0 else min(a + cost(j - 2), b + 1) if j - 1 <= lq else FAR
    mid = min(b + cost(j - 1), c + 1, low + 1) if j <= lq else FAR
    high = min(c + cost(j), low + FAR, mid + 1) if j + 1 <= lq else FAR
    return min(low, FAR), min(mid, FAR), min(high, FAR)


def ranges(words: list[str]) -> tuple[list[int], list[list[int]]]:
    """Adjacent common prefixes and, for each word and prefix length d, the first later word not sharing that prefix."""
    g = len(words)
    lcp = [0] * (g + 1)
    for i in range(1, g):
        a, b = words[i - 1], words[i]
        k = 0
        while k < len(a) and k < len(b) and a[k] == b[k]:
            k += 1
        lcp[i] = k
    ends: list[list[int]] = [[]] * g
    for i in range(g - 1, -1, -1):
        shared = lcp[i + 1] if i + 1 < g else -1
        ends[i] = [ends[i + 1][d] if d <= shared else i + 1 for d in range(len(words[i]) + 1)]
    return lcp, ends


def scan(query: str, words: list[str], lcp: list[int], ends: list[list[int]]) -> list[str]:
    """The words of the sorted list exactly one edit from ``query``, by the trie scan with reused rows and skipped ranges."""
    lq = len(query)
    rows = [(FAR, 0, 1 if lq >= 1 else FAR)]
    found, i, computed = [], 0, 0
    while i < len(words):
        word = words[i]
        reuse = min(lcp[i], computed) if i else 0
        del rows[reuse + 1:]
        skipped = False
        for j in range(reuse + 1, len(word) + 1):
            row = step(rows[j - 1], j, word[j - 1], query)
            rows.append(row)
            if min(row) >= FAR:
                computed, i, skipped = j - 1, ends[i][j], True
                del rows[j:]
                break
        if skipped:
            continue
        computed = len(word)
        if abs(len(word) - lq) <= 1 and rows[len(word)][lq - len(word) + 1] == 1:
            found.append(word)
        i += 1
    return found


def near_in_groups(groups: list[tuple[list[str], int | None]]) -> list[tuple[str, str]]:
    """Pairs (a, b), a < b, one edit apart within each group (with a shorter length, only pairs whose shorter word has it).

    The scan of ``scan`` for all queries of all groups at once, level by level. The prefixes the sorted lists hold
    (a new one for each place past a word's common prefix with its predecessor) are the nodes; each node holds the
    band rows of the queries of its group still within one edit, computed once from its parent's and shared by all
    words below it; a query that leaves the band is dropped for the node's whole range. One level costs a few array
    operations over all surviving (prefix, query) rows of the partition.
    """
    words, owners, shorter_of = [], [], []
    for group, (members, shorter) in enumerate(groups):
        ordered = sorted(set(members))
        words.extend(ordered)
        owners.extend([group] * len(ordered))
        shorter_of.append(-1 if shorter is None else shorter)
    if not words:
        return []
    n, roots = len(words), len(groups)
    length_a, owner_a = np.array([len(w) for w in words], np.int64), np.array(owners, np.int64)
    shorter_a = np.array(shorter_of, np.int64)[owner_a]
    longest = int(length_a.max())
    width = longest + 2
    # code points in rows of equal width (0 pads: no letter)
    table = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), dtype=np.uint32).reshape(n, width).astype(np.int64)
    lcp = np.zeros(n, np.int64)
    if n > 1:
        differ = table[1:] != table[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp[1:] = np.minimum(first, np.minimum(length_a[1:], length_a[:-1]))
        lcp[1:][owner_a[1:] != owner_a[:-1]] = 0
    count = length_a - lcp  # new prefixes of each word
    base = roots + np.cumsum(count) - count
    # the word where the prefix a word continues from was first met: the last earlier word of the group with a smaller lcp
    origin = np.arange(n)
    stack: list[int] = []
    for k in range(n):
        if k == 0 or owners[k] != owners[k - 1]:
            stack = []
        while stack and lcp[stack[-1]] >= lcp[k]:
            stack.pop()
        origin[k] = stack[-1] if stack else k
        stack.append(k)
    total = roots + int(count.sum())
    parent_a, char_a, depth_a, end_a = (np.full(total, -1, np.int64) for _ in range(4))
    depth_a[:roots] = 0
    word_of = np.repeat(np.arange(n), count)
    within = np.arange(len(word_of)) - np.repeat(base - roots, count)
    depth = lcp[word_of] + 1 + within
    ids = roots + np.arange(len(word_of))
    depth_a[ids], char_a[ids] = depth, table[word_of, depth - 1]
    parent_a[ids] = ids - 1
    starts = within == 0
    k = word_of[starts]
    o = origin[k]
    parent_a[ids[starts]] = np.where(lcp[k] == 0, owner_a[k], base[o] + lcp[k] - lcp[o] - 1)
    end_a[np.where(length_a > 0, base + length_a - lcp - 1, owner_a)] = np.arange(n)
    found: list[tuple[int, int]] = []

    def report(node, query, band, d):
        word = end_a[node]
        hit = word >= 0
        node, query, band, word = node[hit], query[hit], band[hit], word[hit]
        near = np.abs(length_a[query] - d) <= 1
        query, band, word = query[near], band[near], word[near]
        value = band[np.arange(len(query)), length_a[query] - d + 1]
        ok = (value == 1) & (query < word)
        ok &= (shorter_a[query] < 0) | (np.minimum(length_a[query], length_a[word]) == shorter_a[query])
        found.extend(zip(query[ok].tolist(), word[ok].tolist()))

    query = np.arange(len(words))
    node = owner_a.copy()
    band = np.stack([np.full(len(words), FAR), np.zeros(len(words), np.int64), np.where(length_a >= 1, 1, FAR)], axis=1)
    report(node, query, band, 0)
    order = np.argsort(node, kind="stable")
    node, query, band = node[order], query[order], band[order]
    for d in range(1, longest + 1):
        children = np.nonzero(depth_a == d)[0]
        if len(children) == 0 or len(node) == 0:
            break
        left = np.searchsorted(node, parent_a[children], "left")
        count = np.searchsorted(node, parent_a[children], "right") - left
        which = np.repeat(np.arange(len(children)), count)
        entry = left[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        child, q, a, b, c = children[which], query[entry], band[entry, 0], band[entry, 1], band[entry, 2]
        letter, lq = char_a[child], length_a[q]

        def cost(x: int):
            if x < 0:
                return np.full(len(q), FAR)
            return np.where(x < lq, (table[q, x] != letter).astype(np.int64), FAR)

        low = np.ones(len(q), np.int64) if d == 1 else np.where(d - 1 <= lq, np.minimum(a + cost(d - 2), b + 1), FAR)
        mid = np.where(d <= lq, np.minimum(np.minimum(b + cost(d - 1), c + 1), low + 1), FAR)
        high = np.where(d + 1 <= lq, np.minimum(c + cost(d), mid + 1), FAR)
        new = np.minimum(np.stack([low, mid, high], axis=1), FAR)
        keep = new.min(axis=1) < FAR
        node, query, band = child[keep], q[keep], new[keep]
        report(node, query, band, d)
    return [(words[a], words[b]) for a, b in found]


def near_in_group(words: list[str], shorter: int | None) -> list[tuple[str, str]]:
    """Pairs (a, b), a < b, of one group one edit apart; with ``shorter``, only pairs whose shorter word has that length."""
    return near_in_groups([(words, shorter)])


def _pairs_in_partition(batches):
    """Pairs of all groups of a partition: consecutive rows of one (m, backwards, key) form a group; the groups of
    each batch go through ``near_in_groups`` together, a group cut by the batch's end waits for the next batch."""
    current, members = None, []
    for batch in batches:
        groups, found = [], []
        for m, backwards, key, word in zip(batch["m"], batch["backwards"], batch["key"], batch["word"]):
            group = (int(m), bool(backwards), key)
            if group != current:
                if current is not None and len(members) >= 2:
                    groups.append((current, members))
                current, members = group, []
            members.append(word)
        yield pd.DataFrame(pairs_of(groups), columns=["a", "b"])
    yield pd.DataFrame(pairs_of([(current, members)] if current is not None and len(members) >= 2 else []), columns=["a", "b"])


def pairs_of(groups) -> list[tuple[str, str]]:
    forward = [(members, m if m > 0 else None) for (m, backwards, _), members in groups if not backwards]
    backward = [([w[::-1] for w in members], m if m > 0 else None) for (m, backwards, _), members in groups if backwards]
    return near_in_groups(forward) + [tuple(sorted((a[::-1], b[::-1]))) for a, b in near_in_groups(backward)]


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per letter run of every whole text (null text: none), A-Z lower-cased, with the planted deletion applied.

    h is the unsigned crc32 of ``<doc_id>:<run>``; when 31 divides h the code point at h % length goes. A null
    doc_id gives a null h: nothing is deleted from its runs.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(RUN), 1)).alias("run"))
    lowered = runs.select("doc_id", ascii_lower(F.col("run")).alias("low"))
    hashed = lowered.select("low", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("low")).cast("binary")).alias("h"))
    cut = F.expr("concat(substring(low, 1, cast(h % length(low) as int)), substring(low, cast(h % length(low) as int) + 2))")
    return hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("low")).alias("word"))


def pieces(word: Column, m: Column) -> list[Column]:
    """The three keys of a word for shorter length m: its first two thirds, its last two thirds written backwards, and
    its first and last thirds; two words one edit apart, the shorter of length m, share at least one of them."""
    a, b = F.floor(m / 3).cast("int"), F.floor(2 * m / 3).cast("int")
    size = F.length(word)
    last = lambda count: F.substring(word, size - count + 1, count)
    return [
        F.struct(F.lit(False).alias("backwards"), F.concat(F.lit("<"), F.substring(word, 1, b)).alias("key")),
        F.struct(F.lit(True).alias("backwards"), F.concat(F.lit(">"), F.reverse(last(m - a))).alias("key")),
        F.struct(F.lit(False).alias("backwards"), F.concat(F.lit("|"), F.substring(word, 1, a), F.lit("|"), last(m - b)).alias("key")),
    ]


def near_pairs(vocabulary: DataFrame, most_in_group: int = 5_000) -> DataFrame:
    """All pairs (a, b), a < b, of distinct vocabulary words exactly one edit apart.

    Groups of one word are dropped before they move (they hold no pair); the others are dealt by key and each
    partition, sorted by group, is scanned group after group in one Python worker.
    """
    spark = vocabulary.sparkSession
    length = F.length("word")
    sized = vocabulary.select("word").withColumn("m", F.explode(F.array(length, length - 1))).where(F.col("m") >= SHORTEST)
    keyed = sized.select("word", "m", F.explode(F.array(*pieces(F.col("word"), F.col("m")))).alias("k")).select("word", "m", "k.backwards", "k.key")
    sizes = keyed.groupBy("m", "backwards", "key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= 2)
    marked = keyed.join(sizes, ["m", "backwards", "key"])
    calm = marked.where(F.col("members") <= most_in_group).select("m", "backwards", "key", "word")
    hot = marked.where(F.col("members") > most_in_group).select("word").distinct()
    variants = hot.select("word", F.explode(F.array_union(F.array(F.col("word")), F.expr(
        "transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1)))"))).alias("key"))
    variant_sizes = variants.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= 2)
    split = variants.join(variant_sizes, "key").select(F.lit(0).alias("m"), F.lit(False).alias("backwards"), "key", "word")
    grouped = calm.unionByName(split)
    parts = spark.sparkContext.defaultParallelism * 2
    dealt = grouped.repartition(parts, "m", "backwards", "key").sortWithinPartitions("m", "backwards", "key")
    return dealt.mapInPandas(_pairs_in_partition, "a string, b string").distinct()


def spelling_variants(docs: DataFrame, most_in_group: int = 5_000) -> DataFrame:
    """Every word of the corpus (distinct runs of >= 7 code points seen >= 2 times) with its common form and root.

    n counts the word's occurrences over all documents; n_near its words one edit away (0 if none). The form is the
    near word of largest n (ties: the smallest in code-point order) when that n is at least 10 times the word's,
    else null (form_n null too); the root follows forms to the last one (the word itself when it has no form).
    Forms always lead to a strictly larger n, so roots are reached in at most log10 of the largest n steps.
    Texts may be null (no runs), empty or of any length; repeated rows count each time; other columns are ignored.
    """
    counts = occurrences(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = counts.where((F.length("word") >= SHORTEST) & (F.col("n") >= LEAST_COUNT))
    pairs = near_pairs(vocabulary, most_in_group)
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partner_n = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    linked = both.join(partner_n, "b")
    best = linked.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min_by(F.struct("b", "b_n"), F.struct((-F.col("b_n")).alias("rank"), F.col("b"))).alias("top"))
    words = (vocabulary.join(best.withColumnRenamed("a", "word"), "word", "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(F.col("top.b_n") >= FACTOR * F.col("n"), F.col("top.b")).alias("form"),
                     F.when(F.col("top.b_n") >= FACTOR * F.col("n"), F.col("top.b_n")).alias("form_n")))
    return with_roots(words)


def with_roots(words: DataFrame) -> DataFrame:
    """Roots by pointer doubling over the form links: each round a word's pointer jumps to its pointer's pointer."""
    spark = words.sparkSession
    store = Store(spark)
    words = store.keep(words)
    pointer = words.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        ahead = pointer.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pointer.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        moved = store.keep(moved)
        if moved.where(F.col("moved")).isEmpty():
            break
        pointer = moved.select("word", "root")
    return words.join(moved.select("word", "root"), "word").select("word", "form", "root", "n", "n_near", "form_n")
