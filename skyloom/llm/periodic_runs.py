"""Periodic runs of words: stretches that repeat one block of words at least four times.

Method (dyadic square catching). A run of smallest period q and length at least 4q holds at least 3q consecutive
places j with word j equal to word j + q. Periods are taken in dyadic classes [2^k, 2^(k+1)); for class k a catcher
sits at every completed block boundary, that is at every multiple s of 2^k, and compares word s with word s + q for
each q of the class. Any run of the class holds such a boundary among its matching places, so every run is caught
at least once. A caught pair is widened to the whole stretch by two longest-common-extension comparisons (forward
and backward, on prefix hashes of the word ids, then confirmed word by word), which reports the maximal stretch of
period q. A stretch is kept when its length reaches max(6, 4q) and no q / f (f a prime factor of q) is also a
period: by the theorem of Fine and Wilf a smaller period of a stretch this long would divide q.

The catchers of all classes are placed per document in one pass over its words (vectorised with numpy), not
word by word as an online catcher would be; the caught set and the runs are the same. Each document is one row
and is handled inside the task that reads it: nothing is shuffled, a long document costs O(n log n) comparisons.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import Aside

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHORTEST, LEAST_EXPONENT = 6, 4
MOD_A, MOD_B, BASE_A, BASE_B = 2_147_483_629, 2_147_483_587, 1_000_003, 999_983
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def plant_key(doc_id) -> int | None:
    """crc32 of the decimal id, unsigned; None for a null id."""
    return None if doc_id is None else zlib.crc32(str(int(doc_id)).encode())


def planted(words: list[str], h) -> list[str]:
    """The words a document is judged on: for one id in ten the tail from word a on repeats words a .. a + p - 1.

    h = crc32(decimal doc_id) (``plant_key``), g = h // 10; when h % 10 == 0 and there are n > 0 words,
    a = g % n and p = 1 + (n - a) // (3 + g % 8). A null id (h null) plants nothing.
    """
    n = len(words)
    if h is None or pd.isna(h) or n == 0:
        return words
    h = int(h)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


class Extension:
    """Longest common extensions between places of one word sequence, by two polynomial prefix sums, confirmed word by word.

    S[t] = sum of v[u] * B^u over u < t (mod P); words i .. i+l-1 equal j .. j+l-1 (i < j) when
    (S[i+l] - S[i]) * B^(j-i) = S[j+l] - S[j] for both moduli. All sums and powers are built with numpy.
    """

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.sums, self.powers = [], []
        for mod, base in ((MOD_A, BASE_A), (MOD_B, BASE_B)):
            power = powers_of(base, mod, self.n + 1)
            terms = ((ids % mod) + 1) * power[: self.n] % mod
            self.sums.append(np.concatenate([[0], np.cumsum(terms) % mod]))
            self.powers.append(power)

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        equal = np.ones(len(i), bool)
        for (mod, _), sums, power in zip(((MOD_A, BASE_A), (MOD_B, BASE_B)), self.sums, self.powers):
            left = (sums[i + length] - sums[i]) % mod * power[j - i] % mod
            right = (sums[j + length] - sums[j]) % mod
            equal &= left == right
        return equal

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Largest l with words i .. i+l-1 equal to j .. j+l-1 (i < j), for arrays of places."""
        low, high = np.zeros_like(i), self.n - np.maximum(i, j)
        while True:
            open_ = np.nonzero(low < high)[0]
            if len(open_) == 0:
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            ok = self.same(i[open_], j[open_], mid)
            low[open_] = np.where(ok, mid, low[open_])
            high[open_] = np.where(ok, high[open_], mid - 1)

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Largest l with words i-l .. i-1 equal to j-l .. j-1 (i < j)."""
        low, high = np.zeros_like(i), np.minimum(i, j)
        while True:
            open_ = np.nonzero(low < high)[0]
            if len(open_) == 0:
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            ok = self.same(i[open_] - mid, j[open_] - mid, mid)
            low[open_] = np.where(ok, mid, low[open_])
            high[open_] = np.where(ok, high[open_], mid - 1)


def powers_of(base: int, mod: int, count: int) -> np.ndarray:
    """base^0 .. base^(count-1) mod ``mod``, by doubling blocks."""
    power = np.ones(max(count, 1), np.int64)
    size, step = 1, base % mod
    while size < count:
        take = min(size, count - size)
        power[size:size + take] = power[:take] * step % mod
        size += take
        step = step * step % mod
    return power[:count]


def prime_factors(q: int) -> list[int]:
    found, f = [], 2
    while f * f <= q:
        if q % f == 0:
            found.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return found + ([q] if q > 1 else [])


def is_period(ids: np.ndarray, start: int, length: int, q: int) -> bool:
    return bool(np.array_equal(ids[start:start + length - q], ids[start + q:start + length]))


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of an id sequence, sorted by start, then period."""
    n = len(ids)
    if n < SHORTEST:
        return []
    places, periods = [], []
    k = 0
    while (1 << k) * LEAST_EXPONENT <= n:
        block = 1 << k
        qs = np.arange(block, min(2 * block, n // LEAST_EXPONENT + 1))
        if len(qs):
            s, q = np.meshgrid(np.arange(0, n, block), qs, indexing="ij")
            s, q = s.ravel(), q.ravel()
            inside = s + q < n
            s, q = s[inside], q[inside]
            caught = ids[s] == ids[s + q]
            places.append(s[caught])
            periods.append(q[caught])
        k += 1
    found: set[tuple[int, int, int]] = set()
    if places:
        s, q = np.concatenate(places), np.concatenate(periods)
        # a stretch of period q needs 3q matches (and 6 - q): drop catches whose neighbours already differ
        after = s + 1 + q < n
        nxt = np.zeros(len(s), bool)
        nxt[after] = ids[s[after] + 1] == ids[s[after] + 1 + q[after]]
        before = s > 0
        prv = np.zeros(len(s), bool)
        prv[before] = ids[s[before] - 1] == ids[s[before] - 1 + q[before]]
        s, q = s[nxt | prv], q[nxt | prv]
        if len(s):
            ext = Extension(ids)
            right, left = ext.forward(s, s + q), ext.backward(s, s + q)
            start, length = s - left, left + right + q
            keep = length >= np.maximum(SHORTEST, LEAST_EXPONENT * q)
            found.update(zip(start[keep].tolist(), length[keep].tolist(), q[keep].tolist()))
    runs = []
    for start, length, q in found:
        end = start + length
        maximal = (is_period(ids, start, length, q) and (start == 0 or ids[start - 1] != ids[start - 1 + q])
                   and (end == n or ids[end] != ids[end - q]))
        if not maximal:
            # a hash collision gave a wrong extension: measure this stretch word by word
            start, end = exact_stretch(ids, start, q)
            length = end - start
            if length < max(SHORTEST, LEAST_EXPONENT * q):
                continue
        if any(is_period(ids, start, length, q // f) for f in prime_factors(q)):
            continue
        runs.append((start, length, q))
    return sorted(set(runs), key=lambda r: (r[0], r[2]))


def exact_stretch(ids: np.ndarray, place: int, q: int) -> tuple[int, int]:
    start, end = place, place
    while start > 0 and ids[start - 1] == ids[start - 1 + q]:
        start -= 1
    while end + q < len(ids) and ids[end] == ids[end + q]:
        end += 1
    return start, end + q


def describe(h, text) -> dict:
    """The runs of one document (h: its ``plant_key``) and what stays when each run keeps only its first period."""
    words = planted(WORD.findall(text) if isinstance(text, str) else [], h)
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    runs = runs_of(ids)
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        dropped[start + q] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped)[: len(words)] == 0
    kept = " ".join(w for w, k in zip(words, keep) if k)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listing = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    return {
        "n_words": len(words), "n_runs": len(runs),
        "start": best[0] if best else None, "length": best[1] if best else None, "period": best[2] if best else None,
        "exponent_milli": 1000 * best[1] // best[2] if best else None,
        "runs": [{"start": s, "length": l, "period": q} for s, l, q in runs],
        "runs_sha256": hashlib.sha256(listing.encode()).hexdigest() if runs else EMPTY_SHA,
        "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest(),
        "n_dropped": int((~keep).sum()),
    }


RESULT = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, collapsed_sha256 string, n_dropped long")
NAMES = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "runs_sha256", "collapsed_sha256", "n_dropped"]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Every document with its periodic runs of words.

    Words are runs of characters other than ASCII blanks (space, tab to carriage return); a null text has no word
    and an empty one none either (n_runs 0, the four fields of the longest run null, runs_sha256 the digest of
    nothing, collapsed_sha256 that of the empty text). A run is a maximal stretch of smallest period q and length at
    least max(6, 4q); the longest run is chosen by length, then smallest start, then period. A word is dropped when
    a run holds it after that run's first q words; collapsed_sha256 digests the kept words joined by one space.
    Rows are kept one to one, repeated rows and null ids included (a null id plants nothing, see ``planted``);
    other columns ride along, also when their names clash with the result's (they are renamed aside and back).
    """
    aside = Aside(docs)
    keyed = aside.df.withColumn("plant_key", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    width = len(aside.names)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [describe(h, t) for h, t in zip(batch["plant_key"], batch["text"])]
            yield pd.concat([batch.iloc[:, :width].reset_index(drop=True), pd.DataFrame(found, columns=NAMES)], axis=1)

    result = keyed.mapInPandas(each, f"{aside.schema()}, {RESULT}")
    return aside.back(result, *NAMES)
