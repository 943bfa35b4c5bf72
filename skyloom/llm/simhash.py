"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016)."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from skyloom.llm.common import Aside, Store, text_key
from skyloom.llm.components import components

BITS = 64
SEED = 42


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included, as unsigned numbers.

    A-Z are lower-cased, words are runs of characters other than space and tab to carriage return. A text
    of fewer words than a shingle is one shingle, a text without words none.
    """
    # bytes.lower and bytes.split know ASCII letters and these blanks only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, span = b" ".join(words), max(len(words) - shingle + 1, 1)
    lengths = list(map(len, words))
    starts = list(itertools.accumulate(lengths[: span - 1], lambda at, n: at + n + 1, initial=0))
    last = min(shingle, len(words)) - 1
    ends = list(itertools.accumulate(lengths[last + 1 :], lambda at, n: at + n + 1, initial=sum(lengths[: last + 1]) + last))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, span)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit number: a bit is 1 if it is 1 in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):  # memory stays bounded on very long texts
        block = np.ascontiguousarray(hashes[at : at + 65536]).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id") -> DataFrame:
    """(key, fp) of every document; the fingerprint of a text without words, or of null, is zero."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(shingle_hashes(text.as_py(), shingle)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.int64())], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, fp long")


def covering_masks(radius: int, seed: int = SEED) -> list[int]:
    """The bits that each of the ``2^(radius+1) - 1`` tables compares.

    Every bit position has a vector of radius + 1 bits, not zero; table v compares the positions whose vector has
    an odd number of bits in common with v. At most ``radius`` differing positions give at most radius equations,
    so some v other than zero meets them all: that table compares none of the positions that differ.
    """
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    random.Random(seed).shuffle(vectors)
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def flips(free: list[int], most: int) -> list[int]:
    """All masks with at most ``most`` of the free bits set."""
    return [_signed(sum(1 << i for i in chosen)) for k in range(most + 1) for chosen in itertools.combinations(free, k)]


def links(prints: DataFrame, store: Store, radius: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly those within ``radius`` bits.

    Covering tables bring every such pair together in some bucket. Within a bucket pairs are not listed: a member is sent
    to all values that differ from it in up to radius/2 of the bits the table leaves out. Two members meet at a value
    exactly if they are within the radius (for an odd radius one of them is a step nearer), and all that
    meet there are linked to the least of the nearer ones. The work follows the number of members, whatever the size of
    a bucket.
    """
    if not 0 <= radius <= 5:
        raise ValueError("radius must be 0 to 5")
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket")) for t, m in enumerate(masks)])).alias("k")).select("fp", "k.*")
    shared = keyed.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").drop("members")
    members = store.keep(keyed.join(shared, ["table", "bucket"]))
    near, far = radius // 2, (radius + 1) // 2
    per_table: Column = F.lit(None)
    for t, m in enumerate(masks):
        free = [i for i in range(BITS) if not m >> i & 1]
        moves = F.array(*[F.lit(x) for x in flips(free, far)])
        per_table = F.when(F.col("table") == t, moves).otherwise(per_table)
    met = members.select("table", "bucket", "fp", F.explode(per_table).alias("move"))
    met = met.select("table", "bucket", "fp", F.col("fp").bitwiseXOR(F.col("move")).alias("value"), (F.bit_count("move") <= near).alias("nearer"))
    # A value names its bucket, so table and value are the key. Members alone at a value are dropped first.
    centre = met.groupBy("table", "value").agg(F.min(F.when(F.col("nearer"), F.col("fp"))).alias("centre"), F.count(F.lit(1)).alias("n"))
    centre = centre.where("n > 1 and centre is not null").drop("n")
    return met.join(centre, ["table", "value"]).where("fp <> centre").select(F.col("centre").alias("a"), F.col("fp").alias("b")).distinct()


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the least doc_id, null last, then the least text key.

    Groups are those of ``near_duplicates``; of equal rows one stays. All columns are kept, whatever their names.
    """
    store, aside = Store(docs.sparkSession), Aside(docs)
    keyed = aside.df.withColumn("text_key", text_key(F.col("text")))
    prints = store.keep(fingerprints(keyed, shingle, "text_key").distinct())
    roots = components(links(prints.select("fp").distinct(), store, radius), store).toDF("fp", "root")
    by_text = store.keep(prints.join(roots, "fp", "left").select("text_key", F.coalesce("root", "fp").alias("root")))
    joined = keyed.join(by_text, "text_key")
    first = F.min_by(F.struct(*aside.names), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    return aside.back(joined.groupBy("root").agg(first.alias("row")).select("row.*"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed), fingerprint (16 hex digits), component_id.

    Fingerprints at ``radius`` or fewer differing bits link; component_id is the least doc_id that links reach.
    Texts that are null, empty or without words have fingerprint zero and link like others. Repeated rows stay, each
    with its row; null doc_ids stay, have a component_id of their group's least id, and null if the group has no id. Tables
    without rows give none; other columns are ignored. Equal fingerprints are one node, so copies are never paired.
    """
    store = Store(docs.sparkSession)
    prints = store.keep(fingerprints(docs, shingle))
    nodes = store.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes.select("fp"), store, radius), store).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
