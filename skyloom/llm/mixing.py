"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skyloom.llm.common import Store

#: Documents of one source and hash range that one window orders.
RANGE_ROWS = 4096


def word_count(text) -> F.Column:
    """Number of runs of characters other than space and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source by code point, null last, from 0.

    Sources are counted per first character and ordered within it, so one task orders only sources that
    begin alike. Binary order of UTF-8 is code point order.
    """
    sources = sources.withColumn("head", F.substring("source", 1, 1))
    heads = sources.groupBy("head").agg(F.count(F.lit(1)).alias("in_head"))
    before = heads.select("head", (F.sum("in_head").over(Window.orderBy(F.col("head").asc_nulls_last())) - F.col("in_head")).alias("before"))
    within = Window.partitionBy("head").orderBy("source")
    ranked = sources.withColumn("within", F.row_number().over(within) - 1)
    joined = ranked.join(before.withColumnRenamed("head", "h"), F.col("head").eqNullSafe(F.col("h")))
    return joined.withColumn("place", F.col("before") + F.col("within")).drop("head", "h", "before", "within")


def water_fill(sources: DataFrame, store: Store, total: int, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    The amount ``share * total`` is divided by weight; a source whose part exceeds ``max_epochs`` times its
    size is clamped there, and what is left is divided among the others again until none exceeds. Each
    round sends two sums to the driver and clamps a source at least.
    """
    sources = store.keep(sources)
    cap = F.col("source_size") * F.lit(max_epochs)
    clamped = F.lit(False)
    level, count = 0.0, -1
    while True:
        row = sources.agg(F.sum(F.when(~clamped, F.col("weight"))).alias("w"), F.sum(F.when(clamped, cap)).alias("c"), F.count_if(clamped).alias("n")).first()
        if row["n"] == count or not row["w"]:
            break
        level, count = max(share * total - (row["c"] or 0), 0.0) / row["w"], row["n"]
        clamped = F.col("weight") * F.lit(level) > cap
    return sources.withColumn("target", F.when(clamped, cap).otherwise(F.col("weight") * F.lit(level)).cast("double"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2, seed: int = 7, columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, ``columns``, size, source_size, target, whole, part_words, taken.

    Sizes are words of the whole text. Sources, ordered by code point with null last, take ``weights`` in turn and
    share ``share`` times the words of all documents, none beyond ``max_epochs`` times its own words
    (``water_fill``). A source's target is then filled by ``whole`` repetitions of all its documents and a last,
    fractional one: documents in a seeded order are taken whole until the rest of the target is reached, and the
    document at that border gives its first ``part_words`` words. So ``taken`` of a source sums to its
    target, rounded, and no document gives more than ``max_epochs`` times its size. The order is
    md5(seed:doc_id), then doc_id and size: reruns agree; rows that agree in all three are
    interchangeable.

    Null texts and texts of blanks have size 0 and give nothing. A null source is a source of its own; a null doc_id is
    ordered as the text ``null``. Repeated rows are documents of their own. No documents: no rows. Other columns of
    the input are ignored.

    A hot source is never gathered: its documents are summed per hash range, the ranges are summed up in order,
    and only documents of one range are ordered by one task. Ranges grow in number with the documents.
    """
    store = Store(docs.sparkSession)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    sized = docs.select("doc_id", "source", *columns, word_count(F.col("text")).alias("size"), order.alias("place_key"))
    slim = store.keep(sized.select("doc_id", "source", "size", "place_key"))
    row = slim.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).first()
    total, digits = row["s"] or 0, max(1, math.ceil(math.log(max(row["n"], 1) / RANGE_ROWS, 16))) if row["n"] > RANGE_ROWS else 1
    keys = {
        "range": F.substring("place_key", 1, digits),
        # One join key for each source, null included.
        "source_key": F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")),
    }
    slim = slim.withColumns(keys)
    ranges = store.keep(slim.groupBy("source_key", "source", "range").agg(F.sum("size").alias("range_size")))
    sources = _ranked(ranges.groupBy("source_key", "source").agg(F.sum("range_size").alias("source_size")))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    filled = water_fill(sources.drop("place"), store, total, share, max_epochs)
    words = F.round("target").cast("long")
    filled = filled.select(
        "source_key", "source_size", "target", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long").alias("whole"), words.alias("words"),
    ).withColumn("rest", F.when(F.col("source_size") > 0, F.col("words") - F.col("whole") * F.col("source_size")).otherwise(0))
    before = F.sum("range_size").over(Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select("source_key", "range", F.coalesce(before, F.lit(0)).alias("before")).join(filled, "source_key")
    inside = Window.partitionBy("source_key", "range").orderBy("place_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = sized.withColumns(keys) if columns else slim
    ordered = rows.withColumn("upto", F.sum("size").over(inside)).join(starts, ["source_key", "range"])
    part = F.greatest(F.lit(0), F.least("size", F.col("rest") - (F.col("before") + F.col("upto") - F.col("size"))))
    return ordered.withColumn("part_words", part.cast("long")).select(
        "doc_id", "source", *columns, "size", "source_size", "target", "whole", "part_words", (F.col("whole") * F.col("size") + F.col("part_words")).alias("taken"),
    )
