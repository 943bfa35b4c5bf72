"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


class Store:
    """Intermediate tables of one job, as parquet in the shared folder.

    A stored table survives the loss of executors and is read back column by column. ``drop`` removes
    tables that no later step reads, with the shuffle files that only they needed.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, compression: str = "zstd") -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.option("compression", compression).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.stored_path = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table.stored_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.tidy()

    def tidy(self) -> None:
        """Let Spark remove shuffle files of plans that are no longer referenced."""
        gc.collect()
        self.spark._jvm.System.gc()


def fold(key: Column, parts: int) -> Column:
    """crc32 of a key written as text, modulo ``parts``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions that hold about ``rows_per_task`` rows each, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def text_key(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, which stands for the text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class Aside:
    """A table with all columns but some renamed, so that an operator's own columns clash with none; ``back`` names them again."""

    def __init__(self, df: DataFrame, used: tuple[str, ...] = ("doc_id", "text")):
        self.original = df.columns
        seen: set[str] = set()
        self.names = [n if n in used and not (n in seen or seen.add(n)) else f"carried_{i}" for i, n in enumerate(df.columns)]
        self.df = df.toDF(*self.names)

    def back(self, df: DataFrame, *more: str) -> DataFrame:
        return df.select(*self.names, *more).toDF(*self.original, *more)

    def schema(self) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.df.schema.fields)
