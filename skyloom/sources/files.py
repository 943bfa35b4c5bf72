"""CSV and parquet tables, snapshots, and the raw / processed layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyloom.constants import GENERATION_STAMP
from skyloom.functions.values import without_nan
from skyloom.operators.shaping import stack, trimmed_names


class EmptyTable(ValueError):
    """A table that must hold rows holds none."""


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    sep: str = ",",
    trim: bool = False,
) -> DataFrame:
    """CSV with header. Without a schema every column is text; empty fields are null.

    ``trim`` removes blanks around names and values. A byte-order mark is ignored.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", False)
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if schema is not None and not trim:
        return without_nan(reader.schema(schema).csv(path))
    df = reader.csv(path)
    if trim:
        df = trimmed_names(df)
        df = df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns])
    if schema is not None:
        kinds = {f.name: f.dataType for f in schema.fields}
        df = df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])
    return without_nan(df)


def read_table(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet table; an empty one is an error."""
    df = spark.read.parquet(*paths)
    if df.isEmpty():
        raise EmptyTable(f"no rows in {', '.join(paths)}")
    return without_nan(df)


def read_all(spark: SparkSession, groups: Sequence[Sequence[str]], sep: str = ",") -> DataFrame:
    """Files of one kind as one table; each group of files may have its own columns."""
    return stack(*[read_csv(spark, list(paths), sep=sep) for paths in groups])


def latest_file(spark: SparkSession, folder: str, pattern: str = "*", by: str = "time") -> str | None:
    """Path of the newest file, by modification time or by name. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )
    key = F.struct("modificationTime", "path") if by == "time" else F.col("path")
    return files.agg(F.max_by("path", key).alias("path")).first()["path"]


def latest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest snapshot of a table that keeps all of them."""
    newest = df.agg(F.max(column).alias("__newest"))
    # One aggregate row.
    return df.join(F.broadcast(newest), F.col(column) == F.col("__newest"), "left_semi")


def without_stamp(df: DataFrame) -> DataFrame:
    """Drop the generation row that older files carry above their data."""
    first = F.col(f"`{df.columns[0]}`").cast("string")
    return df.where(~first.eqNullSafe(F.lit(GENERATION_STAMP)))


def stamped(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn("generated_at", F.lit(at).cast("timestamp"))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with header in as many files as the table has partitions."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_layer(df: DataFrame, root: str, layer: str, run_date: str, request_id: str | None = None) -> str:
    """Write one run to ``root/layer``; a repeated run replaces its own partition only."""
    if layer not in ("raw", "processed"):
        raise ValueError("layer is raw or processed")
    path = f"{root}/{layer}"
    keyed = df.withColumn("run_date", F.lit(run_date))
    keys = ["run_date"]
    if request_id is not None:
        keyed, keys = keyed.withColumn("request_id", F.lit(request_id)), [*keys, "request_id"]
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return path


def read_layer(
    spark: SparkSession, root: str, layer: str, run_date: str | None = None, request_id: str | None = None
) -> DataFrame:
    """Read a layer; the run's date and request prune partitions."""
    df = spark.read.parquet(f"{root}/{layer}")
    if run_date is not None:
        df = df.where(F.col("run_date") == F.lit(run_date).cast(df.schema["run_date"].dataType))
    if request_id is not None:
        df = df.where(F.col("request_id") == request_id)
    return df
