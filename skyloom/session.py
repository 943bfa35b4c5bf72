"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SETTINGS = {
    # Wall-clock and instant columns are told apart by type, so the session stays in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys beyond the broadcast bound are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods beyond this size are never compiled to machine code; Spark then runs the
    # operators one by one, which is faster for the wide projections used here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A re-run of one date must replace that date only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names.

    Only threads of this one process may do without: they get a temporary folder, removed at exit.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    in_use = context.getCheckpointDir()
    if in_use is None:
        if not named:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="skyloom-checkpoints-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return named or in_use


def settle(df: DataFrame) -> DataFrame:
    """Compute a small table once and keep it in the shared folder: lost executors cost no recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_owners: list[list[str]] = []


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the length of the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, reader: SparkSession | None = None) -> DataFrame:
    """Compute a large table once and keep it as parquet in the shared folder.

    For tables that are read several times afterwards: each reading scans only its columns. The table stays
    until the ``scratch`` block it was made in ends; without one, until the folder is cleared. ``reader``: the session
    that reads it and plans what follows, instead of the one of ``df``.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    df.write.parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Own the tables stored in the block: they are deleted at its end, so results must be written within it."""
    own: list[str] = []
    _owners.append(own)
    try:
        yield
    finally:
        _owners.remove(own)
        for path in own:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a stored table, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
