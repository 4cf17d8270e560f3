"""Session settings the library counts on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that matter for results or for skew; a cluster keeps its own sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench, with a checkpoint folder of its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyworks")
    settings = SETTINGS | {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checkpoints-"),
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The folder is the one named in ``spark.checkpoint.dir``; files there outlive
    a lost executor. Where it is not set, a session in one process gets a folder of its own,
    any other an error.
    """
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def _checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or "cluster" in context.master:
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder."""
    return f"{_checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table of its own in the shared checkpoint folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a caller's own session the settings the library counts on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
