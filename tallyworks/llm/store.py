"""Intermediate tables in the shared folder, and the size of Arrow batches."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch: texts can be long, and a batch is held whole.
BATCH_ROWS = 500


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallyworks-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Where it is not set a folder of this machine is made, which only a session
    in one process (``local[n]``) may use; any other session gets an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here.

    The files outlive a lost executor, and later steps read only the columns
    they need. The tables stay until the owner of the folder removes them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tallyworks/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alternating(spark: SparkSession, name: str):
    """A function like ``save`` for a state that replaces itself: it writes to two tables in turn.

    A state may be made from the one written before it, and from nothing older: that is overwritten.
    """
    paths = [f"{shared_folder(spark).rstrip('/')}/tallyworks/{name}-{uuid.uuid4().hex}-{i}" for i in range(2)]

    def write(df: DataFrame) -> DataFrame:
        path = paths[0]
        paths.reverse()
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write


def small_batches(df: DataFrame) -> DataFrame:
    """Have the session hand Python no more than ``BATCH_ROWS`` texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))
    return df
