"""Writers. Each returns the number of rows written, taken during the write."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    counter = Observation()
    write(df.observe(counter, F.count(F.lit(1)).alias("rows")))
    return counter.get["rows"]


def stamp(df: DataFrame, pulled_at: datetime, column: str = "pulled_at") -> DataFrame:
    """Add the ingest time. It is an argument, so a rerun writes the same rows."""
    return df.withColumn(column, F.lit(pulled_at).cast("timestamp"))


def overwrite_parquet(df: DataFrame, path: str) -> int:
    return _counted(df, lambda out: out.write.mode("overwrite").parquet(path))


def append_snapshot(df: DataFrame, path: str, time_column: str = "timestamp") -> int:
    """Append to Parquet, one folder per ingest date; creates it on the first run."""
    dated = df.withColumn("ingest_date", F.to_date(time_column))
    return _counted(dated, lambda out: out.write.mode("append").partitionBy("ingest_date").parquet(path))


def write_pull(df: DataFrame, path: str, column: str) -> int:
    """Write Parquet in one folder per value of ``column``; folders that ``df`` has rows for are replaced."""
    def write(out: DataFrame) -> None:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)

    return _counted(df, write)


def pull_is_there(spark: SparkSession, path: str, column: str, pull: str) -> bool:
    """Whether the files under ``path`` hold rows of a pull; no files, no rows."""
    try:
        return spark.read.parquet(path).filter(F.col(column) == pull).limit(1).count() > 0
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def jdbc_append(rows: DataFrame, settings: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**settings).mode("append").save()


def append_table(
    df: DataFrame, url: str, name: str, columns: Sequence[str] | None = None, batch: int = 10_000, **options: str
) -> int:
    """Append the listed columns to a database table, in batches over JDBC.

    Every partition is one connection and one transaction (``numPartitions``
    limits them). A task repeated after a late failure may append its rows
    twice; readers that mind take the latest row per key.
    """
    rows = df.select(*columns) if columns else df
    settings = {"url": url, "dbtable": name, "batchsize": str(batch)} | options
    return _counted(rows, lambda out: jdbc_append(out, settings))


def overwrite_csv(df: DataFrame, path: str) -> int:
    return _counted(df, lambda out: out.write.mode("overwrite").option("header", True).csv(path))
