"""Structured Streaming over landed files, one run per schedule tick.

Each job reads only files it has not seen, ends when they are done, and keeps
its progress in a checkpoint folder, so it can be run again after any failure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyworks.functions.nested import flatten
from tallyworks.functions.nulls import nan_to_null
from tallyworks.functions.recode import month_of
from tallyworks.sources.writers import write_pull


def landed_records(spark: SparkSession, landing: str, page: T.StructType, items: str) -> DataFrame:
    """Streaming twin of reading landed JSON pages: one flat row per record,
    with ``timestamp`` the time its file landed. A page that does not parse stops the query: its
    file counts as unread, and the next run meets it again."""
    pages = (
        spark.readStream.schema(page)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(landing)
        .withColumn("timestamp", F.col("_metadata.file_modification_time"))
    )
    records = pages.select("timestamp", F.explode(items).alias("record")).select("record.*", "timestamp")
    return nan_to_null(flatten(records))


def drop_repeats(records: DataFrame, keys: Sequence[str], time_column: str, horizon: str) -> DataFrame:
    """Drop records pulled again within the horizon; state older than it is freed."""
    return records.withWatermark(time_column, horizon).dropDuplicatesWithinWatermark(list(keys))


def changed_only(records: DataFrame, keys: Sequence[str], time_column: str, horizon: str) -> DataFrame:
    """Only records that differ from the last one of their key, the time aside.

    Keyed state holds a digest and the time of each key's last record. Records of a batch are taken in order of time; one
    older than the last of its key changes nothing. A key that has not come for ``horizon`` is forgotten, and its next record counts as new.
    Keys may be null. Columns must be such as pandas can hold; nested ones are flattened before.
    """
    rest = [c for c in records.columns if c not in (time_column, *keys)]
    content = F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256) if rest else F.lit("")
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    told = records.withWatermark(time_column, horizon).select("*", content.alias("_digest"), named.alias("_key"))
    columns = records.columns
    span = _milliseconds(records.sparkSession, horizon)

    def changes(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        digest, seen = state.get if state.exists else (None, None)
        for rows in frames:
            rows = rows.sort_values([time_column, "_digest"], kind="stable")
            kept = []
            for now, found in zip(rows[time_column].map(lambda t: t.value), rows["_digest"]):
                newer = seen is None or now >= seen
                kept.append(newer and found != digest)
                if newer:
                    digest, seen = found, now
            if any(kept):
                yield rows.loc[kept, columns]
        state.update((digest, seen))
        state.setTimeoutTimestamp(max(seen // 1_000_000, state.getCurrentWatermarkMs()) + span)

    return told.groupBy("_key").applyInPandasWithState(
        changes, records.schema, "digest string, seen long", "append", GroupStateTimeout.EventTimeTimeout
    )


def _milliseconds(spark: SparkSession, horizon: str) -> int:
    """Length of an interval such as ``10 days``."""
    start = F.lit("2000-01-01").cast("timestamp")
    return spark.range(1).select(F.unix_millis(start + F.expr(f"interval {horizon}")) - F.unix_millis(start)).first()[0]


def load_with_quarantine(
    spark: SparkSession, landing: str, page: T.StructType, items: str, path: str, quarantine: str, checkpoint: str
) -> StreamingQuery:
    """Append the records of good pages to ``path``, and a row for every broken page to ``quarantine``, in the same batch.

    A broken page does not parse, or is no page at all: its file's path, what is wrong, its text and the time it landed are kept. Both outputs
    have a folder per batch, which a repeated batch replaces, so each record and each broken page is there exactly once.
    """
    texts = spark.readStream.format("text").option("wholetext", True).load(landing).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("timestamp")
    )
    corrupt = "_corrupt"
    parsed = texts.withColumn(
        "page", F.from_json("value", T.StructType([*page.fields, T.StructField(corrupt, T.StringType())]), {"columnNameOfCorruptRecord": corrupt})
    )
    broken = F.col(f"page.{corrupt}").isNotNull() | F.col(f"page.{items}").isNull()
    judged = parsed.withColumn("error", F.when(F.col(f"page.{corrupt}").isNotNull(), "does not parse").when(broken, f"has no {items}"))

    def write(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("batch", F.lit(number))
        bad = numbered.filter("error IS NOT NULL").select("file", "error", F.col("value").alias("text"), "timestamp", "batch")
        write_pull(bad, quarantine, "batch")
        records = numbered.filter("error IS NULL").select("timestamp", "batch", F.explode(f"page.{items}").alias("record"))
        write_pull(nan_to_null(flatten(records.select("record.*", "timestamp", "batch"))), path, "batch")

    return for_each_batch(judged, write, checkpoint)


def append_files(records: DataFrame, path: str, checkpoint: str, time_column: str = "timestamp") -> StreamingQuery:
    """Append to Parquet by ingest date; the file sink writes each row exactly once."""
    return (
        records.withColumn("ingest_date", F.to_date(time_column))
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def for_each_batch(records: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every batch, with its number, to ``write``; a repeated number is a retry."""
    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def monthly_counts(records: DataFrame, time_column: str, keys: Sequence[str]) -> DataFrame:
    """Running counts per month and key, for output mode ``update`` or ``complete``."""
    return records.groupBy(month_of(F.col(time_column).cast("date")).alias("month"), *keys).agg(
        F.count(F.lit(1)).alias("n")
    )
