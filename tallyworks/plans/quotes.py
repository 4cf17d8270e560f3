"""Quote snapshots: flatten landed records, narrow types, keep the wanted columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks import fixed_values, schemas
from tallyworks.functions.nested import flatten
from tallyworks.functions.recode import cast_to
from tallyworks.operators.ranking import latest_per_key
from tallyworks.session import cut_lineage
from tallyworks.sources.ledger import Ledger, missing_rows, run_steps
from tallyworks.sources.readers import read_json_pages, read_parquet, read_table
from tallyworks.sources.writers import append_table, stamp, write_pull


def extract(spark: SparkSession, landing: str, pulled_at: datetime) -> DataFrame:
    """Records of the landed pages, nested objects as columns, stamped."""
    return stamp(flatten(read_json_pages(spark, landing, schemas.COIN_PAGE, "data")), pulled_at, "timestamp")


def transform(flat: DataFrame) -> DataFrame:
    """The nine wanted columns in their narrow types."""
    return flat.select(*cast_to(schemas.QUOTES))


def table_rows(clean: DataFrame) -> DataFrame:
    """Columns named and ordered as in the quotes table."""
    return clean.select([F.col(c).alias(name) for c, name in fixed_values.QUOTE_COLUMNS.items()])


def latest(clean: DataFrame) -> DataFrame:
    """The newest snapshot of each coin; of equal times the one with the larger values."""
    rest = [c for c in clean.columns if c not in ("id", "timestamp")]
    return latest_per_key(clean, ["id"], ["timestamp", *rest])


def run(
    spark: SparkSession, landing: str, raw_path: str, clean_path: str, url: str, pulled_at: datetime,
    ledger_path: str | None = None,
) -> int:
    """Add one pull to the raw files, the clean files and the table; returns the rows of the pull.

    The landed pages are read once; later steps read the raw files of this pull. The ledger (by default beside the clean files) notes
    what is begun and what is done. A repeated run goes on where the last one ended: files of the pull are replaced, and the table gets
    the rows it does not hold yet.
    """
    pull = pulled_at.strftime("%Y-%m-%dT%H-%M-%S")
    ledger = Ledger(spark, ledger_path or f"{clean_path.rstrip('/')}.ledger")

    def of_pull(path: str) -> DataFrame:
        return read_parquet(spark, path, nan_as_null=False).filter(F.col("pull") == pull).drop("pull")

    def write_raw(again: bool) -> int:
        return write_pull(extract(spark, landing, pulled_at).withColumn("pull", F.lit(pull)), raw_path, "pull")

    def write_clean(again: bool) -> int:
        return write_pull(transform(of_pull(raw_path)).withColumn("pull", F.lit(pull)), clean_path, "pull")

    def write_table(again: bool) -> int:
        rows = table_rows(of_pull(clean_path))
        if not again:
            return append_table(rows, url, "quotes")
        # an earlier run may have appended some partitions, or all
        there = read_table(spark, url, "quotes").filter(F.col("API_TimeStamp") == F.lit(pulled_at).cast("timestamp"))
        missing = cut_lineage(missing_rows(rows, there, ["CoinID", "API_TimeStamp"]))
        if missing.limit(1).count():
            append_table(missing, url, "quotes")
        return rows.count()

    return run_steps(ledger, pull, [("raw", write_raw), ("clean", write_clean), ("table", write_table)])["table"]
