"""A run ledger: what each pull has begun and finished, so that a repeated run finishes what is open and nothing else."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


class Ledger:
    """Records of a folder, one for each pull, sink and state (``begun``, ``done``).

    A record is a table of one file, which Spark's commit renames into place: it is there as a whole or not at all.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, pull: str, sink: str, state: str) -> str:
        return f"{self.folder}/{pull}/{sink}/{state}"

    def rows(self, pull: str, sink: str, state: str) -> int | None:
        """The number of rows noted with a record; None without one."""
        try:
            noted = self.spark.read.schema("rows long").parquet(self._path(pull, sink, state)).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if noted is None else noted.rows

    def note(self, pull: str, sink: str, state: str, rows: int = 0) -> None:
        record = self.spark.range(1).select(F.lit(rows).cast("long").alias("rows")).coalesce(1)
        record.write.mode("overwrite").parquet(self._path(pull, sink, state))


def run_steps(ledger: Ledger, pull: str, steps: Sequence[tuple[str, Callable[[bool], int]]]) -> dict[str, int]:
    """Take the steps ``(sink, write)`` of a pull in order; returns the rows of each.

    A step noted as done is passed over. ``write`` is told whether an earlier run has begun the same step: what that run left there
    may be all of it, some of it or nothing.
    """
    out = {}
    for sink, write in steps:
        done = ledger.rows(pull, sink, "done")
        if done is None:
            again = ledger.rows(pull, sink, "begun") is not None
            if not again:
                ledger.note(pull, sink, "begun")
            done = write(again)
            ledger.note(pull, sink, "done", done)
        out[sink] = done
    return out


def missing_rows(rows: DataFrame, there: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys are not in ``there`` yet; null keys are equal."""
    known = there.select([F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(known, same, "left_anti")
