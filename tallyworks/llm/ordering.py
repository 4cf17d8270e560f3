"""Running sums within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.store import save


def same(left: DataFrame, right: DataFrame, columns: list[str]):
    """Join condition under which nulls are equal."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def running(df: DataFrame, groups: list[str], order: list[str], value: str, before: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of a group that come earlier in ``order``.

    Rows are dealt by range of group and order, so a group with a third of all
    rows spans many tasks. Each task adds up its own stretch; what came before
    the stretch is a sum over one row per group and task. Rows equal in all of
    ``order`` follow one another in any order. An empty table stays empty.
    """
    ranged = save(
        df.repartitionByRange(*groups, *order).withColumn("_stretch", F.spark_partition_id()), "ranged"
    )
    inside = Window.partitionBy(*groups, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    earlier = Window.partitionBy(*groups).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        ranged.groupBy(*groups, "_stretch")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    return (
        rows.join(stretches, same(rows, stretches, [*groups, "_stretch"]), "left")
        .select(*[rows[c] for c in df.columns], (F.col("_inside") + F.coalesce("_offset", F.lit(0))).alias(before))
    )
