"""Pearson correlation over pairwise complete rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.functions.nulls import safe_ratio
from tallyworks.operators.aggregates import as_number

_MOMENTS = "i int, j int, n double, x double, y double, xx double, yy double, xy double"


def _batch_moments(values: np.ndarray) -> np.ndarray:
    """Counts, means and centred sums of products for all column pairs.

    ``values`` has NaN for missing. The result is indexed ``[moment, i, j]`` and
    covers the rows in which both columns are present.
    """
    present = ~np.isnan(values)
    mask = present.astype(float)
    count = np.maximum(mask.sum(axis=0), 1)
    centre = np.where(present, values, 0).sum(axis=0) / count
    shifted = np.where(present, values - centre, 0)
    n = mask.T @ mask
    safe = np.maximum(n, 1)
    total = shifted.T @ mask  # sum of column i where column j is present
    squares = (shifted * shifted).T @ mask - total * total / safe
    products = shifted.T @ shifted - total * total.T / safe
    means = centre[:, None] + total / safe
    return np.stack([n, means, means.T, squares, squares.T, products])


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    gap_x, gap_y = b[1] - a[1], b[2] - a[2]
    both = a[0] * b[0] / safe
    return np.stack(
        [
            n,
            a[1] + gap_x * b[0] / safe,
            a[2] + gap_y * b[0] / safe,
            a[3] + b[3] + gap_x * gap_x * both,
            a[4] + b[4] + gap_y * gap_y * both,
            a[5] + b[5] + gap_x * gap_y * both,
        ]
    )


def _task_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per column pair and task."""
    state = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        moments = _batch_moments(np.column_stack(columns).astype(float))
        state = moments if state is None else _merge(state, moments)
    if state is None:
        return
    i, j = np.triu_indices(state.shape[1])
    i, j = i[state[0][i, j] > 0], j[state[0][i, j] > 0]
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(m[i, j]) for m in state]],
        names=["i", "j", "n", "x", "y", "xx", "yy", "xy"],
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs in one pass; rows ``(x, y, r)``, both directions and the diagonal.

    A constant column, or a pair never seen together, has no correlation. As
    one aggregate the pairs would outgrow code generation, so every task takes
    its Arrow batches through a few matrix products and hands on one row per
    pair; Spark combines the tasks.
    """
    numbers = df.select([as_number(c).alias(f"_{k}") for k, c in enumerate(columns)])
    parts = numbers.mapInArrow(_task_moments, _MOMENTS)
    # windows over one row per task
    pair = Window.partitionBy("i", "j")
    mean_x = F.sum(F.col("n") * F.col("x")).over(pair) / F.sum("n").over(pair)
    mean_y = F.sum(F.col("n") * F.col("y")).over(pair) / F.sum("n").over(pair)
    off = parts.withColumn("dx", F.col("x") - mean_x).withColumn("dy", F.col("y") - mean_y)

    def whole(moment: str, a: str, b: str) -> Column:
        return F.sum(F.col(moment) + F.col("n") * F.col(a) * F.col(b))

    r = safe_ratio(whole("xy", "dx", "dy"), F.sqrt(whole("xx", "dx", "dx")) * F.sqrt(whole("yy", "dy", "dy")))
    pairs = off.groupBy("i", "j").agg(r.alias("r"))
    def cell(a: str, b: str) -> Column:
        return F.struct(F.col(a).alias("i"), F.col(b).alias("j"), F.col("r"))

    both = F.array(cell("i", "j"), cell("j", "i"))
    mirrored = pairs.select(F.inline(F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)))
    names = F.array(*[F.lit(c) for c in columns])
    found = mirrored.select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), "r")
    labels = df.sparkSession.range(1).select(F.explode(names).alias("x")).select("x", F.explode(names).alias("y"))
    return labels.join(F.broadcast(found), ["x", "y"], "left")


def correlation_with(df: DataFrame, columns: Sequence[str], outcome: Column) -> DataFrame:
    """Correlation of every column with an outcome; rows ``(column, r)``, missing without variation."""
    numbers = df.select(outcome.cast("double").alias("_y"), *[as_number(c).alias(c) for c in columns])
    pairs = numbers.unpivot(["_y"], list(columns), "column", "_x")
    x, y = F.when(F.col("_y").isNotNull(), F.col("_x")), F.when(F.col("_x").isNotNull(), F.col("_y"))
    r = safe_ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return pairs.groupBy("column").agg(r.alias("r"))


def correlation_of_levels(df: DataFrame, columns: Sequence[str], outcome: Column) -> DataFrame:
    """Correlation of every level's 0/1 flag with an outcome; rows ``(column, r)``, named ``column_level``.

    Flags are never made: a level needs its rows and the sum of their outcomes, the rest is
    the same for all. A missing category has no flag set.
    """
    known = df.select(outcome.cast("double").alias("_y"), *columns).filter(F.col("_y").isNotNull())
    whole = known.agg(
        F.count("_y").alias("n"), F.avg("_y").alias("mean"), F.stddev_pop("_y").alias("std")
    )
    levels = (
        df.select(outcome.cast("double").alias("_y"), *columns)
        .unpivot(["_y"], list(columns), "_of", "_level")
        .filter(F.col("_level").isNotNull())
        .groupBy("_of", "_level")
        .agg(F.count("_y").alias("_n"), F.sum("_y").alias("_sum"))
    )
    total = whole.agg(F.first(F.struct("n", "mean", "std"))).scalar()
    share = safe_ratio("_n", total["n"])
    covariance = safe_ratio(F.col("_sum") - F.col("_n") * total["mean"], total["n"])
    r = safe_ratio(covariance, F.sqrt(share * (1 - share)) * total["std"])
    return levels.select(F.concat_ws("_", "_of", "_level").alias("column"), r.alias("r"))
