"""Histograms, two-dimensional bins and kernel densities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import exp, factorial, log, pi, sqrt
from operator import mul

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions.nulls import safe_ratio
from tallyworks.operators.aggregates import drop_missing_keys, rows

#: Cells of a kernel density in a bandwidth.
CELLS = 4


def bin_start(column: str, width: float) -> Column:
    return F.floor(F.col(column) / width) * width


def histogram(df: DataFrame, column: str, width: float = 1) -> DataFrame:
    """Rows per bin of fixed width; empty bins are absent."""
    return (
        drop_missing_keys(df, [column])
        .groupBy(bin_start(column, width).cast("double").alias("bin"))
        .agg(rows())
        .orderBy("bin")
    )


def density_2d(df: DataFrame, keys: Sequence[str], x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Rows per cell of a grid over two measures, per group: a scatter plot's data."""
    return (
        drop_missing_keys(df, [*keys, x, y])
        .groupBy(
            *keys,
            bin_start(x, x_width).cast("double").alias("x_bin"),
            bin_start(y, y_width).cast("double").alias("y_bin"),
        )
        .agg(rows())
    )


def density_panels(
    df: DataFrame, keys: Sequence[str], panels: Mapping[str, tuple[str, float, str, float]]
) -> DataFrame:
    """Several grids of :func:`density_2d` in one pass; a panel is ``(x, x width, y, y width)``."""
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("panel"),
                bin_start(x, x_width).cast("double").alias("x_bin"),
                bin_start(y, y_width).cast("double").alias("y_bin"),
            )
            for name, (x, x_width, y, y_width) in panels.items()
        ]
    )
    placed = drop_missing_keys(df, keys).select(*keys, F.inline(cells))
    return drop_missing_keys(placed, ["x_bin", "y_bin"]).groupBy(*keys, "panel", "x_bin", "y_bin").agg(rows())


def kernel_density(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    points: int = 200,
    extend: float = 3.0,
    continuous: bool = False,
    error: float = 1e-15,
) -> DataFrame:
    """Gaussian kernel density per group on an even grid of ``points``.

    Bandwidth is ``std * n ** (-1/5)``; the grid reaches ``extend`` bandwidths
    past the data. Every row adds one bump; ``error`` bounds how far a bump may be off anywhere, as a share of
    its height.

    Rows never meet grid points. With t and s the places of a grid point and of a row in bandwidths from the
    middle of the row's cell, a bump is ``exp(-t*t/2) * exp(-s*s/2) * exp(t*s)``, and the last factor is a power series. A
    row adds its powers ``s**k`` to its cell, in the task that holds it; the cells then add a polynomial
    to the points they reach. So the work for a row does not depend on ``points``, and what is shuffled are cells.

    A measure with few distinct values is collapsed to weighted values, from which the statistics are made too. With ``continuous``
    the caller says that most values differ, and that the groups are few (a chart
    is drawn of each): the source is read twice, and the statistics go to every task.
    """
    value = F.col(column).cast("double")
    data = drop_missing_keys(df, [*keys, column]).select(*keys, value.alias("value"))
    if continuous:
        weighted = data.withColumn("weight", F.lit(1.0))
        stats = data.groupBy(*keys).agg(
            F.count("value").alias("n"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
    else:
        weighted = data.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("weight"))
        means = weighted.groupBy(*keys).agg(
            F.sum("weight").alias("n"), (F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("mean"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
        apart = F.col("value") - F.col("mean")
        spread = weighted.join(means.select(*keys, "mean"), list(keys)).groupBy(*keys).agg(
            F.sum(F.col("weight") * apart * apart).alias("squares")
        )
        std = F.sqrt(safe_ratio(F.col("squares"), F.col("n") - 1)).alias("std")
        stats = means.join(spread, list(keys)).select(*keys, "n", std, "low", "high")
    grids = _grids(stats, keys, points, extend)
    cells = _cells(weighted, F.broadcast(grids) if continuous else grids, keys, _terms(error))
    point = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    bare = grids.select(*keys, "n", "width", "first", "step", point, F.lit(0.0).alias("bump"))
    bumps = (
        bare.unionByName(_reached(cells, keys, points, _terms(error), error))
        .groupBy(*keys, "n", "width", "first", "step", "point")
        .agg(F.greatest(F.sum("bump"), F.lit(0.0)).alias("bump"))
    )
    density = F.col("bump") / (F.col("n") * F.col("width") * F.lit(sqrt(2 * pi)))
    x = F.col("first") + F.col("point") * F.col("step")
    return bumps.select(*keys, "point", x.alias("x"), density.alias("density"))


def _grids(stats: DataFrame, keys: Sequence[str], points: int, extend: float) -> DataFrame:
    """The grid of every group that varies, and holds no infinite value."""
    return (
        stats.filter((F.col("std") > 0) & (F.col("std") < float("inf")))
        .withColumn("width", F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .withColumn("first", F.col("low") - extend * F.col("width"))
        .withColumn("step", (F.col("high") - F.col("low") + 2 * extend * F.col("width")) / (points - 1))
        .select(*keys, "n", "width", "first", "step")
    )


def _terms(error: float) -> int:
    """Powers after which what is left of the series is at most ``error`` of a bump, at any grid point.

    The rest of ``exp(t*s)`` after K terms is at most ``|t*s|**K / K! * exp(|t*s|)``; with ``|s|`` at most half a
    cell and the factor ``exp(-t*t/2)`` it is greatest where ``t*t - s*t = K``.
    """
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    half, terms = 0.5 / CELLS, 1
    while True:
        t = (half + sqrt(half * half + 4 * terms)) / 2
        if exp(terms * log(half * t) + half * t - t * t / 2) / factorial(terms) <= error:
            return terms
        terms += 1


def _cells(weighted: DataFrame, grids: DataFrame, keys: Sequence[str], terms: int) -> DataFrame:
    """Per group and cell, the sums of the powers of its rows: the factors of a polynomial."""
    side = F.col("width") / CELLS
    placed = (
        weighted.join(grids, list(keys))
        .withColumn("cell", F.floor((F.col("value") - F.col("first")) / side))
        .withColumn("middle", F.col("first") + (F.col("cell") + 0.5) * side)
        .withColumn("s", (F.col("value") - F.col("middle")) / F.col("width"))
        .withColumn("height", F.col("weight") * F.exp(F.lit(-0.5) * F.col("s") * F.col("s")))
    )
    powers = [
        (F.sum(reduce(mul, [F.col("s")] * k, F.col("height"))) / float(factorial(k))).alias(f"b{k}") for k in range(terms)
    ]
    return placed.groupBy(*keys, "n", "width", "first", "step", "middle").agg(*powers)


def _reached(cells: DataFrame, keys: Sequence[str], points: int, terms: int, error: float) -> DataFrame:
    """What every cell adds to the grid points within its reach; beyond it a bump is below ``error``."""
    reach = (0.5 / CELLS + sqrt(-2 * log(error))) * F.col("width")
    low = F.greatest(F.ceil((F.col("middle") - reach - F.col("first")) / F.col("step")), F.lit(0)).cast("int")
    high = F.least(F.floor((F.col("middle") + reach - F.col("first")) / F.col("step")), F.lit(points - 1)).cast("int")
    met = (
        cells.withColumn("low", low)
        .withColumn("high", high)
        .where("low <= high")
        .withColumn("point", F.explode(F.sequence("low", "high")))
        .withColumn("t", (F.col("first") + F.col("point") * F.col("step") - F.col("middle")) / F.col("width"))
    )
    series = reduce(lambda so_far, k: so_far * F.col("t") + F.col(f"b{k}"), reversed(range(terms - 1)), F.col(f"b{terms - 1}"))
    bump = series * F.exp(F.lit(-0.5) * F.col("t") * F.col("t"))
    return met.select(*keys, "n", "width", "first", "step", "point", bump.alias("bump"))
