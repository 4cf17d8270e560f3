"""Chi-squared test of independence on a contingency table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions.nulls import safe_ratio
from tallyworks.operators.aggregates import drop_missing_keys, rows


#: Steps of a series or continued fraction; more for many degrees of freedom.
STEPS = 120


def expected_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Observed and expected count of every cell: ``(row, column, observed, expected)``.

    All levels found in the data count; a pair that never occurs is observed 0
    times. Rows without either key belong to no cell. The table is aggregated to
    cells once, margins and absent cells are made from these.
    """
    cells = drop_missing_keys(df, [row, column]).groupBy(row, column).agg(rows("_observed"))
    by_row = cells.groupBy(F.col(row).alias("_row")).agg(F.sum("_observed").alias("_row_total"))
    by_column = cells.groupBy(F.col(column).alias("_column")).agg(F.sum("_observed").alias("_column_total"))
    grand = cells.agg(F.sum("_observed")).scalar()
    # one row per pair of levels, which is what the result has
    grid = by_row.crossJoin(by_column)
    same = (cells[row] == grid["_row"]) & (cells[column] == grid["_column"])
    expected = safe_ratio(F.col("_row_total").cast("double") * F.col("_column_total"), grand)
    return grid.join(cells, same, "left").select(
        F.col("_row").alias(row),
        F.col("_column").alias(column),
        F.coalesce("_observed", F.lit(0)).alias("observed"),
        expected.alias("expected"),
    )


def chi_square(df: DataFrame, row: str, column: str, correction: bool = True) -> DataFrame:
    """One row: ``statistic`` and ``dof``; for a table without rows NULL and 0.

    Only cells that occur are made: a table of many levels costs as much as its rows.

    With one degree of freedom each difference is reduced by up to a half
    (Yates), unless ``correction`` is off.
    """
    cells = drop_missing_keys(df, [row, column]).groupBy(row, column).agg(rows("_observed"))
    by_row = cells.groupBy(F.col(row).alias("_row")).agg(F.sum("_observed").cast("double").alias("_row_total"))
    by_column = cells.groupBy(F.col(column).alias("_column")).agg(F.sum("_observed").cast("double").alias("_column_total"))
    grand = cells.agg(F.sum("_observed").cast("double")).scalar()
    met = cells.join(by_row, cells[row] == by_row["_row"]).join(by_column, cells[column] == by_column["_column"])
    expected = safe_ratio(F.col("_row_total") * F.col("_column_total"), F.col("_grand"))
    present = met.withColumn("_grand", grand).withColumn("_expected", expected)
    gap = F.abs(F.col("_observed") - F.col("_expected"))
    # cells that never occur add what is expected of them: all that is not expected of the others
    summed = present.agg(
        (F.sum(gap * gap / F.col("_expected")) + F.max("_grand") - F.sum("_expected")).alias("plain"),
        F.max(gap).alias("gap"), F.max("_grand").alias("grand"),
    )
    sides = [
        margin.agg(F.count(F.lit(1)).alias("levels"), F.sum(1 / F.col(total)).alias("inverse"))
        for margin, total in ((by_row, "_row_total"), (by_column, "_column_total"))
    ]
    shape = summed.select(
        "*", *[side.select(F.struct("levels", "inverse")).scalar().alias(n) for side, n in zip(sides, ("r", "c"))]
    )
    dof = (F.greatest(F.col("r.levels") - 1, F.lit(0)) * F.greatest(F.col("c.levels") - 1, F.lit(0))).cast("long")
    # all four differences of a two by two table are equal
    reduced = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    corrected = reduced * reduced * F.col("grand") * F.col("r.inverse") * F.col("c.inverse")
    use_corrected = (dof == 1) if correction else F.lit(False)
    return shape.select(F.when(use_corrected, corrected).otherwise(F.col("plain")).alias("statistic"), dof.alias("dof"))


def upper_tail(statistic: Column, dof: Column) -> Column:
    """Probability that a chi-squared variable with ``dof`` exceeds ``statistic``: the incomplete gamma function Q(dof / 2, statistic / 2).

    Below dof / 2 + 1 it is one less the power series of P, from there on its continued fraction, both by as many steps as
    the last digits need for up to some thousand degrees of freedom. NULL without a statistic or a degree of freedom.
    """
    a, x = dof / 2, statistic / 2
    # ln Gamma(a): a product of whole or half numbers
    start = F.when(dof % 2 == 0, F.lit(0.0)).otherwise(F.lit(math.log(math.pi) / 2))
    below = F.sequence(F.lit(1), F.greatest(F.floor((dof - 1) / 2), F.lit(1)).cast("int"))
    factor = lambda i: F.when(dof % 2 == 0, i.cast("double")).otherwise(i - 0.5)
    log_gamma = F.aggregate(
        F.filter(below, lambda i: i <= F.floor((dof - 1) / 2)), start, lambda total, i: total + F.log(factor(i))
    )
    scale = F.exp(a * F.log(x) - x - log_gamma)
    steps = F.sequence(F.lit(1), (STEPS + 4 * F.ceil(F.sqrt(dof))).cast("int"))
    series = F.aggregate(
        steps, F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
        lambda s, n: F.struct((s["term"] * x / (a + n)).alias("term"), (s["sum"] + s["term"] * x / (a + n)).alias("sum")),
    )["sum"]
    # b0 + a1 / (b1 + a2 / (b2 + ...)) from its far end
    fraction = F.aggregate(
        F.reverse(steps), x + 1e9, lambda tail, n: x - a + 2 * n - 1 + n * (a - n) / tail
    )
    tail = F.when(x < a + 1, 1 - scale * series).otherwise(scale / fraction)
    known = (dof > 0) & statistic.isNotNull()
    return F.when(known, F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0))))


def with_p_value(test: DataFrame) -> DataFrame:
    """Add ``p_value`` to every row that has a ``statistic`` and ``dof``. No degree of freedom, no p-value."""
    return test.withColumn("p_value", upper_tail(F.col("statistic"), F.col("dof").cast("double")))
