"""Missing values, ratios and signs.

A missing number is NULL everywhere. Spark's NaN is an ordinary value (it equals
itself and is greater than any number), so sources turn it into NULL once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

ColumnOrName = Column | str


def as_column(column: ColumnOrName) -> Column:
    return F.col(column) if isinstance(column, str) else column


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float and double column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(
        [
            F.when(~F.isnan(df[f"`{name}`"]), df[f"`{name}`"]).alias(name) if name in floats else df[f"`{name}`"]
            for name in df.columns
        ]
    )


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Division that is NULL, not an error, when the denominator is 0 or missing."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def clamp_negative(column: ColumnOrName) -> Column:
    """Negative numbers become 0; missing ones stay missing."""
    column = as_column(column)
    return F.when(column < 0, F.lit(0.0)).otherwise(column)


def count_negatives(columns: Iterable[ColumnOrName]) -> Column:
    """How many of the columns are negative in this row; missing is not negative."""
    flags = [F.coalesce(as_column(c) < 0, F.lit(False)).cast("int") for c in columns]
    return reduce(add, flags)


def differs(column: ColumnOrName, value: object) -> Column:
    """True when the column is not the value, and also when it is missing."""
    return ~as_column(column).eqNullSafe(F.lit(value))


def equals(column: ColumnOrName, value: object) -> Column:
    """True or False, never NULL."""
    return as_column(column).eqNullSafe(F.lit(value))


def all_present(columns: Iterable[ColumnOrName]) -> Column:
    return reduce(lambda a, b: a & b, [as_column(c).isNotNull() for c in columns])


def mean(column: ColumnOrName, integer: bool = False) -> Column:
    """Average; ``integer=True`` drops the fraction the way an integer AVG does."""
    column = as_column(column)
    if integer:
        total, n = F.sum(column.cast("long")), F.count(column)
        return F.when(n > 0, F.try_divide(total - F.try_mod(total, n), n).cast("long"))
    return F.avg(column)
