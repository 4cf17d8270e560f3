"""Grouped counts, sums, means, rates and tables of them.

All of them are plain aggregates: Spark combines rows in every task before the
shuffle, so a key holding a large share of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyworks.functions.nulls import all_present, mean, safe_ratio


def rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a group key belong to no group."""
    return df.filter(all_present(keys))


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def sum_and_distinct_by(
    df: DataFrame, keys: Sequence[str], measure: str, total: str, member: str, members: str
) -> DataFrame:
    """Sum of a measure and exact number of distinct members per group."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(total), F.count_distinct(member).alias(members))


def mean_by(df: DataFrame, keys: Sequence[str], measure: str, name: str, integer: bool = False) -> DataFrame:
    return df.groupBy(*keys).agg(mean(measure, integer).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency of each value, most frequent first; missing values are left out."""
    return (
        drop_missing_keys(df, [column]).groupBy(column).agg(rows(name)).orderBy(F.desc(name), F.asc(column))
    )


def level_table(spark, column: str, levels: Sequence[str]) -> DataFrame:
    """The ordered levels of a category as (``position``, column) rows."""
    literal = F.array(*[F.lit(x) for x in levels])
    return spark.range(1).select(F.posexplode(literal).alias("position", column))


def counts_by_level(df: DataFrame, column: str, levels: Sequence[str], name: str = "n") -> DataFrame:
    """Frequency in category order; levels that never occur count 0."""
    found = df.filter(F.col(column).isin(list(levels))).groupBy(column).agg(rows(name))
    return (
        level_table(df.sparkSession, column, levels)
        .join(F.broadcast(found), column, "left")
        .select("position", column, F.coalesce(name, F.lit(0)).alias(name))
        .orderBy("position")
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Number and truth columns, the ones a mean or correlation covers."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def as_number(column: str) -> Column:
    return F.col(column).cast("double")


def means_by(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column per group, in one pass."""
    columns = list(columns or numeric_columns(df, [key]))
    return drop_missing_keys(df, [key]).groupBy(key).agg(*[F.avg(as_number(c)).alias(c) for c in columns])


def means_by_level(df: DataFrame, key: str, levels: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """As :func:`means_by`, in category order; unseen levels have missing means."""
    columns = list(columns or numeric_columns(df, [key]))
    found = means_by(df.filter(F.col(key).isin(list(levels))), key, columns)
    return (
        level_table(df.sparkSession, key, levels)
        .join(F.broadcast(found), key, "left")
        .select("position", key, *columns)
        .orderBy("position")
    )


def rate_by(df: DataFrame, keys: Sequence[str], outcome: str, positive: str, name: str = "rate") -> DataFrame:
    """Share of the positive outcome among known outcomes, per group."""
    hits = F.count_if(F.col(outcome) == positive)
    return drop_missing_keys(df, keys).groupBy(*keys).agg(safe_ratio(hits, F.count(outcome)).alias(name))


def sizes_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return drop_missing_keys(df, keys).groupBy(*keys).agg(rows(name))


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Rows per group under each condition, in one pass."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def cross_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Contingency table, one column per listed value; absent pairs count 0.

    With the values known, one conditional count each needs a single shuffle;
    ``pivot`` would aggregate by pair first and then again by row. A value that is
    not listed is an error when the table is computed: no row is left out.
    """
    kept = drop_missing_keys(df, [row, column])
    counts = {v: F.col(column) == v for v in values} | {"_other": ~F.col(column).isin(list(values))}
    message = F.concat(F.lit(f"{column} has values other than {list(values)} in "), F.col(row).cast("string"))
    checked = {v: F.when(F.col("_other") > 0, F.raise_error(message)).otherwise(F.col(v)) for v in values}
    return conditional_counts(kept, [row], counts).withColumns(checked).drop("_other")


def null_profile(df: DataFrame, digits: int = 3) -> DataFrame:
    """Share of missing values per column, largest first, in one pass."""
    shares = df.agg(
        *[F.bround(F.avg(F.col(f"`{c}`").isNull().cast("double")), digits).alias(c) for c in df.columns]
    )
    return melt(shares, [], df.columns, "column", "missing").orderBy(F.desc("missing"), "column")


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long: one row per listed column."""
    return df.unpivot(list(ids), list(columns), name, value)


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace missing numbers by the column's mean."""
    average = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), average))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = F.col(label).eqNullSafe(F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))
