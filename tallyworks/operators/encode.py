"""One-hot columns for reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

#: More levels than this make a table too wide to be a report.
MOST_LEVELS = 1_000


def known_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of each column. Stops with an error past ``MOST_LEVELS``."""
    levels = {}
    for column in columns:
        distinct = df.select(F.col(column).alias("v")).filter("v is not null").distinct()
        found = [r.v for r in distinct.limit(MOST_LEVELS + 1).collect()]
        if len(found) > MOST_LEVELS:
            raise ValueError(f"{column} has more than {MOST_LEVELS} levels")
        levels[column] = sorted(found)
    return levels


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per level, named ``column_level``.

    A value outside the levels, or a missing one, gives zeros throughout.
    """
    flags = [
        F.col(column).eqNullSafe(F.lit(level)).cast("double").alias(f"{column}_{level}")
        for column, known in levels.items()
        for level in known
    ]
    return df.select(*[F.col(c) for c in df.columns if c not in levels], *flags)


def flags(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Long one-hot: a row ``(id, flag)`` for every flag that is set, named ``column_level``.

    Levels are those of the data, however many; a missing value sets no flag.
    """
    long = df.select(id_column, *columns).unpivot([id_column], list(columns), "_column", "_level")
    return long.filter(F.col("_level").isNotNull()).select(
        id_column, F.concat_ws("_", "_column", "_level").alias("flag")
    )
