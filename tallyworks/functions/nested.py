"""Nested JSON records: flattening, and access with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyworks.functions.nulls import ColumnOrName, as_column


def leaf_paths(schema: T.StructType, parents: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all columns that are not structs; arrays count as leaves."""
    paths: list[tuple[str, ...]] = []
    for field in schema:
        path = (*parents, field.name)
        if isinstance(field.dataType, T.StructType):
            paths += leaf_paths(field.dataType, path)
        else:
            paths.append(path)
    return paths


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct fields become columns named by their joined path; lists stay lists."""
    return df.select(
        [
            F.col(".".join(f"`{step}`" for step in path)).alias(separator.join(path))
            for path in leaf_paths(df.schema)
        ]
    )


def first_item(array: ColumnOrName, field: str, default: float = 0.0) -> Column:
    """A field of the first list item; empty or missing lists give the default."""
    return F.coalesce(F.get(as_column(array), F.lit(0)).getField(field), F.lit(default))
