"""The caller's columns, kept out of the way of an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The one column that holds all others of a row while an operator works on it.
CALLER = "caller"


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns ``used`` as they are, and all others as one struct, whatever their names."""
    others = [c for c in docs.columns if c not in used]
    held = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("struct<none:int>")
    return docs.select(*used, held.alias(CALLER))


def unpacked(docs: DataFrame, *used: str, without: tuple[str, ...] = ()) -> list[Column]:
    """What to select from packed rows to have the columns of ``docs`` again, in their order."""
    return [
        F.col(c) if c in used else F.col(CALLER).getField(c).alias(c) for c in docs.columns if c not in without
    ]
