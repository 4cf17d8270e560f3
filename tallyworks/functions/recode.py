"""Recoding of categories, scores, dates and numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F, types as T

from tallyworks.functions.nulls import ColumnOrName, as_column


def normalise(column: ColumnOrName) -> Column:
    """Lower case without white space (blanks, tabs, line ends) at both ends."""
    return F.lower(F.regexp_replace(as_column(column), r"(?U)^\s+|\s+$", ""))


def recode(column: ColumnOrName, mapping: Mapping[str, object], default: object = None) -> Column:
    """Look the value up in a small literal map; unknown and missing give the default."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, as_column(column))
    return found if default is None else F.coalesce(found, F.lit(default))


def two_way(column: ColumnOrName, value: object, then: object, otherwise: object) -> Column:
    """``then`` where the column is the value, ``otherwise`` elsewhere, missing included."""
    return F.when(as_column(column).eqNullSafe(F.lit(value)), F.lit(then)).otherwise(F.lit(otherwise))


def score_label(column: ColumnOrName, cap: int = 5) -> Column:
    """``'0'`` .. ``'cap-1'``, then ``'cap+'``, which also takes missing scores."""
    column = as_column(column)
    return F.when(column < cap, column.cast("int").cast("string")).otherwise(F.lit(f"{cap}+"))


def decade(column: ColumnOrName) -> Column:
    return F.floor(as_column(column) / 10) * 10


def level_or_null(column: ColumnOrName, levels: Sequence[str]) -> Column:
    """Keep only values of a closed list of levels."""
    column = as_column(column)
    return F.when(column.isin(list(levels)), column)


def level_position(column: ColumnOrName, levels: Sequence[str]) -> Column:
    """0-based place of the value in the ordered list of levels, NULL if unknown."""
    position = F.array_position(F.array(*[F.lit(x) for x in levels]), as_column(column))
    return F.when(position > 0, (position - 1).cast("int"))


def percent_text(column: ColumnOrName) -> Column:
    """``0.1234`` as ``'12.3%'``."""
    column = as_column(column)
    return F.when(column.isNotNull(), F.format_string("%.1f%%", column * 100))


def month_of(column: ColumnOrName) -> Column:
    """First day of the month."""
    return F.trunc(as_column(column), "month")


def parse_timestamp(column: ColumnOrName, pattern: str | None = None, strict: bool = True) -> Column:
    """Text to timestamp; ``strict=False`` turns what cannot be read into NULL."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(as_column(column), F.lit(pattern)) if pattern and not strict else (
        parse(as_column(column), pattern) if pattern else parse(as_column(column))
    )


def number_or_null(column: ColumnOrName, kind: str = "double") -> Column:
    """Text to number; what cannot be read, and NaN, becomes NULL."""
    number = F.trim(as_column(column).cast("string")).try_cast(kind)
    return F.when(~F.isnan(number), number) if kind in ("double", "float") else number


def cast_to(schema: T.StructType) -> list[Column]:
    """One ``try_cast`` per field of the target schema, ready for ``select``."""
    return [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]
