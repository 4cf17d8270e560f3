"""Exact quantiles and moments of many columns at once, by counting cells of their values in every task.

A double is an unsigned number of 64 bits in the order of its value. Its first 16 bits name one of 65,536 cells. Every task counts
the cells of all columns in arrays; the counts of all tasks tell which cell holds a wanted rank. Only the
values of that cell are counted by the next 16 bits, and after four steps the value itself is known. No
value is shuffled, and what a task hands on does not depend on how many rows it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyworks.session import cut_lineage

BITS = 16
STEPS = 64 // BITS

_COUNTS = (
    "column int, prefix long, cell int, n long, rows long, mean double, spread double, low double, high double"
)
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 4]
_NAMES = ["column", "prefix", "cell", "n", "rows", "mean", "spread", "low", "high"]


def ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order; both zeros are equal."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def value_of(number: int) -> float:
    """The double that ``ordered`` turned into ``number``."""
    bits = number ^ (1 << 63) if number >> 63 else number ^ (2**64 - 1)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _merged(state: tuple | None, values: np.ndarray) -> tuple:
    """Rows, mean, sum of squared deviations, least and greatest, of what was seen and of ``values``."""
    n, mean = len(values), float(values.mean())
    spread, low, high = float(((values - mean) ** 2).sum()), float(values.min()), float(values.max())
    if state is None:
        return n, mean, spread, low, high
    m, other, more, least, most = state
    gap = mean - other
    whole = n + m
    return whole, other + gap * n / whole, more + spread + gap * gap * n * m / whole, min(least, low), max(most, high)


def _step(numbers: DataFrame, prefixes: list[list[int]], step: int) -> DataFrame:
    """Cells counted in every task: of all values at step 0, later of those that begin with one of the column's prefixes."""
    shift = np.uint64(64 - BITS * (step + 1))

    def counting(batches):
        totals: dict[tuple[int, int], np.ndarray] = {}
        moments: list[tuple | None] = [None] * len(prefixes)
        for batch in batches:
            for c, wanted in enumerate(prefixes):
                values = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                values = values[~np.isnan(values)]
                if not len(values):
                    continue
                if step == 0:
                    moments[c] = _merged(moments[c], values)
                below = ordered(values) >> shift
                for p in wanted:
                    inside = below if step == 0 else below[below >> np.uint64(BITS) == np.uint64(p)]
                    if len(inside):
                        cells = (inside & np.uint64((1 << BITS) - 1)).astype(np.int64)
                        found = np.bincount(cells, minlength=1 << BITS)
                        totals[c, p] = totals[c, p] + found if (c, p) in totals else found
        for (c, p), total in totals.items():
            cells = np.flatnonzero(total)
            same = [pa.array(np.full(len(cells), x), kind) for x, kind in zip((c, p), _KINDS)]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(cells, _KINDS[2]), pa.array(total[cells], _KINDS[3])]
                + [pa.nulls(len(cells), kind) for kind in _KINDS[4:]],
                names=_NAMES,
            )
        seen = [(c, *m) for c, m in enumerate(moments) if m is not None]
        if seen:
            column, *rest = zip(*seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, _KINDS[0]), *[pa.nulls(len(seen), kind) for kind in _KINDS[1:4]]]
                + [pa.array(v, kind) for v, kind in zip(rest, _KINDS[4:])],
                names=_NAMES,
            )

    return numbers.mapInArrow(counting, _COUNTS)


def _cells_of(counted: DataFrame, ranks: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], tuple[int, int]]:
    """For each wanted ``(column, prefix, rank within it)`` the cell that holds it, and the rank within that."""
    wanted = counted.sparkSession.createDataFrame(ranks, "column int, prefix long, rank long")
    so_far = Window.partitionBy("column", "prefix").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = (
        counted.groupBy("column", "prefix", "cell").agg(F.sum("n").alias("n"))
        .withColumn("end", F.sum("n").over(so_far))
    )
    held = (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
    rows = cells.join(F.broadcast(wanted), ["column", "prefix"]).filter(held)
    found = rows.select("column", "prefix", "rank", "cell", (F.col("rank") - F.col("end") + F.col("n")).alias("left"))
    return {(r["column"], r["prefix"], r["rank"]): (r["cell"], r["left"]) for r in found.collect()}


def profile(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """``column, count, mean, std, min, max`` and each named quantile, linearly interpolated and exact, for every column.

    Values are doubles; null and NaN are no values. A column without values has count 0 and nothing else. The numbers are
    written once and read five times at most. A task hands on 65,536 counts at most for each
    column and rank wanted; a few rows for each column come to the driver.
    """
    numbers = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]))
    first = cut_lineage(_step(numbers, [[0]] * len(columns), 0))
    parts = first.filter("rows IS NOT NULL")
    whole = Window.partitionBy("column")
    gap = F.col("mean") - F.sum(F.col("mean") * F.col("rows")).over(whole) / F.sum("rows").over(whole)
    moments = parts.withColumn("_gap", gap).groupBy("column").agg(
        F.sum("rows").alias("n"), (F.sum(F.col("mean") * F.col("rows")) / F.sum("rows")).alias("mean"),
        F.sum(F.col("spread") + F.col("rows") * F.col("_gap") * F.col("_gap")).alias("spread"),
        F.min("low").alias("min"), F.max("high").alias("max"),
    )
    known = {r["column"]: r for r in moments.collect()}
    # rank wanted, its prefix so far, rank within the prefix
    at = {}
    for c, r in known.items():
        for share in shares.values():
            place = (r["n"] - 1) * share
            at |= {(c, int(rank)): (0, int(rank)) for rank in (np.floor(place), np.ceil(place))}
    for step in range(STEPS if at else 0):
        prefixes = [sorted({p for (column, _), (p, _) in at.items() if column == c}) for c in range(len(columns))]
        counted = first if step == 0 else _step(numbers, prefixes, step)
        ranks = sorted({(c, p, left) for (c, _), (p, left) in at.items()})
        found = _cells_of(counted.filter("cell IS NOT NULL"), ranks)
        for key, (p, left) in at.items():
            cell, rest = found[key[0], p, left]
            at[key] = ((p << BITS) + cell, rest)
    rows = []
    for c, name in enumerate(columns):
        r = known.get(c)
        if r is None:
            rows.append((name, 0.0, *[None] * (4 + len(shares))))
            continue
        quantiles = []
        for share in shares.values():
            place = (r["n"] - 1) * share
            low, high = (value_of(at[c, int(rank)][0]) for rank in (np.floor(place), np.ceil(place)))
            quantiles.append(low + (high - low) * (place - np.floor(place)) if high != low else low)
        std = float(np.sqrt(r["spread"] / (r["n"] - 1))) if r["n"] > 1 else None
        rows.append((name, float(r["n"]), r["mean"], std, r["min"], r["max"], *map(float, quantiles)))
    names = ["count", "mean", "std", "min", "max", *shares]
    schema = ", ".join(["column string", *[f"`{n}` double" for n in names]])
    return df.sparkSession.createDataFrame(rows, schema)

