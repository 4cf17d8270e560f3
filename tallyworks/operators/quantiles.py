"""Exact quantiles and descriptive statistics without gathering a column.

``percentile`` keeps every distinct value of a group in one buffer. Here a
fixed-size sketch first brackets each quantile; rows between the brackets are
only counted, and just the few values inside them are ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.operators import cells
from tallyworks.operators.aggregates import as_number, level_table, melt

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
VALUE = "value"
#: Cells a bracket is cut into before the values of a cell are ranked.
CELLS = 4_096


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    shares: Mapping[str, float],
    extra: Sequence[Column] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles of each column per group.

    Returns keys, ``column``, a column per named share, and ``extra`` aggregates
    of ``value``. Two passes: the sketch is off by at most ``n / accuracy``
    ranks, and a bracket reaches twice as far on either side, so it holds its
    quantile for sure; that is checked. Its values are counted by equally wide cells, and only
    within the cells that hold a wanted rank are they sorted. Groups of up to
    ``10 * accuracy`` rows are one cell (of distinct values with counts).
    """
    shares = dict(sorted(shares.items(), key=lambda item: item[1]))
    numbers = df.select(*keys, *[as_number(c).alias(c) for c in columns])
    long = melt(numbers, keys, columns, "column", VALUE)
    ids = [*keys, "column"]

    margin = 2.0 / accuracy
    ends = [e for s in shares.values() for e in (max(s - margin, 0.0), min(s + margin, 1.0))]
    sketched = (
        long.groupBy(*ids)
        .agg(F.count(VALUE).alias("_n"), F.percentile_approx(VALUE, ends, accuracy).alias("_ends"), *extra)
    )
    wide_enough = F.col("_n") > 10 * accuracy
    def end(side: str, i: int, share: float) -> Column:
        """One end of a bracket; open for small groups and where it touches 0 or 1."""
        open_end = F.lit(float("-inf" if side == "low" else "inf"))
        if share in (0.0, 1.0):
            return open_end
        return F.when(wide_enough, F.get("_ends", F.lit(2 * i + (side == "high")))).otherwise(open_end)

    sides = [f"_{side}{i}" for i in range(len(shares)) for side in ("low", "high")]
    bracket_ends = [
        end(side, i, share).alias(f"_{side}{i}")
        for i, share in enumerate(shares.values())
        for side in ("low", "high")
    ]
    brackets = sketched.select("*", *bracket_ends).drop("_ends")

    present = long.filter(F.col(VALUE).isNotNull())
    if keys:
        # only large groups have brackets to look up, so these are few and no row is sent or sorted for them
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ids]
        large = brackets.filter(wide_enough).select(*ids, *sides)
        open_ends = [F.lit(float("-inf" if side.startswith("_low") else "inf")) for side in sides]
        matched = present.alias("l").join(F.broadcast(large).alias("b"), same, "left").select(
            *[F.col(f"l.{c}").alias(c) for c in ids], F.col(f"l.{VALUE}").alias(VALUE),
            *[F.coalesce(side, end).alias(side) for side, end in zip(sides, open_ends)],
        )
    else:
        # one bracket per listed column: a single value that is handed to every row, without a join
        entry = F.struct("column", F.struct(*sides))
        known = brackets.agg(F.map_from_entries(F.collect_list(entry))).scalar()
        matched = present.withColumn("_b", F.element_at(known, F.col("column"))).select("column", VALUE, "_b.*")
    # the first bracket not below the value holds it, or bounds the gap it lies in
    inside, place, cell = F.lit(None).cast("boolean"), F.lit(None).cast("double"), F.lit(None).cast("long")
    for i in reversed(range(len(shares))):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        reaches, held = F.col(VALUE) <= high, F.col(VALUE) >= low
        depth = F.coalesce(F.floor(F.try_divide(F.col(VALUE) - low, high - low) * (CELLS - 1)), F.lit(0))
        closed = (low > float("-inf")) & (high < float("inf"))
        number = F.when(held, F.when(closed, depth).otherwise(0) + 1).otherwise(0) + i * (CELLS + 1)
        inside = F.when(reaches, held).otherwise(inside)
        place = F.when(reaches, F.greatest(F.col(VALUE), low)).otherwise(place)
        cell = F.when(reaches, number).otherwise(cell)
    # what lies above all brackets is one more cell, without places
    cell = F.coalesce(cell, F.lit(len(shares) * (CELLS + 1)).cast("long"))
    counted = (
        matched.select(*ids, inside.alias("_inside"), place.alias("_place"), cell.alias("_cell"))
        .groupBy(*ids, "_inside", "_place", "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )

    # cells in the order of their values; only those with a wanted rank are looked into
    so_far = Window.partitionBy(*ids).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    ranks = [f((F.col("_n") - 1) * F.lit(s)) for s in shares.values() for f in (F.floor, F.ceil)]
    wanted = reduce(or_, [(F.col("_before") <= r) & (F.col("_end") > r) for r in ranks])
    cells = (
        counted.groupBy(*ids, "_cell")
        .agg(F.sum("_rows").alias("_rows"))
        .withColumn("_n", F.sum("_rows").over(Window.partitionBy(*ids)))
        .withColumn("_end", F.sum("_rows").over(so_far))
        .withColumn("_before", F.col("_end") - F.col("_rows"))
        .filter(wanted)
        .select(*ids, "_cell", "_n", "_before")
    )
    looked = counted.alias("c").join(
        cells.alias("w"),
        [F.col(f"c.{c}").eqNullSafe(F.col(f"w.{c}")) for c in [*ids, "_cell"]],
    )
    order = (
        Window.partitionBy(*ids, "_cell")
        .orderBy("_place", "_inside")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = looked.select("c.*", "_n", "_before").withColumn("_up_to", F.col("_before") + F.sum("_rows").over(order))

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("_inside") & (F.col("_up_to") > rank), F.col("_place")))

    def quantile(share: float) -> Column:
        rank = (F.col("_n") - 1) * F.lit(share)
        low, high = value_at(F.floor(rank)), value_at(F.ceil(rank))
        return low + (high - low) * F.max(rank - F.floor(rank))

    # a wanted rank that no bracket held would be missing: an error, never another value
    held = [F.count_if(F.col("_inside") & (F.col("_up_to") > r) & (F.col("_up_to") - F.col("_rows") <= r)) for r in ranks]
    complete = reduce(and_, [h > 0 for h in held])
    values = [quantile(s).alias(name) for name, s in shares.items()]
    found = ranked.groupBy(*ids).agg(complete.alias("_complete"), *values)
    checked = [
        F.when(F.col("_complete"), F.col(f"`{name}`"))
        .otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
        .alias(name)
        for name in shares
    ]
    found = found.select(*ids, *checked)
    # groups without any value have a row too
    rest = brackets.drop("_n", *sides)
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ids]
    return rest.alias("r").join(found.alias("f"), same, "left").select(
        *[F.col(f"r.{c}") for c in ids],
        *[F.col(f"f.`{c}`") for c in shares],
        *[F.col(f"r.{c}") for c in rest.columns if c not in ids],
    )


def quartiles_by(df: DataFrame, keys: Sequence[str], column: str, accuracy: int = 10_000) -> DataFrame:
    """Quartiles of one column per group: ``q1``, ``median``, ``q3``."""
    names = dict(zip(("q1", "median", "q3"), QUARTILES.values()))
    return exact_quantiles(df, keys, [column], names, accuracy=accuracy).drop("column")


def describe(
    df: DataFrame, columns: Sequence[str], approx: bool = False, accuracy: int = 10_000, brackets: bool = False
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per column.

    Cells of all columns are counted at once, step by step (``cells.profile``). ``brackets=True`` takes the quartiles through sketched
    brackets instead, ``approx=True`` from the sketch alone, which saves passes. A
    column without any value has count 0 and nothing else, also in an empty table.
    """
    if not approx and not brackets:
        named = cells.profile(df, columns, QUARTILES)
        return named.select("column", "count", "mean", "std", "min", *[F.col(f"`{q}`") for q in QUARTILES], "max")
    moments = [
        F.count(VALUE).cast("double").alias("count"),
        F.avg(VALUE).alias("mean"),
        F.stddev_samp(VALUE).alias("std"),
        F.min(VALUE).alias("min"),
        F.max(VALUE).alias("max"),
    ]
    if approx:
        long = melt(df.select(*[as_number(c).alias(c) for c in columns]), [], columns, "column", VALUE)
        sketch = F.percentile_approx(VALUE, list(QUARTILES.values()), accuracy).alias("_ends")
        stats = long.groupBy("column").agg(*moments, sketch)
        stats = stats.withColumns({name: F.get("_ends", F.lit(i)) for i, name in enumerate(QUARTILES)})
    else:
        stats = exact_quantiles(df, [], columns, QUARTILES, moments, accuracy)
    listed = level_table(df.sparkSession, "column", columns)
    stats = listed.join(stats, "column", "left").fillna(0.0, ["count"])
    return stats.select("column", "count", "mean", "std", "min", *[F.col(f"`{q}`") for q in QUARTILES], "max")
