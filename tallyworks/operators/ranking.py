"""Top-k reports, latest rows, and per-group selections that never gather a
group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k largest rows; equal values are told apart by ``tie_break``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc() for c in tie_break]).limit(k)


def top_k_with_ties(df: DataFrame, group: Sequence[str], by: str, k: int) -> DataFrame:
    """Rows whose descending rank in their group is at most k, ties included.

    A rank is at most k exactly when the value is not below the k-th largest.
    So only k values per group and task are shuffled to find that cut
    (``row_number`` limits early, ``rank`` would carry every tie along), and the
    rows are then kept by a comparison, wherever they are. How the cuts reach
    the rows is left to the adaptive planner.
    """
    order = Window.partitionBy(*group).orderBy(F.col(by).desc_nulls_last())
    cut = (
        df.select(*group, by)
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= k)
        .groupBy(*[F.col(g).alias(f"_{g}") for g in group])
        .agg(
            # fewer than k values, or a missing one among them: keep the whole group
            F.when(F.count(by) == k, F.min(by)).alias("_cut")
        )
    )
    same_group = [df[g].eqNullSafe(cut[f"_{g}"]) for g in group]
    return (
        df.join(cut, same_group)
        .filter(F.col("_cut").isNull() | (F.col(by) >= F.col("_cut")))
        .select(df.columns)
    )


def latest_per_key(df: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest ``newest`` columns.

    An aggregate, not a ranking window: a key with very many rows is reduced in
    every task before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    row = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row")
    return df.groupBy(*key).agg(row).select(*key, "_row.*").select(df.columns)


def hash_key(id_column: str, seed: int) -> Column:
    """A fixed pseudo-random key of a row id, the same in every run and layout."""
    return F.md5(F.concat_ws("|", F.col(id_column).cast("string"), F.lit(str(seed))))


def hash_cut(
    df: DataFrame, quota: DataFrame, group: Sequence[str], key: str, digits: int = 5
) -> DataFrame:
    """The hash key up to which each group reaches its quota of rows.

    ``df`` holds the group columns and a hex ``key``; ``quota`` the group columns
    and ``need``. Returns one row per group with ``cut``. Rows are counted by
    the leading digits of the key first, so the only windows are over at most
    ``16 ** digits`` counts per group and over the distinct keys of one such
    bucket. No sort of the whole table takes place.
    """
    bucketed = df.select(*group, F.col(key).alias("_key"), F.substring(key, 1, digits).alias("_bucket"))
    counts = bucketed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        counts.withColumn("_up_to", F.sum("_n").over(so_far))
        .join(quota, list(group))
        .filter((F.col("_up_to") >= F.col("need")) & (F.col("_up_to") - F.col("_n") < F.col("need")))
        .select(*group, "_bucket", (F.col("need") - F.col("_up_to") + F.col("_n")).alias("_more"))
    )
    within = Window.partitionBy(*group).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.join(edge, [*group, "_bucket"])
        .groupBy(*group, "_key", "_more")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_up_to", F.sum("_n").over(within))
        .filter(F.col("_up_to") >= F.col("_more"))
        .groupBy(*group)
        .agg(F.min("_key").alias("cut"))
    )


def split(df: DataFrame, id_column: str, test_share: float = 0.3, seed: int = 0) -> DataFrame:
    """Add ``part``: ``'test'`` for exactly ``ceil(test_share * n)`` rows, else ``'train'``.

    Rows are taken in the order of a hash of their id. The id has to be unique;
    rows sharing an id stay on the same side.
    """
    keyed = df.withColumn("_key", hash_key(id_column, seed))
    # all keys have the same length: one group, and still a key to join by
    keys = keyed.select(F.length("_key").alias("_all"), "_key")
    quota = keys.groupBy("_all").agg(F.ceil(F.count(F.lit(1)) * F.lit(test_share)).alias("need"))
    cut = hash_cut(keys, quota, ["_all"], "_key").select("cut").scalar()
    part = F.when(F.col("_key") <= cut, "test").otherwise("train")
    return keyed.withColumn("part", part).drop("_key")


def split_by_threshold(df: DataFrame, id_column: str, test_share: float = 0.3, seed: int = 0) -> DataFrame:
    """As :func:`split`, but row by row: no shuffle, the share holds on average."""
    draw = F.conv(F.substring(hash_key(id_column, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return df.withColumn("part", F.when(draw < test_share, "test").otherwise("train"))


def balance(df: DataFrame, label: str, id_column: str, seed: int = 0) -> DataFrame:
    """Keep as many rows of every class as the rarest class has, chosen by hash."""
    keyed = df.filter(F.col(label).isNotNull()).withColumn("_key", hash_key(id_column, seed))
    keys = keyed.select(label, "_key")
    sizes = keys.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    rarest = sizes.agg(F.min("_size")).scalar()
    cut = hash_cut(keys, sizes.select(label, rarest.alias("need")), [label], "_key")
    kept = keyed.join(cut, label).filter(F.col("_key") <= F.col("cut"))
    return kept.select(df.columns)
