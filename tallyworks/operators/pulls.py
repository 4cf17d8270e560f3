"""Summaries of appended pulls: stored with each pull, merged without reading its facts again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A set of members with so many or fewer in a bucket is stored as a list, a larger one as a bitmap of 4 KB.
LISTED = 512

#: Size of the quantile sketches; the rank of an answer is off by less than ``RANK_ERROR`` of all rows, with 99 % certainty.
SKETCH_SIZE, RANK_ERROR = 2048, 0.002


def _has(bits: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substr(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.lit(0) != byte.bitwiseAND(F.pow(F.lit(2.0), position % 8).cast("int"))


def summarise(facts: DataFrame, keys: Sequence[str], member: str, measure: str) -> DataFrame:
    """What a pull adds to sums and distinct members: ``(keys, bucket, total, members, bits)``.

    ``member`` is a whole number. Numbers are dealt to buckets of 32,768; the members of a key in a bucket are a list or a bitmap,
    both exact. Rows without a member have bucket NULL and count in the sum only.
    """
    number = F.col(member).cast("long")
    placed = facts.select(
        *keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).cast("int").alias("position"),
        F.col(measure).alias("_measure"),
    )
    # sum and set are reduced in every task and shuffled once
    grouped = placed.groupBy(*keys, "bucket").agg(
        F.sum("_measure").alias("total"), F.sort_array(F.collect_set("position")).alias("members")
    )
    return _stored(grouped.withColumn("bits", F.lit(None).cast("binary")), keys)


def _stored(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets as they are kept: a long list becomes a bitmap, unless there is one already, beside which it stays a list."""
    long = F.col("bits").isNull() & (F.size("members") > LISTED)
    spread = grouped.filter(long).select(*keys, "bucket", "total", F.explode("members").alias("position"))
    mapped = spread.groupBy(*keys, "bucket", "total").agg(
        F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits")
    )
    kept = ["bucket", "total", "members", "bits"]
    # NULL, but not a constant: the optimiser loses a constant column of one side of a union
    mapped = mapped.withColumn("members", F.when(F.col("bits").isNull(), F.array().cast("array<int>")))
    return grouped.filter(~long).select(*keys, *kept).unionByName(mapped.select(*keys, *kept))


def _united(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(keys, bucket, total, members, bits)`` for each bucket: ``members`` are those that no bitmap has.

    Bitmaps are put together by themselves: in one aggregate with the lists every bucket, also one of a single member, would hold an
    empty bitmap of 4 KB.
    """
    is_map, kind = F.col("bits").isNotNull(), summaries.schema["total"].dataType
    # NULL, but not constants: the optimiser loses a constant column of one side of a union
    maps = summaries.filter(is_map).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).select(
        *keys, "bucket", F.when(~is_map, F.lit(0).cast(kind)).alias("total"),
        F.when(~is_map, F.array().cast("array<int>")).alias("members"), "bits",
    )
    lists = summaries.withColumn("bits", F.when(F.size("members") > 32_768, F.col("bits")))
    joined = lists.select(maps.columns).unionByName(maps).groupBy(*keys, "bucket").agg(
        F.sum("total").alias("total"), F.flatten(F.collect_list("members")).alias("_listed"), F.max("bits").alias("bits")
    )
    members = F.sort_array(F.array_distinct("_listed"))
    new = F.when(F.col("bits").isNull(), members).otherwise(F.filter(members, lambda p: ~_has(F.col("bits"), p)))
    return joined.select(*keys, "bucket", "total", new.alias("members"), "bits")


def merged(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries of several pulls as one, in the same form: pulls can be merged in any order, again and again.

    A bucket has 32,768 members at most, so the lists and bitmaps that meet in a group are bounded.
    """
    return _stored(_united(summaries, keys), keys)


def totals(summaries: DataFrame, keys: Sequence[str], total: str, members: str) -> DataFrame:
    """Sum and exact number of distinct members for each key, over all pulls summarised."""
    whole = _united(summaries, keys)
    size = F.coalesce(F.size("members"), F.lit(0)) + F.coalesce(F.bitmap_count("bits"), F.lit(0))
    return whole.groupBy(*keys).agg(F.sum("total").alias(total), F.sum(size).cast("long").alias(members))


def sketched(facts: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A quantile sketch of each column for each key: ``(keys, column, sketch)``, some ten kilobytes each, to be stored with the pull."""
    values = [F.col(c).cast("double").alias(c) for c in columns]
    made = facts.select(*keys, *values).groupBy(*keys).agg(
        *[F.kll_sketch_agg_double(F.nanvl(c, F.lit(None).cast("double")), F.lit(SKETCH_SIZE)).alias(c) for c in columns]
    )
    return made.unpivot(list(keys), list(columns), "column", "sketch")


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of several pulls as one for each key and column, in the same form."""
    return sketches.groupBy(*keys, "column").agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))


def quantiles(sketches: DataFrame, keys: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """``(keys, column, n, a column per named share)`` over all pulls: each answer is a value of the data
    whose rank is off by ``RANK_ERROR`` of the rows at most. Without values n is 0 and the shares are NULL."""
    whole = merged_sketches(sketches, keys)
    n = F.kll_sketch_get_n_double("sketch")
    at = [
        F.when(n > 0, F.kll_sketch_get_quantile_double(F.when(n > 0, F.col("sketch")), F.lit(float(s)))).alias(name)
        for name, s in shares.items()
    ]
    return whole.select(*keys, "column", n.alias("n"), *at)
