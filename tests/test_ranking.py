"""Splits, balancing and latest rows, also with very frequent keys."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import ranking


def md5_order(ids, seed=0):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}|{seed}".encode()).hexdigest())


@pytest.mark.parametrize("n, share", [(1000, 0.3), (7, 0.3), (1, 0.3), (501, 0.5)])
def test_split_is_exact_disjoint_and_complete(spark, n, share):
    parted = ranking.split(spark.range(n).repartition(4), "id", share, seed=9).collect()
    test = {r.id for r in parted if r.part == "test"}
    assert len(parted) == n and len(test) == math.ceil(n * share)
    assert test == set(md5_order(range(n), 9)[: len(test)])


def test_split_by_threshold(spark):
    parted = ranking.split_by_threshold(spark.range(20_000), "id", 0.3)
    share = parted.agg(F.avg((F.col("part") == "test").cast("double"))).first()[0]
    assert share == pytest.approx(0.3, abs=0.015)


def test_copies_of_an_id_stay_together(spark):
    ids = spark.range(300).select((F.col("id") % 3 * F.col("id")).alias("id"))
    parted = ranking.split(ids, "id", 0.3)
    assert parted.count() == 300
    assert parted.groupBy("id").agg(F.count_distinct("part").alias("n")).filter("n > 1").count() == 0


def test_balance(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("label"))
    kept = ranking.balance(df.union(spark.sql("select 5000L, cast(null as string)")), "label", "id")
    rows = kept.collect()
    assert sorted(r.label for r in rows) == ["a"] * 200 + ["b"] * 200
    assert {r.id for r in rows if r.label == "b"} == set(range(0, 2000, 10))
    majority = [i for i in range(2000) if i % 10]
    assert {r.id for r in rows if r.label == "a"} == set(md5_order(majority)[:200])


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("at"),
        F.when(F.col("id") % 2 == 0, "x").alias("note"),
    )
    newest = ranking.latest_per_key(df, ["key"], ["at"])
    assert newest.columns == df.columns
    assert newest.count() == 6001
    assert tuple(newest.filter("key = 0").first()) == (0, 8997, None)


def test_top_k_with_ties_carries_no_ties_through_the_window(spark):
    """A third of all rows share the largest value; all of them are results."""
    df = spark.range(9000).select((F.col("id") % 1).alias("g"), "id", F.when(F.col("id") % 3 == 0, 10**6).otherwise(F.col("id")).alias("v"))
    top = ranking.top_k_with_ties(df, ["g"], "v", 10)
    assert top.count() == 3000
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "rank(" not in plan
