"""Plans and layout."""

from pyspark.sql import functions as F

from tallyworks import bindings
from tallyworks.operators import quantiles
from tallyworks.operators.aggregates import cross_counts, sizes_by
from tallyworks.session import cut_lineage


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lineage_is_cut_in_the_shared_folder(spark):
    cut = cut_lineage(spark.range(10).filter("id > 3"))
    assert "Filter" not in plan_of(cut) and cut.count() == 6


def test_contingency_margins_equal_totals(tables):
    from tallyworks.plans import study

    cases = study.study(tables.raw_decisions()).filter("FTA is not null").persist()
    table = cross_counts(cases, "Group", "FTA", study.OUTCOMES)
    sums = {r.Group: r.No + r.Yes for r in table.collect()}
    assert sums == {r.Group: r.n for r in sizes_by(cases, ["Group"]).collect()}


def test_results_do_not_depend_on_the_layout(tables):
    from tallyworks.plans import video

    views, videos = tables.views(), tables.videos()
    once = video.top_videos_by_type(views, videos)
    again = video.top_videos_by_type(views.repartition(13), videos.repartition(3))
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0


def test_joined_lines_are_cut_by_their_rows(spark, tables, monkeypatch):
    """Tasks sort a bounded number of rows, whatever the session's number of parts, and the rows stay the same."""
    plain = tables.raw_results()
    monkeypatch.setattr(bindings, "TASK_ROWS", 100)
    cut = tables.raw_results()
    assert cut.rdd.getNumPartitions() == -(-tables.lineitem.count() // 100)
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def test_only_large_groups_look_up_brackets(spark):
    """Groups with and without brackets stay exact side by side, a missing key included."""
    df = spark.range(3000).select(F.when(F.col("id") < 20, "few").alias("g"), F.col("id").cast("double").alias("v"))
    found = quantiles.quartiles_by(df, ["g"], "v", accuracy=40)
    assert {r.g: (r.q1, r.median, r.q3) for r in found.collect()} == {"few": (4.75, 9.5, 14.25), None: (764.75, 1509.5, 2254.25)}
