"""Quantiles, densities and the chi-squared test against direct computation."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tallyworks.operators import chi_square, correlation, density, quantiles
from tallyworks.operators.aggregates import cross_counts


def table_rows(counts):
    return [(r, c) for (r, c), n in counts.items() for _ in range(n)]


TWO_BY_TWO = {("a", "No"): 10, ("a", "Yes"): 20, ("b", "No"): 30, ("b", "Yes"): 15}


def test_chi_square_two_by_two(frame):
    df = frame(table_rows(TWO_BY_TWO) + [("a", None), (None, "Yes")], "g string, o string")
    plain = chi_square.chi_square(df, "g", "o", correction=False)
    row = chi_square.with_p_value(plain).first()
    assert row.dof == 1
    assert row.statistic == pytest.approx(8.035714, abs=1e-6)
    assert row.p_value == pytest.approx(0.004586, abs=1e-6)
    expected = np.outer([30, 45], [40, 35]) / 75
    corrected = ((np.abs(np.array([[10, 20], [30, 15]]) - expected) - 0.5) ** 2 / expected).sum()
    assert chi_square.chi_square(df, "g", "o").first().statistic == pytest.approx(corrected)


def test_correction_never_overshoots(frame):
    df = frame(table_rows({("a", "No"): 3, ("a", "Yes"): 3, ("b", "No"): 3, ("b", "Yes"): 3}), "g string, o string")
    assert chi_square.chi_square(df, "g", "o").first().statistic == 0.0


def test_chi_square_with_an_empty_cell_agrees_with_spark(frame):
    counts = {("a", "x"): 5, ("a", "y"): 7, ("b", "y"): 4, ("c", "x"): 6, ("c", "y"): 2}
    df = frame(table_rows(counts), "g string, o string")
    ours = chi_square.with_p_value(chi_square.chi_square(df, "g", "o")).first()
    coded = df.select((F.ascii("g") - 97).cast("double").alias("f"), (F.col("o") == "y").cast("double").alias("label"))
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["f"], outputCol="v").transform(coded), "v", "label").first()
    assert ours.dof == theirs.degreesOfFreedom[0] == 2
    assert ours.statistic == pytest.approx(theirs.statistics[0])
    assert ours.p_value == pytest.approx(theirs.pValues[0])
    cells = chi_square.expected_counts(df, "g", "o")
    sums = cells.agg(F.sum("observed"), F.sum("expected")).first()
    assert cells.count() == 6 and sums[0] == 24 and sums[1] == pytest.approx(24)


@pytest.mark.parametrize("dof, statistic, tail", [(1, 3.841459, 0.05), (2, 5.991465, 0.05), (3, 7.814728, 0.05), (10, 18.307038, 0.05), (5, 0.0, 1.0)])
def test_tail_probabilities(frame, dof, statistic, tail):
    found = chi_square.with_p_value(frame([(statistic, dof)], "statistic double, dof long")).first()
    assert found.p_value == pytest.approx(tail, abs=1e-6)


@pytest.mark.parametrize("accuracy", [20_000, 40])
def test_quantiles_are_exact(spark, accuracy):
    """With the low accuracy the groups are large enough to be bracketed."""
    rng = np.random.default_rng(5)
    groups = {"even": np.arange(3000.0), "skewed": rng.exponential(5, 2500), "few": rng.integers(0, 4, 1700) * 1.0}
    groups["hot"] = np.where(rng.random(4000) < 0.4, 7.0, rng.normal(7, 2, 4000))
    groups["tiny"] = np.array([4.0, 1.0, 3.0])
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("tiny", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = {"a": 0.0, "b": 0.01, "q1": 0.25, "q2": 0.5, "q3": 0.75, "z": 1.0}
    found = quantiles.exact_quantiles(df, ["g"], ["v"], shares, accuracy=accuracy)
    for row in found.collect():
        for name, share in shares.items():
            assert row[name] == pytest.approx(np.quantile(groups[row.g], share), abs=1e-12), (row.g, name)
    assert found.count() == len(groups)


def test_many_groups(spark):
    df = spark.range(600).select((F.col("id") % 30).alias("g"), F.col("id").cast("double").alias("v"))
    found = quantiles.quartiles_by(df, ["g"], "v").filter("g = 3").first()
    assert found.median == pytest.approx(np.median(np.arange(3, 600, 30)))


def test_columns_and_groups_without_values_have_a_row(frame):
    df = frame([("a", 1.0, None), ("a", 3.0, None), ("b", None, None)], "g string, v double, empty double")
    rows = {r.column: r for r in quantiles.describe(df, ["v", "empty"]).collect()}
    assert rows["empty"]["count"] == 0.0 and rows["empty"]["mean"] is None and rows["empty"]["50%"] is None
    assert (rows["v"]["count"], rows["v"]["50%"]) == (2.0, 2.0)
    groups = {r.g: (r.q1, r.median, r.q3) for r in quantiles.quartiles_by(df, ["g"], "v").collect()}
    assert groups == {"a": (1.5, 2.0, 2.5), "b": (None, None, None)}
    assert [r["count"] for r in quantiles.describe(df.limit(0), ["v"]).collect()] == [0.0]
    features = {r.column: r.r for r in correlation.correlation_with(df, ["v", "empty"], F.lit(1.0)).collect()}
    assert features == {"v": None, "empty": None}


def test_every_observed_outcome_counts(frame):
    rows = table_rows(TWO_BY_TWO | {("a", "Maybe"): 4, ("b", "yes"): 1})
    df = frame(rows, "g string, o string")
    cells = {(r.g, r.o): r.observed for r in chi_square.expected_counts(df, "g", "o").collect()}
    assert cells[("b", "Maybe")] == 0 and sum(cells.values()) == len(rows) and len(cells) == 8
    with pytest.raises(Exception, match="values other than"):
        cross_counts(df, "g", "o", ["No", "Yes"]).collect()


def test_levels_correlate_like_their_flags(frame):
    rng = np.random.default_rng(4)
    rows = [(["x", "y", "z", None][i], float(o) if o < 2 else None) for i, o in zip(rng.integers(0, 4, 400), rng.integers(0, 3, 400))]
    df = frame(rows, "c string, o double")
    found = {r.column: r.r for r in correlation.correlation_of_levels(df, ["c"], F.col("o")).collect()}
    known = [(c, o) for c, o in rows if o is not None]
    for level in "xyz":
        flags = [float(c == level) for c, _ in known]
        assert found[f"c_{level}"] == pytest.approx(np.corrcoef(flags, [o for _, o in known])[0, 1], abs=1e-12)


def test_both_densities_agree(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("g"), F.sqrt((F.col("id") * 7919 % 1009).cast("double")).alias("v"))
    one, two = (
        density.kernel_density(df.repartition(4), ["g"], "v", points=40, continuous=c).orderBy("g", "point").collect()
        for c in (False, True)
    )
    assert len(one) == len(two) == 120
    for a, b in zip(one, two):
        assert (a.g, a.point) == (b.g, b.point)
        assert a.x == pytest.approx(b.x, abs=1e-9) and a.density == pytest.approx(b.density, abs=1e-12)


def test_approximate_describe(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    row = quantiles.describe(df, ["v"], approx=True).first()
    assert (row["25%"], row["50%"], row["75%"]) == (2500.0, 5000.0, 7500.0)


def test_correlation_over_many_tasks(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e6, 1, 4000)
    b = a * 0.5 + rng.normal(0, 1, 4000)
    present = rng.random(4000) < 0.7
    rows = [(float(x), float(y) if p else None, True) for x, y, p in zip(a, b, present)]
    df = spark.createDataFrame(rows, "a double, b double, t boolean").repartition(7)
    found = {(r.x, r.y): r.r for r in correlation.correlation_matrix(df, ["a", "b", "t"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef(a[present], b[present])[0, 1], abs=1e-9)
    assert found["a", "t"] is None


def test_density_integrates_to_one_and_matches_direct_sum(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(30, 8, 900))
    df = spark.createDataFrame([("A", float(v)) for v in values] + [(None, 3.0)], "g string, v double")
    rows = density.kernel_density(df, ["g"], "v").orderBy("point").collect()
    x, d = np.array([r.x for r in rows]), np.array([r.density for r in rows])
    assert len(rows) == 200 and np.trapezoid(d, x) == pytest.approx(1, abs=0.01)
    width = values.std(ddof=1) * len(values) ** -0.2
    direct = np.exp(-0.5 * ((x[:, None] - values) / width) ** 2).sum(axis=1) / (len(values) * width * math.sqrt(2 * math.pi))
    assert d == pytest.approx(direct, abs=1e-12)


@pytest.mark.parametrize("error", [1e-3, 1e-8, 1e-15])
def test_density_keeps_its_error_bound(spark, error):
    """Far apart clusters, an outlier, and grids finer and coarser than the cells."""
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(0, 1, 300), rng.normal(40, 0.01, 200), rng.exponential(3, 100), [1e3, -1e3]])
    df = spark.createDataFrame([("A", float(v)) for v in values], "g string, v double").repartition(5)
    width = values.std(ddof=1) * len(values) ** -0.2
    for points, continuous in ((7, True), (60, False), (900, True)):
        rows = density.kernel_density(df, ["g"], "v", points=points, continuous=continuous, error=error).orderBy("point").collect()
        x, d = np.array([r.x for r in rows]), np.array([r.density for r in rows])
        bumps = np.exp(-0.5 * ((x[:, None] - values) / width) ** 2)
        direct = bumps.sum(axis=1) / (len(values) * width * math.sqrt(2 * math.pi))
        assert len(rows) == points and (d >= 0).all()
        # 1e-14 for the rounding of the grid itself
        assert np.abs(d - direct).max() * width * math.sqrt(2 * math.pi) <= error + 1e-14


def test_density_sends_cells_not_points(spark):
    df = spark.range(20_000).select(F.lit("A").alias("g"), F.sqrt(F.col("id").cast("double")).alias("v"))
    stats = df.groupBy("g").agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("std"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    weighted = df.select("g", F.col("v").alias("value"), F.lit(1.0).alias("weight"))
    few, many = (
        density._cells(weighted, density._grids(stats, ["g"], points, 3.0), ["g"], density._terms(1e-15)).count()
        for points in (50, 5000)
    )
    assert abs(few - many) <= 1 and many < 200
    assert "Python" not in density.kernel_density(df, ["g"], "v", continuous=True)._jdf.queryExecution().toString()


def test_constant_data_has_no_density(frame):
    assert density.kernel_density(frame([("A", 1.0), ("A", float("inf"))], "g string, v double"), ["g"], "v").count() == 0
    assert density.kernel_density(frame([("A", 1.0), ("A", 1.0)], "g string, v double"), ["g"], "v").count() == 0


def test_histogram_and_cells(frame):
    df = frame([(0,), (0,), (2,), (None,)], "v int")
    assert [tuple(r) for r in density.histogram(df, "v").collect()] == [(0.0, 2), (2.0, 1)]
    points = frame([("M", 4.9, 10.0), ("M", 0.1, 11.0), ("M", -0.1, 10.0)], "s string, x double, y double")
    cells = {(r.x_bin, r.y_bin): r.n for r in density.density_2d(points, ["s"], "x", "y", 5, 5).collect()}
    assert cells == {(0.0, 10.0): 2, (-5.0, 10.0): 1}


def test_chi_square_of_many_levels_and_of_nothing(frame):
    """The statistic needs no grid: compared with all cells, also where most pairs never occur."""
    import random

    random.seed(6)
    for levels in (2, 3, 40):
        rows = [(f"r{random.randint(1, levels)}", f"c{random.randint(1, levels)}") for _ in range(levels * 3)] + [("r1", None)]
        rows += [("r1", "c1"), ("r2", "c2")]
        df = frame(rows, "g string, o string")
        cells = chi_square.expected_counts(df, "g", "o").collect()
        for correction in (True, False):
            found = chi_square.chi_square(df, "g", "o", correction).first()
            degrees = (len({c.g for c in cells}) - 1) * (len({c.o for c in cells}) - 1)
            gaps = [abs(c.observed - c.expected) for c in cells]
            if correction and degrees == 1:
                gaps = [x - min(0.5, x) for x in gaps]
            assert found.dof == degrees
            assert found.statistic == pytest.approx(sum(x * x / c.expected for x, c in zip(gaps, cells)), rel=1e-9)
    empty = chi_square.with_p_value(chi_square.chi_square(frame([], "g string, o string"), "g", "o")).first()
    assert (empty.statistic, empty.dof, empty.p_value) == (None, 0, None)
    one = chi_square.chi_square(frame([("a", "x")] * 5, "g string, o string"), "g", "o").first()
    assert (one.statistic, one.dof) == (0.0, 0)


def test_p_values_to_the_last_digits(frame):
    """Closed forms for whole and half numbers, many tests at once; no Python on the way."""

    def closed(statistic, dof):
        half = statistic / 2
        tail, start = (math.erfc(math.sqrt(half)), 0.5) if dof % 2 else (math.exp(-half), 1.0)
        terms = [start + i for i in range(int(dof / 2 - start))]
        if half > 0:
            tail += math.fsum(math.exp(a * math.log(half) - half - math.lgamma(a + 1)) for a in terms)
        return min(tail, 1.0)

    rows = [(x, d) for d in (1, 2, 3, 4, 7, 30, 101, 500)
            for x in (0.0, 1e-9, 0.01, 1.0, 0.5 * d, d - 0.5, d + 1.0, d + 2.0, d + 2.5, 2.0 * d + 4, 300.0)]
    df = chi_square.with_p_value(frame([*rows, (None, 3), (4.0, 0), (None, None)], "statistic double, dof long"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for r in df.collect():
        if r.statistic is None or not r.dof:
            assert r.p_value is None
        else:
            assert r.p_value == pytest.approx(closed(r.statistic, r.dof), abs=1e-12)
