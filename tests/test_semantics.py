"""Missing values, rounding, ties and other rules, on literal rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tallyworks import fixed_values
from tallyworks.functions import nested, nulls, recode, text
from tallyworks.operators import aggregates, correlation, quantiles, ranking
from tallyworks.plans import meets, study, video

NAN = float("nan")


def test_nan_is_missing(frame, column_of):
    df = nulls.nan_to_null(frame([(1.0,), (NAN,), (None,), (-1.0,), (0.0,)], "x double"))
    assert column_of(df) == [1.0, None, None, -1.0, 0.0]
    row = df.agg(F.avg("x").alias("m"), F.count("x").alias("n")).first()
    assert (row.m, row.n) == (0.0, 3)


def test_negative_checks(frame, column_of):
    df = frame([(1.0,), (None,), (-1.0,), (0.0,)], "x double")
    assert column_of(df.select(nulls.count_negatives(["x", "x"]))) == [0, 0, 2, 0]
    assert column_of(df.select(nulls.clamp_negative("x"))) == [1.0, None, 0.0, 0.0]


def test_missing_score_lands_in_the_top_label(frame, column_of):
    df = frame([(0,), (4,), (5,), (9,), (None,)], "s int")
    assert column_of(df.select(recode.score_label("s"))) == ["0", "4", "5+", "5+", "5+"]


def test_missing_sex_is_not_male(frame):
    df = frame([("M",), ("F",), ("Mx",), (None,)], "Sex string")
    assert df.filter(nulls.differs("Sex", "M")).count() == 3


def test_years(frame):
    rows = [("M", 2022), (None, 2022), ("F", 2023), ("M", None)]
    df = frame(rows, "Sex string, Year int")
    assert [tuple(r) for r in meets.participants_per_year(df).collect()] == [(2022, 1, 1)]


def test_groups_without_key_are_dropped(frame):
    df = frame([("a", 1.0), (None, 2.0), ("a", None)], "k string, v double")
    assert [tuple(r) for r in aggregates.value_counts(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in aggregates.means_by(df, "k").collect()] == [("a", 1.0)]


def test_meet_totals_need_name_and_date(frame):
    day = dt.date(2020, 1, 1)
    rows = [("m1", "US", day, "X", None, 2020, 1), ("m1", "US", day, "Y", None, 2020, 2)]
    rows += [(None, "US", day, "X", None, 2020, 4), ("m1", "US", None, "X", None, None, 8)]
    df = frame(
        rows,
        "MeetName string, MeetCountry string, Date date, Federation string, ParentFederation string, Year int, FailedAttempts int",
    )
    found = {(r.MeetName, r.Date, r.Federation): (r.Participants, r.FailedAttempts) for r in meets.meets(df).collect()}
    # two federations share a meet: two rows, both with the combined totals
    assert found[("m1", day, "X")] == found[("m1", day, "Y")] == (2, 3)
    assert found[(None, day, "X")] == (None, None)
    assert found[("m1", None, "X")] == (None, None)


def test_unseen_levels_are_kept(frame):
    df = frame([("a", 1.0), ("a", 3.0), ("c", 5.0), ("z", 7.0), (None, 9.0)], "k string, v double")
    counts = aggregates.counts_by_level(df, "k", ["a", "b", "c"])
    assert [(r.k, r.n) for r in counts.collect()] == [("a", 2), ("b", 0), ("c", 1)]
    means = aggregates.means_by_level(df, "k", ["a", "b", "c"], ["v"])
    assert [(r.k, r.v) for r in means.collect()] == [("a", 2.0), ("b", None), ("c", 5.0)]


def test_age_classes_are_ordered_and_closed(frame):
    df = frame([("5-12",), ("80-999",), ("90+",), (None,)], "c string")
    levels = fixed_values.AGE_CLASSES
    row = df.select(recode.level_or_null("c", levels).alias("v"), recode.level_position("c", levels).alias("p")).collect()
    assert [tuple(r) for r in row] == [("5-12", 0), ("80-999", 15), (None, None), (None, None)]


def test_ratio_by_zero_is_missing(frame, column_of):
    df = frame([(10.0, 2.0), (10.0, 0.0), (0.0, 0.0), (None, 2.0), (10.0, None)], "a double, b double")
    assert column_of(df.select(nulls.safe_ratio("a", "b"))) == [5.0, None, None, None, None]


def test_correlation_of_incomplete_and_constant_columns(frame):
    df = frame(
        [(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, None), (3.0, None, 7.0, None), (4.0, 7.0, 7.0, None)],
        "a double, b double, c double, d double",
    )
    found = {(r.x, r.y): r.r for r in correlation.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert len(found) == 16
    assert found["a", "b"] == found["b", "a"] == pytest.approx(0.9971764650, abs=1e-9)
    assert found["a", "a"] == pytest.approx(1.0)
    assert all(found[p] is None for p in found if "c" in p or "d" in p)
    by_outcome = correlation.correlation_with(df, ["a", "b"], F.col("a")).collect()
    assert [r.column for r in by_outcome] == ["b", "a"]


def test_null_shares_round_half_to_even(frame):
    df = frame([(None if i == 0 else i, i) for i in range(16)], "a int, b int")
    assert [tuple(r) for r in aggregates.null_profile(df).collect()] == [("a", 0.062), ("b", 0.0)]


def test_describe_interpolates(frame):
    df = frame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = quantiles.describe(df, ["x"]).first()
    assert row["count"] == 4 and row["mean"] == 4.0 and row["max"] == 10.0
    assert (row["25%"], row["50%"], row["75%"]) == (1.75, 2.5, 4.75)
    assert row["std"] == pytest.approx(4.0824829046)


def test_numbers_as_text(frame, column_of):
    df = frame([("34",), ("x",), ("",), (None,), ("NaN",), (" 7.5 ",)], "t string")
    assert column_of(df.select(recode.number_or_null("t"))) == [34.0, None, None, None, None, 7.5]


def test_integer_average_drops_the_fraction(frame):
    df = frame([(1, 1), (1, 2)], "video_id int, watch_time_minutes int")
    videos = frame([(1,)], "video_id int")
    assert video.mean_watch_by_video(df, videos).first().average_watch_time == 1.5
    assert video.mean_watch_by_video(df, videos, integer=True).first().average_watch_time == 1
    assert video.mean_watch(df.filter("false"), integer=True).first()[0] is None


def test_ties(frame):
    rows = [("t", i, 100 - i) for i in range(9)] + [("t", 10, 50), ("t", 11, 50), ("t", 12, 49)]
    df = frame(rows, "type string, title int, total int")
    assert ranking.top_k_with_ties(df, ["type"], "total", 10).count() == 11
    top = ranking.top_k(df, "total", 10, ["title"]).collect()
    assert len(top) == 10 and top[-1].title == 10


def test_ranks_with_missing_values_and_small_groups(frame):
    rows = [("a", 3), ("a", None), ("a", None), ("a", 1), (None, 5), (None, 4), ("b", 2), ("b", 2), ("b", 2), ("b", 1)]
    df = frame(rows, "g string, v int")
    kept = sorted(ranking.top_k_with_ties(df, ["g"], "v", 3).collect(), key=str)
    # a: ranks 1, 2, 3, 3; missing group is a group; b: three share rank 1
    assert sorted(kept, key=str) == sorted([r for r in df.collect() if not (r.g == "b" and r.v == 1)], key=str)


def test_countries_of_one_name_are_one(frame):
    views = frame([(1, 10, 5), (2, 10, 7)], "viewer_id int, video_id int, watch_time_minutes int")
    viewers = frame([(1, 1), (2, 2)], "viewer_id int, country_id int")
    countries = frame([(1, "KOREA"), (2, "KOREA")], "country_id int, country string")
    assert [tuple(r) for r in video.watch_time_by_country(views, viewers, countries).collect()] == [("KOREA", 12)]


def test_genre_lists(frame):
    videos = frame([(1, "a, b"), (2, ""), (3, None), (4, "a,a")], "video_id int, genre string")
    views = frame([(1, 1, 10), (1, 4, 3)], "viewer_id int, video_id int, watch_time_minutes int")
    counts = {r.genre: r.num_videos for r in video.videos_by_genre(videos).collect()}
    assert counts == {"a": 2, "b": 1, "": 1}
    # a repeated genre counts twice in the sum
    assert {r.genre: r.total_watch_time for r in video.watch_time_by_genre(views, videos).collect()} == {"a": 16, "b": 10}


def test_unicode_tokens(frame, column_of):
    df = frame([("été ab_1 x don t.9z",)], "t string")
    assert column_of(df.select(text.tokens("t"))) == [["été", "ab_1", "don", "9z"]]


def test_rates_ignore_unknown_outcomes(frame):
    df = frame([("A", "Yes"), ("A", "No"), ("A", None), ("B", None)], "Group string, FTA string")
    assert {r.Group: r.FTA_Rate for r in study.rates(df).collect()} == {"A": 0.5, "B": None}
    assert {r.Group: r.FTA_Label for r in study.rate_labels(df).collect()} == {"A": "50.0%", "B": None}


def test_recode_defaults(frame, column_of):
    df = frame([(" Male ",), ("FEMALE\n",), ("x",), (None,)], "g string")
    recoded = recode.recode(recode.normalise("g"), fixed_values.GENDERS, "Other")
    assert column_of(df.select(recoded)) == ["Male", "Female", "Other", "Other"]
    two = recode.two_way("g", "x", "Detain", "Release")
    assert column_of(df.select(two)) == ["Release", "Release", "Detain", "Release"]


def test_race_map():
    assert len(fixed_values.RACES) == 18
    assert set(fixed_values.RACES.values()) == {"Black", "White", "Hispanic", "Asian/Pacific Islander"}


def test_groups_of_the_study(frame):
    rows = [("Detain", "No"), ("Release", "Yes"), ("Detain", "Yes"), ("Release", "No"), ("Release", None)]
    df = frame(rows, "Pretrial_Recommendation string, Judge_Followed_Recommendation string")
    assert [r[0] for r in df.select(study.decision_group()).collect()] == ["A", "B", None, None, None]


def test_short_lists_give_the_default(frame, column_of):
    df = frame([([],), ([(5.0,)],), (None,), ([(None,)],)], "receipts array<struct<p: double>>")
    assert column_of(df.select(nested.first_item("receipts", "p"))) == [0.0, 5.0, 0.0, 0.0]


def test_flatten_keeps_lists(frame):
    df = frame([(1, ((2.5,), None), [1, 2])], "id int, q struct<USD: struct<price: double>, n: int>, l array<int>")
    flat = nested.flatten(df)
    assert flat.columns == ["id", "q_USD_price", "q_n", "l"]
    assert tuple(flat.first()) == (1, 2.5, None, [1, 2])


def test_missing_parent_is_missing_child(frame):
    df = frame([(1, None)], "id int, platform struct<name: string>")
    assert nested.flatten(df).first().platform_name is None


def test_casts_that_do_not_fit_are_missing(frame):
    from pyspark.sql import types as T

    df = frame([("70000", "x"), ("12", "3.5")], "a string, b string")
    schema = T.StructType([T.StructField("a", T.ShortType()), T.StructField("b", T.FloatType())])
    assert [tuple(r) for r in df.select(*recode.cast_to(schema)).collect()] == [(None, None), (12, 3.5)]


def test_timestamps(frame, column_of):
    df = frame([("2020-01-31",), ("soon",)], "t string")
    parsed = column_of(df.select(recode.parse_timestamp("t", "yyyy-MM-dd", strict=False)))
    assert parsed == [dt.datetime(2020, 1, 31), None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(recode.parse_timestamp("t", "yyyy-MM-dd")).collect()


def test_decades(frame, column_of):
    df = frame([(19.0,), (40.0,), (None,)], "a double")
    assert column_of(df.select(recode.decade("a"))) == [10, 40, None]


def test_fill_with_mean(frame, column_of):
    df = frame([(1.0,), (3.0,), (None,)], "x double")
    assert sorted(column_of(aggregates.fill_with_mean(df, "x"))) == [1.0, 2.0, 3.0]


def test_kept_for_every_value_is_finite(tables):
    ratio = meets.prepare_results(tables.raw_results(), []).select("SquatRatio")
    assert not any(r[0] is not None and not math.isfinite(r[0]) for r in ratio.distinct().collect())
