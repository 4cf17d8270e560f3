"""Video-watching report: six questions over views, videos, viewers, countries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions.text import split_list
from tallyworks.operators.aggregates import mean_by, sum_and_distinct_by, sum_by
from tallyworks.operators.ranking import top_k, top_k_with_ties


def watch_time_by_video(views: DataFrame) -> DataFrame:
    return sum_by(views, ["video_id"], "watch_time_minutes", "total_watch_time")


def top_videos_by_type(views: DataFrame, videos: DataFrame, k: int = 10) -> DataFrame:
    """Most watched videos of each type; equal totals share a rank."""
    watched = watch_time_by_video(views).join(videos, "video_id")
    return top_k_with_ties(watched.select("type", "title", "total_watch_time"), ["type"], "total_watch_time", k)


def viewer_totals(views: DataFrame) -> DataFrame:
    return sum_and_distinct_by(
        views, ["viewer_id"], "watch_time_minutes", "total_watch_time", "video_id", "total_unique_videos_watched"
    )


def top_viewers(views: DataFrame, by: str = "total_watch_time", k: int = 10) -> DataFrame:
    return top_k(viewer_totals(views), by, k, ["viewer_id"])


def watch_time_by_country(views: DataFrame, viewers: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    """Top countries by name; ids sharing a name are one country.

    Minutes are summed per viewer and per country id before each join, so a
    viewer or country with very many views meets the join as one row.
    """
    per_viewer = sum_by(views, ["viewer_id"], "watch_time_minutes", "_minutes")
    per_id = sum_by(per_viewer.join(viewers, "viewer_id"), ["country_id"], "_minutes", "_minutes")
    named = per_id.join(countries.select("country_id", "country"), "country_id")
    return top_k(sum_by(named, ["country"], "_minutes", "total_watch_time"), "total_watch_time", k, ["country"])


def watch_time_by_audience(views: DataFrame, videos: DataFrame) -> DataFrame:
    """Mean total watch time of videos with the same number of unique viewers."""
    per_video = sum_and_distinct_by(
        views, ["video_id"], "watch_time_minutes", "total_watch_time", "viewer_id", "num_unique_viewers"
    )
    listed = per_video.join(videos.select("video_id"), "video_id")
    return mean_by(
        listed, ["num_unique_viewers"], "total_watch_time", "average_total_watch_time"
    ).orderBy(F.desc("num_unique_viewers"))


def mean_watch_by_video(views: DataFrame, videos: DataFrame, integer: bool = False) -> DataFrame:
    means = mean_by(views, ["video_id"], "watch_time_minutes", "average_watch_time", integer)
    return means.join(videos.select("video_id"), "video_id").orderBy(F.desc("average_watch_time"), "video_id")


def mean_watch(views: DataFrame, integer: bool = False) -> DataFrame:
    return mean_by(views, [], "watch_time_minutes", "average_watch_time", integer)


def _by_genre(videos: DataFrame) -> DataFrame:
    return videos.select("video_id", F.explode(split_list("genre")).alias("genre"))


def watch_time_by_genre(views: DataFrame, videos: DataFrame, k: int = 10) -> DataFrame:
    listed = watch_time_by_video(views).join(_by_genre(videos), "video_id")
    totals = sum_by(listed, ["genre"], "total_watch_time", "_total").withColumnRenamed("_total", "total_watch_time")
    return top_k(totals, "total_watch_time", k, ["genre"])


def videos_by_genre(videos: DataFrame) -> DataFrame:
    return (
        _by_genre(videos)
        .groupBy("genre")
        .agg(F.count_distinct("video_id").alias("num_videos"))
        .orderBy(F.desc("num_videos"), "genre")
    )
