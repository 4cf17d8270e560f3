"""Meet results: preparation of two tables, and their exploration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyworks import fixed_values
from tallyworks.functions.nulls import all_present, clamp_negative, count_negatives, differs, equals, safe_ratio
from tallyworks.functions.recode import level_or_null
from tallyworks.operators.aggregates import conditional_counts, drop_missing_keys, rows
from tallyworks.operators.ranking import top_k
from tallyworks.sources.readers import read_parquet
from tallyworks.sources.writers import overwrite_parquet


def prepare_results(raw: DataFrame, age_classes: Sequence[str] = fixed_values.AGE_CLASSES) -> DataFrame:
    """Typed results with failed attempts, lift-to-bodyweight ratios and year."""
    best = fixed_values.BEST_LIFTS
    typed = raw.withColumns(
        {
            "Tested": equals("Tested", "Yes"),
            "AgeClass": level_or_null("AgeClass", age_classes),
            "Date": F.to_date("Date"),
            **{column: clamp_negative(column) for column in best.values()},
            "FailedAttempts": count_negatives(fixed_values.ATTEMPT_COLUMNS),
        }
    ).drop(*fixed_values.UNUSED_RESULT_COLUMNS, *fixed_values.ATTEMPT_COLUMNS)
    return typed.withColumns(
        {ratio: safe_ratio(lift, "BodyweightKg") for ratio, lift in best.items()}
        | {"Year": F.year("Date")}
    )


def meets(results: DataFrame) -> DataFrame:
    """Distinct meets with the participants and failed attempts of (name, date).

    The results are aggregated once, to distinct meets; the totals of (name,
    date) add up those few rows. A meet without name or date has missing totals.
    """
    key = ["MeetName", "Date"]
    listed = results.groupBy(*fixed_values.MEET_COLUMNS, "Year").agg(
        F.sum("FailedAttempts").alias("_failed"), F.count(F.lit(1)).alias("_rows")
    )
    shared = Window.partitionBy(*key)
    return listed.select(
        *fixed_values.MEET_COLUMNS,
        F.when(all_present(key), F.sum("_failed").over(shared)).alias("FailedAttempts"),
        "Year",
        F.when(all_present(key), F.sum("_rows").over(shared)).alias("Participants"),
    )


def top_federations(results: DataFrame, k: int = 5) -> DataFrame:
    """Parent federations by named participants."""
    counts = drop_missing_keys(results, ["ParentFederation"]).groupBy("ParentFederation")
    return top_k(counts.agg(F.count("Name").alias("participants")), "participants", k, ["ParentFederation"])


def meet_means(meet_table: DataFrame) -> DataFrame:
    return meet_table.agg(
        F.avg("Participants").alias("Participants"), F.avg("FailedAttempts").alias("FailedAttempts")
    )


def top_meet_countries(meet_table: DataFrame, k: int = 10) -> DataFrame:
    counts = drop_missing_keys(meet_table, ["MeetCountry"]).groupBy("MeetCountry")
    return top_k(counts.agg(F.count("MeetName").alias("meets")), "meets", k, ["MeetCountry"])


def meets_per_year(meet_table: DataFrame, except_year: int = 2023) -> DataFrame:
    return meet_table.filter(F.col("Year") != except_year).groupBy("Year").agg(rows("meets")).orderBy("Year")


def participants_per_year(results: DataFrame, male: str = "M", except_year: int = 2023) -> DataFrame:
    """Male and non-male participants; a missing sex counts as non-male."""
    return conditional_counts(
        results.filter(F.col("Year") != except_year),
        ["Year"],
        {"male": equals("Sex", male), "non_male": differs("Sex", male)},
    ).orderBy("Year")


def run(raw: DataFrame, results_path: str, meets_path: str) -> dict[str, int]:
    """Write the two prepared tables and return the rows of each.

    The meets are made from the results as written, so the raw file is read once.
    """
    written = overwrite_parquet(prepare_results(raw), results_path)
    prepared = read_parquet(raw.sparkSession, results_path, nan_as_null=False)
    return {"results": written, "meets": overwrite_parquet(meets(prepared), meets_path)}
