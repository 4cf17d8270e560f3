"""Release decisions: two groups compared by their rate of missed appearances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks import fixed_values
from tallyworks.functions.nulls import equals
from tallyworks.functions.recode import level_position, month_of, normalise, percent_text, recode, score_label, two_way
from tallyworks.operators.aggregates import conditional_counts, cross_counts, drop_missing_keys, rate_by, rows, sizes_by
from tallyworks.operators.density import kernel_density

GROUPS = ["A", "B"]
OUTCOMES = ["No", "Yes"]


def decision_group() -> Column:
    """A: released against a recommendation to detain. B: released as recommended."""
    recommendation, followed = F.col("Pretrial_Recommendation"), F.col("Judge_Followed_Recommendation")
    return F.when((recommendation == "Detain") & (followed == "No"), "A").when(
        (recommendation == "Release") & (followed == "Yes"), "B"
    )


def clean(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "Pretrial_Recommendation": two_way("Pretrial_Recommendation", "Detain", "Detain", "Release"),
            "Gender": recode(normalise("Gender"), fixed_values.GENDERS, "Other"),
            "Race": recode(normalise("Race"), fixed_values.RACES, "Other"),
            "VPRAI_Score_Grouped": score_label("VPRAI_Score", 5),
            "Booking_Date": F.to_date("Booking_Date"),
        }
    )


def study(raw: DataFrame) -> DataFrame:
    """Cleaned cases of the two groups."""
    return clean(raw).withColumn("Group", decision_group()).filter(F.col("Group").isin(GROUPS))


def rates(cases: DataFrame) -> DataFrame:
    return rate_by(cases, ["Group"], "FTA", "Yes", "FTA_Rate")


def rate_labels(cases: DataFrame) -> DataFrame:
    return rates(cases).select("Group", percent_text("FTA_Rate").alias("FTA_Label"))


def rates_by_release(cases: DataFrame) -> DataFrame:
    return rate_by(cases, ["Group", "Release_Type"], "FTA", "Yes", "FTA_Rate")


def rates_by_score(cases: DataFrame) -> DataFrame:
    """In order of the score levels."""
    by_score = rate_by(cases, ["Group", "VPRAI_Score_Grouped"], "FTA", "Yes", "FTA_Rate")
    return (
        by_score.withColumn("position", level_position("VPRAI_Score_Grouped", fixed_values.SCORE_LEVELS))
        .withColumnRenamed("VPRAI_Score_Grouped", "VPRAI_Score")
        .orderBy("position", "Group")
    )


def outcome_table(cases: DataFrame) -> DataFrame:
    return cross_counts(cases, "Group", "FTA", OUTCOMES)


def counts_by(cases: DataFrame, attribute: str) -> DataFrame:
    return sizes_by(cases, [attribute, "Group"], "Count")


def outcomes_by(cases: DataFrame, attribute: str) -> DataFrame:
    """Cases with and without a missed appearance; an unknown outcome is without."""
    flagged = cases.withColumn("FTA_Flag", equals("FTA", "Yes"))
    return sizes_by(flagged, [attribute, "FTA_Flag"], "Count")


def missed_by_score(cases: DataFrame) -> DataFrame:
    return counts_by(cases.filter(F.col("FTA") == "Yes"), "VPRAI_Score_Grouped")


def monthly_trend(cases: DataFrame) -> DataFrame:
    """Missed appearances per month and group; months without any are absent."""
    missed = cases.filter(F.col("FTA") == "Yes").withColumn("month", month_of("Booking_Date"))
    return conditional_counts(
        drop_missing_keys(missed, ["month"]), ["month"], {g: F.col("Group") == g for g in GROUPS}
    ).orderBy("month")


def age_density(cases: DataFrame) -> DataFrame:
    return kernel_density(cases, ["Group"], "AgeAtBooking")


def age_density_of_missed(cases: DataFrame) -> DataFrame:
    """All cases against those with a missed appearance."""
    series = F.when(F.col("FTA") == "Yes", F.array(F.lit("All"), F.lit("FTA Only"))).otherwise(F.array(F.lit("All")))
    return kernel_density(cases.select("AgeAtBooking", F.explode(series).alias("series")), ["series"], "AgeAtBooking")


def group_sizes(cases: DataFrame) -> DataFrame:
    return cases.groupBy("Group").agg(rows("Count"))
