"""30-day readmissions without a self-join and without one task per patient.

An inpatient admission is a readmission when the same patient has an inpatient
discharge strictly earlier and at most 30 calendar days back. Only two facts about a
patient's days decide that: the last earlier day with a discharge, and the first
discharge on the admission's own day. Both come from rows reduced to one per patient
and day, so even a patient who holds a third of all rows contributes at most one row
per calendar day to the window, and the lookup back to the admissions is spread by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_DAYS = 30  # Fixed value: longest gap that still counts as a readmission.


def patient_days(admissions: DataFrame, discharges: DataFrame) -> DataFrame:
    """One row per patient and day: first discharge of the day, last earlier discharge day.

    admissions has patient_id + day; discharges has patient_id + day + first_discharge.
    One aggregate over the union collapses both before the shuffle.
    """
    days = admissions.select(
        "patient_id", "day", F.lit(None).cast("timestamp_ntz").alias("first_discharge")
    ).unionByName(discharges)
    per_day = days.groupBy("patient_id", "day").agg(F.min("first_discharge").alias("first_discharge"))
    return per_day.withColumn("last_discharge_day", _last_day(["patient_id"]))


def _last_day(owner: list[str]) -> Column:
    """Last day before the row's with a discharge of the same owner."""
    earlier = Window.partitionBy(*owner).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return F.max(F.when(F.col("first_discharge").isNotNull(), F.col("day"))).over(earlier)


def _within_window() -> Column:
    """Whether every admission of the day follows a discharge of an earlier day."""
    return F.coalesce(F.datediff("day", "last_discharge_day") <= WINDOW_DAYS, F.lit(False))


def qualifying_days(days: DataFrame) -> DataFrame:
    """Days on which an admission is a readmission, or is one after a given time."""
    return days.withColumn("any_time", _within_window()).filter(
        F.col("any_time") | F.col("first_discharge").isNotNull()
    )


def readmitted(admissions: DataFrame, discharges: DataFrame) -> DataFrame:
    """Ids of the admissions that are readmissions, each once.

    admissions: encounter_id, patient_id, admitted; discharges: patient_id, discharged.
    Both hold inpatients only; stays without a discharge cannot lead to a readmission.
    """
    rows = admissions.withColumn("day", F.to_date("admitted"))
    # The discharges are not reduced here first: the union below does it in one aggregate.
    known = discharges.filter(F.col("discharged").isNotNull()).select(
        "patient_id", F.to_date("discharged").alias("day"), F.col("discharged").alias("first_discharge")
    )
    days = qualifying_days(patient_days(rows, known))
    hit = F.col("any_time") | (F.col("first_discharge") < F.col("admitted"))
    return rows.join(days, ["patient_id", "day"]).filter(hit).select("encounter_id").distinct()


def stays_of(facts: DataFrame) -> DataFrame:
    """Inpatient admissions of facts that carry is_inpatient."""
    return facts.filter("is_inpatient").select(
        "encounter_id", "patient_id", F.col("encounter_datetime").alias("admitted")
    )


def flag(facts: DataFrame, stays: DataFrame, discharges: DataFrame) -> DataFrame:
    """Facts with is_readmission; only the inpatient stays are shuffled by patient."""
    hits = readmitted(stays, discharges).withColumn("is_readmission", F.lit(True))
    return facts.join(hits, "encounter_id", "left").withColumn(
        "is_readmission", F.coalesce("is_readmission", F.lit(False))
    )


def readmissions_by_index(discharges: DataFrame, admissions: DataFrame, by: str) -> DataFrame:
    """Per value of `by` of the index discharge: discharges and distinct readmissions.

    One readmission may follow discharges of several values and counts once for each. No
    pair of encounters is formed: a patient's admission days, counted, are repeated once
    per value that patient was ever discharged under, and looked up against the discharge
    days of that value. Only days with both a discharge and an admission, and none in the
    30 days before, go back to the single admissions.
    """
    owner = ["patient_id", by]
    left = (
        discharges.filter(F.col("discharged").isNotNull())
        .groupBy(*owner, F.to_date("discharged").alias("day"))
        .agg(F.min("discharged").alias("first_discharge"), F.count("*").alias("n_out"))
        .withColumn("n_in", F.lit(0).cast("bigint"))
    )
    rows = admissions.withColumn("day", F.to_date("admitted"))
    came = rows.groupBy("patient_id", "day").agg(F.count("*").alias("n_in"))
    events = left.unionByName(came, allowMissingColumns=True).withColumn(
        "_value", F.when(F.col("n_out").isNotNull(), F.struct(by))
    )
    # The values of a patient are bounded by their number, the days by the calendar.
    values = F.collect_set("_value").over(Window.partitionBy("patient_id"))
    own = F.when(F.col("_value").isNull(), F.col("_values")).otherwise(F.array("_value"))
    days = (
        events.withColumn("_values", values)
        .withColumn("_own", F.explode(own))
        .withColumn(by, F.col("_own")[by])
        .groupBy(*owner, "day")
        .agg(
            F.min("first_discharge").alias("first_discharge"),
            F.sum(F.coalesce("n_out", F.lit(0))).alias("n_out"),
            F.sum("n_in").alias("n_in"),
        )
        .withColumn("last_discharge_day", _last_day(owner))
        .withColumn("any_time", _within_window())
    )
    zero = F.lit(0).cast("bigint")
    totals = days.groupBy(by).agg(
        F.sum("n_out").alias("discharges"),
        F.sum(F.when(F.col("any_time"), F.col("n_in")).otherwise(zero)).alias("readmissions"),
    )
    same_day = (
        days.filter(~F.col("any_time") & (F.col("n_out") > 0) & (F.col("n_in") > 0))
        .join(rows, ["patient_id", "day"])
        .filter(F.col("first_discharge") < F.col("admitted"))
        .groupBy(by)
        .agg(zero.alias("discharges"), F.count("*").alias("readmissions"))
    )
    return (
        totals.unionByName(same_day)
        .groupBy(by)
        .agg(F.sum("discharges").alias("discharges"), F.sum("readmissions").alias("readmissions"))
    )
