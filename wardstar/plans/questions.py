"""The business questions on the star and, for the four main ones, on the source tables.

Star forms take the dict of star tables, source forms the dict of source tables. The two
forms of a question may differ by design: the star credits a readmission to the
readmission's specialty and counts patient versions and bills of any status; the source
form credits the index discharge's specialty and counts patients and paid bills.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import year_month
from ..functions.clinical import text_key
from ..functions.money import mean, percent
from ..operators import pairs, visits
from ..operators.facts import INPATIENT
from ..operators.readmission import readmissions_by_index

Tables = Mapping[str, DataFrame]
MONEY = "decimal(38,2)"
MANY_DIAGNOSES = 3  # Fixed value: diagnoses from which a case counts as complex.


def _specialty(star: Tables) -> DataFrame:
    return star["dim_specialty"].select("specialty_key", "specialty_name")


def _types(star: Tables) -> DataFrame:
    return star["dim_encounter_type"].select("encounter_type_key", "encounter_type")


def _is_inpatient(c: str = "encounter_type") -> Column:
    return text_key(F.col(c)) == INPATIENT


# -- 1: monthly encounters by specialty ---------------------------------------------


def monthly_encounters_star(star: Tables) -> DataFrame:
    """The month comes from the fact's partition column, so no calendar join is needed."""
    return (
        star["fact_encounters"]
        .join(_specialty(star), "specialty_key")
        .join(_types(star), "encounter_type_key")
        .groupBy(F.col("year_month").alias("encounter_month"), "specialty_name", "encounter_type")
        .agg(
            F.count("encounter_key").alias("total_encounters"),
            F.count_distinct("patient_key").alias("unique_patients"),
        )
        .orderBy("encounter_month", "specialty_name", "encounter_type")
    )


def monthly_encounters_stored(month_visits: DataFrame, star: Tables) -> DataFrame:
    """The same from the months kept by increments: no fact is read, no patient counted again."""
    group = ("encounter_month", "specialty_name", "encounter_type")
    named = month_visits.join(_specialty(star), "specialty_key").join(_types(star), "encounter_type_key")
    return visits.counted(named.withColumnRenamed("year_month", group[0]), *group).orderBy(*group)


def with_specialty(rows: DataFrame, source: Tables) -> DataFrame:
    """Rows with the specialty name of their provider.

    Two joins with stored tables, whose sizes Spark knows, and not one with a joined side,
    whose size it would have to guess.
    """
    providers = source["providers"].select("provider_id", "specialty_id")
    names = source["specialties"].select("specialty_id", "specialty_name")
    return rows.join(providers, "provider_id").join(names, "specialty_id")


def monthly_encounters_source(source: Tables) -> DataFrame:
    """Both counts are distinct ones: nothing keeps copies out of the source tables."""
    return (
        with_specialty(source["encounters"], source)
        .groupBy(
            year_month(F.col("encounter_date")).alias("encounter_month"), "specialty_name", "encounter_type"
        )
        .agg(
            F.count_distinct("encounter_id").alias("total_encounters"),
            F.count_distinct("patient_id").alias("unique_patients"),
        )
        .orderBy("encounter_month", "specialty_name", "encounter_type")
    )


# -- 2: diagnosis-procedure pairs ---------------------------------------------------


def _by_frequency() -> list[Column]:
    return [F.desc("encounter_count")] + [
        F.asc(c) for c in ("icd10_code", "cpt_code", "icd10_description", "cpt_description")
    ]


def _summary_columns(summary: DataFrame) -> DataFrame:
    return summary.select(
        *pairs.PAIR,
        "encounter_count",
        "total_revenue",
        F.coalesce(mean(F.col("sum_los"), F.col("n_los"), 1), F.lit(0)).cast("decimal(22,1)").alias("avg_los_days"),
    )


def top_pairs_star(star: Tables, n: int = 10) -> DataFrame:
    """The n most frequent pairs; equal counts are ordered by codes, then texts."""
    summary = pairs.pair_summary(
        star["fact_encounters"],
        star["bridge_encounter_diagnoses"],
        star["bridge_encounter_procedures"],
        star["dim_diagnosis"],
        star["dim_procedure"],
    )
    return _summary_columns(summary.orderBy(*_by_frequency()).limit(n))


def pairs_source(source: Tables) -> DataFrame:
    """All pairs with the number of encounters that have both."""
    d_members, d_groups = pairs.code_groups(
        source["diagnoses"], "diagnosis_id", pairs.DIAGNOSIS, "diagnosis_group"
    )
    p_members, p_groups = pairs.code_groups(
        source["procedures"], "procedure_id", pairs.PROCEDURE, "procedure_group"
    )
    d = source["encounter_diagnoses"].join(d_members, "diagnosis_id")
    p = source["encounter_procedures"].join(p_members, "procedure_id")
    totals = (
        d.select("encounter_id", "diagnosis_group")
        .distinct()
        .join(p.select("encounter_id", "procedure_group").distinct(), "encounter_id")
        .groupBy("diagnosis_group", "procedure_group")
        .agg(F.count("*").alias("encounter_count"))
    )
    return (
        pairs.with_texts(totals, d_groups, p_groups)
        .select(*pairs.PAIR, "encounter_count")
        .orderBy(*_by_frequency())
    )


def stored_pairs(star: Tables) -> DataFrame:
    """The kept summary: every pair, no limit."""
    return star["pair_summary"].select(
        *pairs.PAIR,
        "encounter_count",
        "total_revenue",
        mean(F.col("sum_los"), F.col("n_los"), 4).alias("avg_length_of_stay_days"),
    ).orderBy(*_by_frequency())


# -- 3: readmission rate ------------------------------------------------------------


def _rate(rows: DataFrame) -> DataFrame:
    return rows.select(
        "specialty_name",
        "total_discharges",
        "readmissions_within_30days",
        percent(F.col("readmissions_within_30days"), F.col("total_discharges")).alias(
            "readmission_rate_percent"
        ),
    ).orderBy(F.desc("readmission_rate_percent"), "specialty_name")


def readmission_rate_star(star: Tables) -> DataFrame:
    inpatient = _types(star).filter(_is_inpatient()).select("encounter_type_key")
    return _rate(
        star["fact_encounters"]
        .join(inpatient, "encounter_type_key", "left_semi")
        .join(_specialty(star), "specialty_key")
        .groupBy("specialty_name")
        .agg(
            F.count("encounter_key").alias("total_discharges"),
            F.count_if("is_readmission").alias("readmissions_within_30days"),
        )
    )


def readmission_rate_source(source: Tables) -> DataFrame:
    columns = ("encounter_id", "patient_id", "provider_id", "encounter_date", "discharge_date")
    inpatients = source["encounters"].filter(_is_inpatient()).select(*columns).distinct()  # copies count once
    index = (
        with_specialty(inpatients.filter(F.col("discharge_date").isNotNull()), source)
        .select("patient_id", "specialty_name", F.col("discharge_date").alias("discharged"))
    )
    admissions = inpatients.select("patient_id", F.col("encounter_date").alias("admitted"))
    return _rate(
        readmissions_by_index(index, admissions, "specialty_name").select(
            "specialty_name",
            F.col("discharges").alias("total_discharges"),
            F.col("readmissions").alias("readmissions_within_30days"),
        )
    )


# -- 4: revenue by specialty and month ----------------------------------------------


def revenue_star(star: Tables) -> DataFrame:
    total = F.sum("total_allowed_amount")
    return (
        star["fact_encounters"]
        .filter("has_billing")
        .join(_specialty(star), "specialty_key")
        .groupBy(F.col("year_month").alias("revenue_month"), "specialty_name")
        .agg(
            F.count("encounter_key").alias("total_encounters"),
            total.cast(MONEY).alias("total_revenue"),
            mean(total, F.count("total_allowed_amount"), 2).alias("avg_revenue_per_encounter"),
        )
        .orderBy("revenue_month", F.desc("total_revenue"), "specialty_name")
    )


def revenue_source(source: Tables) -> DataFrame:
    """Paid bills only, summed per encounter first so that an encounter counts once."""
    paid = (
        source["billing"]
        .filter(text_key(F.col("claim_status")) == "PAID")
        .groupBy("encounter_id")
        .agg(F.sum("allowed_amount").alias("amount"), F.count("allowed_amount").alias("bills"))
    )
    encounters = source["encounters"].select("encounter_id", "provider_id", "encounter_date")
    total = F.sum("amount")
    return (
        with_specialty(paid.join(encounters, "encounter_id"), source)
        .groupBy(year_month(F.col("encounter_date")).alias("revenue_month"), "specialty_name")
        .agg(
            F.count("*").alias("total_encounters"),
            total.cast(MONEY).alias("total_revenue"),
            mean(total, F.sum("bills"), 2).alias("avg_revenue_per_encounter"),
        )
        .orderBy("revenue_month", F.desc("total_revenue"), "specialty_name")
    )


# -- questions the design promises --------------------------------------------------


def provider_workload(star: Tables) -> DataFrame:
    """Per provider: encounters, complex cases and their share, revenue, mean stay."""
    complex_case = F.col("diagnosis_count") >= MANY_DIAGNOSES
    per_provider = star["fact_encounters"].groupBy("provider_id").agg(
        F.count("*").alias("total_encounters"),
        F.count_if(complex_case).alias("multi_diagnosis_encounters"),
        F.coalesce(F.sum("total_allowed_amount"), F.lit(0)).cast(MONEY).alias("total_revenue"),
        mean(F.sum("length_of_stay_days"), F.count("length_of_stay_days"), 2).alias("avg_los_days"),
    )
    names = star["dim_provider"].filter("is_current").select("provider_id", "full_name", "specialty_name")
    return per_provider.join(names, "provider_id").select(
        "provider_id",
        "full_name",
        "specialty_name",
        "total_encounters",
        "multi_diagnosis_encounters",
        percent(F.col("multi_diagnosis_encounters"), F.col("total_encounters")).alias("multi_diagnosis_percent"),
        "total_revenue",
        "avg_los_days",
    )


def monthly_fact_flags(star: Tables) -> DataFrame:
    """Per month: encounters with many diagnoses, without procedures, without a bill."""
    return (
        star["fact_encounters"]
        .groupBy("year_month")
        .agg(
            F.count("*").alias("total_encounters"),
            F.count_if(F.col("diagnosis_count") >= MANY_DIAGNOSES).alias("multi_diagnosis_encounters"),
            F.count_if(F.col("procedure_count") == 0).alias("encounters_without_procedures"),
            F.count_if(~F.col("has_billing")).alias("unbilled_encounters"),
        )
        .orderBy("year_month")
    )


def age_group_mix(star: Tables) -> DataFrame:
    """Encounters, patients and revenue per age group and gender.

    Facts are reduced to one row per patient version before they meet the dimension.
    """
    per_patient = star["fact_encounters"].groupBy("patient_key").agg(
        F.count("*").alias("n"), F.sum("total_allowed_amount").alias("amount")
    )
    who = star["dim_patient"].select("patient_key", "patient_id", "age_group", "gender")
    return (
        per_patient.join(who, "patient_key")
        .groupBy("age_group", "gender")
        .agg(
            F.sum("n").alias("total_encounters"),
            F.count_distinct("patient_id").alias("unique_patients"),
            F.coalesce(F.sum("amount"), F.lit(0)).cast(MONEY).alias("total_revenue"),
        )
        .orderBy("age_group", "gender")
    )


def department_load(star: Tables) -> DataFrame:
    """Encounters and inpatient bed-days per department and per unit of capacity."""
    per_department = (
        star["fact_encounters"]
        .join(_types(star), "encounter_type_key")
        .groupBy("department_key")
        .agg(
            F.count("*").alias("total_encounters"),
            F.coalesce(F.sum(F.when(_is_inpatient(), F.col("length_of_stay_days"))), F.lit(0)).alias(
                "inpatient_bed_days"
            ),
        )
    )
    return (
        per_department.join(star["dim_department"], "department_key")
        .select(
            "department_name",
            "department_type",
            "capacity",
            "total_encounters",
            "inpatient_bed_days",
            mean(F.col("inpatient_bed_days"), F.col("capacity"), 2).alias("bed_days_per_capacity"),
        )
        .orderBy(F.desc("inpatient_bed_days"), "department_name")
    )


def stay_outliers(star: Tables) -> DataFrame:
    """Per encounter type: mean stay and stays longer than expected."""
    stay = F.col("length_of_stay_days")
    return (
        star["fact_encounters"]
        .join(star["dim_encounter_type"], "encounter_type_key")
        .groupBy("encounter_type", "expected_los_days")
        .agg(
            F.count("*").alias("total_encounters"),
            mean(F.sum(stay), F.count(stay), 2).alias("avg_los_days"),
            F.count_if(stay > F.col("expected_los_days")).alias("stays_over_expected"),
        )
        .orderBy("encounter_type")
    )


def weekday_profile(star: Tables) -> DataFrame:
    """Encounters by weekend and weekday; facts are counted per day before the join."""
    per_day = star["fact_encounters"].groupBy("date_key").agg(F.count("*").alias("n"))
    days = star["dim_date"].select("date_key", "is_weekend", "day_of_week", "day_name")
    return (
        per_day.join(days, "date_key")
        .groupBy("is_weekend", "day_of_week", "day_name")
        .agg(F.sum("n").alias("total_encounters"))
        .orderBy("day_of_week")
    )


def encounter_type_usage(dim_encounter_type: DataFrame, encounters: DataFrame) -> DataFrame:
    """Each known type with its attributes and the source encounters that use it."""
    used = encounters.groupBy(text_key(F.col("encounter_type")).alias("_kind")).agg(F.count("*").alias("n"))
    return (
        dim_encounter_type.withColumn("_kind", text_key(F.col("encounter_type")))
        .join(used, "_kind", "left")
        .select(
            "encounter_type_key",
            "encounter_type",
            "encounter_type_category",
            "expected_los_days",
            F.coalesce("n", F.lit(0)).alias("encounters"),
        )
    )
