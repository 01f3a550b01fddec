"""The eight dimensions: attributes from the source, then the matching update rule."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import clinical as rules
from ..schemas import TARGET, literal_rows
from .keys import assign_keys, max_key
from .scd import Scd2Next, Stage, scd2_next, upsert_scd1


# -- calendar -----------------------------------------------------------------------


def calendar_range(encounters: DataFrame) -> DataFrame:
    """One row: first day of the first and last day of the last year with encounters."""
    seen = encounters.agg(
        F.min("encounter_date").cast("date").alias("lo"), F.max("encounter_date").cast("date").alias("hi")
    )
    last_day = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return seen.select(F.trunc("lo", "YEAR").alias("start"), last_day.alias("end"))


def calendar_days(bounds: DataFrame) -> DataFrame:
    """One row per day, both ends included."""
    return bounds.select(F.explode(F.sequence("start", "end")).alias("calendar_date"))


def date_attrs(days: DataFrame) -> DataFrame:
    d = F.col("calendar_date")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        cal.year_month(d).alias("year_month"),
        cal.week_of_year(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        cal.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def dim_date(bounds: DataFrame, cur: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    """Calendar over the bounds; days already present keep their row and key."""
    days = date_attrs(calendar_days(bounds))
    order = cal.epoch_day(F.col("calendar_date"))
    if cur is None:
        return assign_keys(days, "date_key", order).select("date_key", *days.columns)
    fresh = days.join(cur.select("calendar_date"), "calendar_date", "left_anti")
    if stage is not None:
        fresh = stage(fresh)
        if fresh.isEmpty():
            return cur
    keyed = assign_keys(fresh, "date_key", order, max_key(cur, "date_key"))
    return cur.unionByName(keyed.select(cur.columns))


# -- overwritten in place -----------------------------------------------------------


def specialty_attrs(src: DataFrame) -> DataFrame:
    return src.select(
        "specialty_id",
        "specialty_name",
        "specialty_code",
        rules.specialty_category(F.col("specialty_code")).alias("specialty_category"),
    )


def dim_specialty(src: DataFrame, cur: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    return upsert_scd1(cur, specialty_attrs(src), "specialty_id", "specialty_key", stage=stage)


def department_attrs(src: DataFrame) -> DataFrame:
    return src.select(
        "department_id",
        "department_name",
        "floor",
        "capacity",
        rules.department_type(F.col("department_name")).alias("department_type"),
    )


def dim_department(src: DataFrame, cur: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    return upsert_scd1(cur, department_attrs(src), "department_id", "department_key", stage=stage)


def dim_encounter_type(
    spark: SparkSession, cur: DataFrame | None = None, stage: Stage | None = None
) -> DataFrame:
    """The three fixed types; keys follow the order in which they are listed."""
    schema = T.StructType(TARGET["dim_encounter_type"].fields[1:])
    attrs = literal_rows(spark, list(rules.ENCOUNTER_TYPES), schema)
    position = F.when(F.lit(False), 0)
    for i, values in enumerate(rules.ENCOUNTER_TYPES):
        position = position.when(F.col("encounter_type") == values[0], i)
    return upsert_scd1(cur, attrs, "encounter_type", "encounter_type_key", position, stage)


def diagnosis_attrs(src: DataFrame) -> DataFrame:
    return src.select(
        "diagnosis_id",
        "icd10_code",
        "icd10_description",
        rules.diagnosis_category(F.col("icd10_code")).alias("icd10_category"),
    )


def dim_diagnosis(src: DataFrame, cur: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    return upsert_scd1(cur, diagnosis_attrs(src), "diagnosis_id", "diagnosis_key", stage=stage)


def procedure_attrs(src: DataFrame) -> DataFrame:
    return src.select(
        "procedure_id",
        "cpt_code",
        "cpt_description",
        rules.procedure_category(F.col("cpt_code")).alias("procedure_category"),
    )


def dim_procedure(src: DataFrame, cur: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    return upsert_scd1(cur, procedure_attrs(src), "procedure_id", "procedure_key", stage=stage)


# -- with history -------------------------------------------------------------------


def patient_attrs(src: DataFrame, as_of: date) -> DataFrame:
    """Patient attributes with age as of the batch, fixed for the life of the version."""
    age = rules.age_years(F.col("date_of_birth"), as_of)
    return src.select(
        "patient_id",
        "mrn",
        "first_name",
        "last_name",
        rules.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "date_of_birth",
        age.alias("age"),
        rules.age_group(age).alias("age_group"),
        "gender",
    )


def dim_patient(
    src: DataFrame,
    as_of: date,
    since: datetime,
    current: DataFrame | None = None,
    history: DataFrame | None = None,
    stage: Stage | None = None,
) -> Scd2Next:
    attrs = patient_attrs(src, as_of)
    return scd2_next(current, history, attrs, src, "patient_id", "patient_key", as_of, since, stage)


def provider_attrs(src: DataFrame, specialties: DataFrame, departments: DataFrame) -> DataFrame:
    """Provider with the names of specialty and department instead of their ids."""
    spec = specialty_attrs(specialties)
    dept = department_attrs(departments).select(
        "department_id", "department_name", F.col("floor").alias("department_floor"), "department_type"
    )
    # A missing specialty or department still gets the rule's fallback category.
    return (
        src.join(spec, "specialty_id", "left")
        .join(dept, "department_id", "left")
        .select(
            "provider_id",
            "first_name",
            "last_name",
            rules.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            "credential",
            "specialty_name",
            "specialty_code",
            F.coalesce("specialty_category", F.lit("Medical")).alias("specialty_category"),
            "department_name",
            "department_floor",
            F.coalesce("department_type", F.lit("Other")).alias("department_type"),
        )
    )


def dim_provider(
    src: DataFrame,
    specialties: DataFrame,
    departments: DataFrame,
    as_of: date,
    since: datetime,
    current: DataFrame | None = None,
    history: DataFrame | None = None,
    stage: Stage | None = None,
) -> Scd2Next:
    attrs = provider_attrs(src, specialties, departments)
    return scd2_next(current, history, attrs, src, "provider_id", "provider_key", as_of, since, stage)

