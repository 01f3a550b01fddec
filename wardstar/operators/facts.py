"""Encounter facts: delta, surrogate-key lookups and pre-aggregated measures."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import FIRST_WATERMARK
from ..functions import calendar as cal
from ..functions.clinical import text_key
from .keys import assign_keys
from .scd import first_per_key

INPATIENT = "INPATIENT"

# Lookup that failed first, in the order the lookups are made.
REJECT_REASONS = (
    ("date_key", "date outside calendar"),
    ("patient_key", "unknown patient"),
    ("provider_key", "unknown provider"),
    ("specialty_key", "provider without specialty"),
    ("department_key", "unknown department"),
    ("encounter_type_key", "unknown encounter type"),
)
DUPLICATE = "duplicate encounter"


def one_per_encounter(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Encounters with one row per id, and a reject row for each further copy.

    Of copies the least by admission, then by the other columns, stays. Both sides count
    and compare per id before the shuffle, so many copies of one id cost one row a task.
    """
    kept = first_per_key(rows, ["encounter_id"], ["encounter_date"])
    per_id = rows.groupBy("encounter_id").agg(F.count("*").alias("n"), F.min("encounter_date").alias("encounter_datetime"))
    copies = per_id.filter("n > 1").select(
        "encounter_id",
        "encounter_datetime",
        F.lit(DUPLICATE).alias("reject_reason"),
        F.explode(F.sequence(F.lit(2), F.col("n"))).alias("_copy"),
    )
    return kept, copies.drop("_copy")


def delta(
    encounters: DataFrame, loaded: DataFrame | None, watermark: datetime, strict: bool = True
) -> DataFrame:
    """Encounters to load: not loaded yet and, when strict, after the watermark.

    The watermark is a literal, so the filter reaches the scan, and when strict only
    facts after it can clash: their months are pruned to the watermark's and later.
    Otherwise the stored ids first meet the arriving ones, which are few in a stream.
    """
    rows = encounters
    if strict and watermark != FIRST_WATERMARK:
        rows = rows.filter(F.col("encounter_date") > cal.moment(watermark))
        if loaded is not None:
            loaded = after(loaded, watermark)
    if loaded is None:
        return rows
    clashing = scoped(loaded.select("encounter_id"), rows, "encounter_id")
    return rows.join(clashing, "encounter_id", "left_anti")


#: Ranges that a batch's ids are described by at most.
ID_RANGES = 64


def id_ranges(rows: DataFrame, most: int = ID_RANGES) -> list[tuple[int, int]]:
    """Ranges, apart from each other, that hold all encounter ids of the rows.

    The span of the ids is cut into `most` equal steps; steps without an id are left out and
    neighbouring ones put together. Two aggregates over the ids; at most `most` numbers
    reach the driver.
    """
    ends = rows.agg(F.min("encounter_id").alias("low"), F.max("encounter_id").alias("high")).first()
    if ends.low is None:
        return []
    width = -(-(ends.high - ends.low + 1) // most)
    step = F.floor((F.col("encounter_id") - ends.low) / width).cast("int")
    steps = sorted(r.s for r in rows.filter("encounter_id IS NOT NULL").select(step.alias("s")).distinct().collect())
    ranges: list[tuple[int, int]] = []
    for s in steps:
        low, high = ends.low + s * width, min(ends.low + (s + 1) * width - 1, ends.high)
        if ranges and ranges[-1][1] == low - 1:
            low = ranges.pop()[0]
        ranges.append((low, high))
    return ranges


def known_ids(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored ids within the ranges of the rows' ids: the ranges reach the scan.

    The list of ids is narrow and in order, so row groups outside the ranges aren't read.
    """
    within = [F.col("encounter_id").between(low, high) for low, high in id_ranges(rows)]
    return ids.filter(reduce(Column.__or__, within, F.lit(False)))


def after(loaded: DataFrame, when: datetime) -> DataFrame:
    """Stored facts admitted later than when; whole months before it are not read."""
    return loaded.filter(
        (F.col("year_month") >= when.strftime("%Y-%m")) & (F.col("encounter_datetime") > cal.moment(when))
    )


def until(loaded: DataFrame, when: datetime) -> DataFrame:
    """Stored facts admitted at when or before; whole months after it are not read."""
    return loaded.filter(
        (F.col("year_month") <= when.strftime("%Y-%m")) & (F.col("encounter_datetime") <= cal.moment(when))
    )


def scoped(rows: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the batch.

    A small batch is broadcast, so a large table is filtered where it is read instead of
    being shuffled to the batch.
    """
    return rows.join(batch.select(key).distinct(), key, "left_semi")


def provider_lookup(dim_provider: DataFrame, dim_specialty: DataFrame) -> DataFrame:
    """Provider key and, by specialty code, specialty key; joined once per provider.

    A code held by two specialties yields two rows, as the plain joins would.
    """
    codes = dim_specialty.select(text_key(F.col("specialty_code")).alias("_code"), "specialty_key")
    return (
        dim_provider.withColumn("_code", text_key(F.col("specialty_code")))
        .join(codes, "_code", "left")
        .drop("_code")
    )


def lookup_keys(
    encounters: DataFrame,
    dim_date: DataFrame,
    dim_patient: DataFrame,
    dim_provider: DataFrame,
    dim_specialty: DataFrame,
    dim_department: DataFrame,
    dim_encounter_type: DataFrame,
    mode: str = "current",
    meet: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Encounters with all six surrogate keys and the reason of a failed lookup.

    mode "current" takes the current patient and provider version; "as_of" the version
    valid on the encounter's date. Spark broadcasts what is small by its stored or
    measured size; the rest is joined by shuffle with skew splitting. meet joins more by
    encounter; it is done before the small lookups, whose keys are not shuffled then.
    """
    days = dim_date.select(F.col("calendar_date").alias("_day"), "date_key", "year_month")
    kinds = dim_encounter_type.select(
        text_key(F.col("encounter_type")).alias("_kind"), "encounter_type_key"
    )
    lookup = provider_lookup(dim_provider, dim_specialty)
    rows = encounters.withColumn("_day", F.to_date("encounter_date")).withColumn(
        "_kind", text_key(F.col("encounter_type"))
    )
    version = ["effective_date", "expiration_date"]
    if mode == "as_of":
        patients = dim_patient.select("patient_id", "patient_key", *version)
        rows = _as_of(rows, patients, "patient_id")
        rows = meet(rows) if meet else rows
        rows = _as_of(
            rows, lookup.select("provider_id", "provider_key", "specialty_key", *version), "provider_id"
        )
    else:
        patients = dim_patient.filter("is_current").select("patient_id", "patient_key")
        rows = rows.join(patients, "patient_id", "left")
        rows = (meet(rows) if meet else rows).join(
            lookup.filter("is_current").select("provider_id", "provider_key", "specialty_key"),
            "provider_id",
            "left",
        )
    rows = (
        rows.join(days, "_day", "left")
        .join(dim_department.select("department_id", "department_key"), "department_id", "left")
        .join(kinds, "_kind", "left")
    )
    reason = None
    for column, text in REJECT_REASONS:
        missing = F.col(column).isNull()
        reason = F.when(missing, text) if reason is None else reason.when(missing, text)
    return (
        rows.withColumn("reject_reason", reason)
        .withColumn("is_inpatient", F.col("_kind") == INPATIENT)
        .drop("_day", "_kind")
    )


def _as_of(rows: DataFrame, versions: DataFrame, natural: str) -> DataFrame:
    """Rows with the version whose half-open interval contains their day, null if none does.

    A key's versions are laid beside its days, not joined with its rows: the different
    (key, day) pairs and the versions are united, and in order of the day each pair takes
    the last version that began by then. So a long history costs its own rows once, and
    the wide rows meet exactly one answer per pair. Days of a key are bounded by the
    calendar. Versions that began on one day are all kept, as a join would keep them.
    """
    attrs = [c for c in versions.columns if c not in (natural, "effective_date", "expiration_date")]
    # Versions of a key that began on one day and haven't ended before the next one begins.
    began = versions.filter(F.col("effective_date") < F.col("expiration_date")).groupBy(
        F.col(natural).alias("_nk"), F.col("effective_date").alias("_at")
    )
    began = began.agg(F.collect_list(F.struct("expiration_date", *attrs)).alias("_versions"))
    days = rows.select(F.col(natural).alias("_nk"), F.col("_day").alias("_at")).distinct()
    events = days.withColumn("_asks", F.lit(True)).unionByName(began, allowMissingColumns=True)
    # A version that begins on the asked day comes first.
    upto = Window.partitionBy("_nk").orderBy("_at", F.col("_asks").isNotNull())
    last = F.last("_versions", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    answers = (
        events.withColumn("_last", last)
        .filter(F.col("_asks") & F.col("_last").isNotNull())
        .select("_nk", "_at", F.explode("_last").alias("_v"))
        .filter(F.col("_at") < F.col("_v.expiration_date"))
        .select("_nk", "_at", *[F.col(f"_v.{c}").alias(c) for c in attrs])
    )
    return rows.join(answers, (rows[natural] == answers["_nk"]) & (rows["_day"] == answers["_at"]), "left").drop(
        "_nk", "_at"
    )


def count_per_encounter(lines: DataFrame, name: str) -> DataFrame:
    return lines.groupBy("encounter_id").agg(F.count("*").alias(name))


def billing_per_encounter(billing: DataFrame) -> DataFrame:
    """Bills summed per encounter, so that several bills keep one fact row."""
    return billing.groupBy("encounter_id").agg(
        F.sum("claim_amount").alias("total_claim_amount"),
        F.sum("allowed_amount").alias("total_allowed_amount"),
        F.lit(True).alias("has_billing"),
        F.max((F.col("allowed_amount") < 0) | (F.col("claim_amount") < 0)).alias("_negative"),
    )


def length_of_stay(admitted: Column, discharged: Column) -> Column:
    """Calendar days, ignoring the time of day; null while not discharged."""
    return F.datediff(discharged, admitted)


def join_measures(
    rows: DataFrame, encounter_diagnoses: DataFrame, encounter_procedures: DataFrame, billing: DataFrame
) -> DataFrame:
    """Counts and amounts, each aggregated before it meets the encounters."""
    return (
        rows.join(count_per_encounter(encounter_diagnoses, "diagnosis_count"), "encounter_id", "left")
        .join(count_per_encounter(encounter_procedures, "procedure_count"), "encounter_id", "left")
        .join(billing_per_encounter(billing), "encounter_id", "left")
        .withColumn("diagnosis_count", F.coalesce("diagnosis_count", F.lit(0)))
        .withColumn("procedure_count", F.coalesce("procedure_count", F.lit(0)))
        .withColumn("has_billing", F.coalesce("has_billing", F.lit(False)))
    )


def finish_staged(rows: DataFrame) -> DataFrame:
    """Encounters with keys and measures as facts name them, without what facts don't hold.

    Rows that the source checks would stop a strict batch for get a reason to be rejected.
    """
    reason = (
        F.when(F.col("discharge_date") < F.col("encounter_date"), "discharge before admission")
        .when(F.col("_negative"), "negative bill")
    )
    return (
        rows.withColumn("reject_reason", F.coalesce("reject_reason", reason))
        .drop("_negative", "encounter_type", "department_id")
        .withColumn(
            "length_of_stay_days", length_of_stay(F.col("encounter_date"), F.col("discharge_date"))
        )
        .withColumnRenamed("encounter_date", "encounter_datetime")
        .withColumnRenamed("discharge_date", "discharge_datetime")
    )


#: What is looked for in every fact of a batch, and when a fact has it.
COVERAGE = {
    "fact_without_bill": "has_billing",
    "fact_without_diagnosis": "diagnosis_count > 0",
    "fact_without_procedure": "procedure_count > 0",
    "fact_without_discharge": "discharge_datetime IS NOT NULL",
}
LATE = "fact_before_watermark"


def staged_metrics(watermark: datetime) -> list[Column]:
    """Aggregates over staged encounters, to be observed while they are written.

    Counts and, as texts, ends of the accepted ones; per check the accepted ones that miss
    something, and those that came in late.
    """
    ok = F.col("reject_reason").isNull()

    def end(name: str, value: Column) -> Column:
        return value.cast("string").alias(name)

    admitted, left = F.when(ok, F.col("encounter_datetime")), F.when(ok, F.col("discharge_datetime"))
    misses = {check: ~F.coalesce(F.expr(has), F.lit(False)) for check, has in COVERAGE.items()}
    misses[LATE] = F.col("encounter_datetime") <= cal.moment(watermark)
    return [
        F.count_if(ok).alias("n"),
        F.count_if(~ok).alias("rejected"),
        end("first_in", F.min(admitted)),
        end("last_in", F.max(admitted)),
        end("last_out", F.max(left)),
        *[F.count_if(ok & missed).alias(check) for check, missed in misses.items()],
    ]


def accepted(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("reject_reason").isNull())


def rejected(staged: DataFrame) -> DataFrame:
    """Rows an inner lookup would have dropped, each with the reason."""
    return staged.filter(F.col("reject_reason").isNotNull()).select(
        "encounter_id", "encounter_datetime", "reject_reason"
    )


def key_facts(rows: DataFrame, start: int, loaded_at: datetime) -> DataFrame:
    """Accepted rows with encounter_key and load times.

    Only the ids are ranked; the keys then meet the rows by encounter_id, the key by
    which the readmission flags join them too, so the wide rows are shuffled once.
    """
    keys = assign_keys(rows.select("encounter_id"), "encounter_key", F.col("encounter_id"), start)
    return (
        rows.join(keys, "encounter_id")
        .withColumn("created_date", cal.moment(loaded_at))
        .withColumn("updated_date", cal.moment(loaded_at))
    )


def new_watermark(facts: DataFrame) -> DataFrame:
    """One row: latest admission of the batch, null when nothing was loaded."""
    return facts.agg(F.max("encounter_datetime").alias("high_watermark"))


def late_arrivals(encounters: DataFrame, loaded: DataFrame, watermark) -> DataFrame:
    """Source rows at or before the watermark that the fact does not hold."""
    return encounters.filter(F.col("encounter_date") <= watermark).join(
        loaded.select("encounter_id"), "encounter_id", "left_anti"
    )


def month_of(column: str) -> Column:
    return cal.year_month(F.col(column))
