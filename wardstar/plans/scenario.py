"""Loads over the order-processing tables that the registered queries read from.

Each is made once per application and folder, into the shared folder, with fixed times
so that logs and metadata are repeatable.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import FIRST_WATERMARK, BatchContext, ticking_clock
from ..functions import calendar as cal
from ..operators import dims, facts
from ..operators.scd import insert_ignore
from ..session import shared_dir, tune
from ..sources import order_view as ov
from ..sources.warehouse import Warehouse
from ..streaming.ingest import load_available
from .batch import BatchResult, Star, run_batch

FIRST_START = datetime(2002, 1, 1, 2)
SECOND_START = datetime(2002, 2, 1, 2)


@dataclass(frozen=True)
class Loaded:
    warehouse: Warehouse
    results: tuple[BatchResult, ...]

    @property
    def star(self) -> Star:
        return Star(self.warehouse, self.results[-1].snapshot if self.results else None)


_made: dict[tuple[str, str, str], Loaded] = {}


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/{tag}/{name}"


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> Loaded:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _made:
        tune(spark)
        _made[key] = make(Warehouse(spark, _folder(spark, sf_dir, name)))
    return _made[key]


def first_batch() -> BatchContext:
    return BatchContext(1, ov.FIRST_AS_OF, FIRST_START, clock=ticking_clock(FIRST_START))


def second_batch() -> BatchContext:
    return BatchContext(2, ov.SECOND_AS_OF, SECOND_START, clock=ticking_clock(SECOND_START))


def full_load(spark: SparkSession, sf_dir: str) -> Loaded:
    """All encounters in one batch."""

    def make(wh: Warehouse) -> Loaded:
        return Loaded(wh, (run_batch(wh, ov.clinical_views(spark, sf_dir), first_batch()),))

    return _once(spark, sf_dir, "full", make)


def two_loads(spark: SparkSession, sf_dir: str) -> Loaded:
    """Encounters up to the split date, then the rest with changed people.

    The second source shows everything, as a source table would; the watermark and the
    facts already loaded pick the new rows.
    """

    def make(wh: Warehouse) -> Loaded:
        first = run_batch(wh, ov.clinical_views(spark, sf_dir, load=1), first_batch())
        grown = ov.clinical_views(spark, sf_dir, people_at=2)
        return Loaded(wh, (first, run_batch(wh, grown, second_batch())))

    return _once(spark, sf_dir, "two", make)


def late_changes(spark: SparkSession, sf_dir: str) -> Loaded:
    """Two loads; the first lacks every seventh bill and every ninth discharge of its encounters."""

    def make(wh: Warehouse) -> Loaded:
        views = ov.clinical_views(spark, sf_dir, load=1)
        key = F.col("encounter_id")
        open_yet = F.when(key % 9 != 4, F.col("discharge_date"))
        early = {
            **views,
            "encounters": views["encounters"].withColumn("discharge_date", open_yet),
            "billing": views["billing"].filter(key % 7 != 3),
        }
        first = run_batch(wh, early, first_batch())
        grown = ov.clinical_views(spark, sf_dir, people_at=2)
        return Loaded(wh, (first, run_batch(wh, grown, second_batch())))

    return _once(spark, sf_dir, "late-changes", make)


def streamed(spark: SparkSession, sf_dir: str, deliveries: tuple[tuple[int, ...], ...]) -> Loaded:
    """Parts of the encounters arrive in a landing folder, one delivery after the other."""
    name = "stream-" + "-".join("".join(map(str, parts)) for parts in deliveries)

    def make(wh: Warehouse) -> Loaded:
        tables = {k: v for k, v in ov.clinical_views(spark, sf_dir).items() if k != "encounters"}
        landing = f"{wh.root}/_landing"
        for parts in deliveries:
            for part in parts:
                arriving = ov.clinical_views(spark, sf_dir, load=part)["encounters"]
                arriving.write.mode("append").parquet(landing)
            load_available(
                wh,
                tables,
                landing,
                f"{wh.root}/_checkpoint",
                as_of=ov.FIRST_AS_OF,
                started_at=lambda: FIRST_START,
                clock=ticking_clock(FIRST_START),
                refresh_dimensions=False,
            )
        return Loaded(wh, ())

    return _once(spark, sf_dir, name, make)


# -- operators over two versions of a source ----------------------------------------


def patient_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_patient after two loads, with changed and newly seen patients.

    The result holds every customer; the first load only sees some of them later.
    """
    customer = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    wh = Warehouse(spark, _folder(spark, sf_dir, "patient-history"))
    one, two = (ov.patients(customer, load, held_back=True) for load in (1, 2))
    current = wh.scratch(dims.dim_patient(one, ov.FIRST_AS_OF, FIRST_WATERMARK).current, "dim_patient", 1)
    history = current.filter("NOT is_current")
    step = dims.dim_patient(two, ov.SECOND_AS_OF, FIRST_START, current, history)
    return step.all_with(history)


def provider_history(
    spark: SparkSession,
    sf_dir: str,
    days: tuple[date, date] = (ov.FIRST_AS_OF, ov.SECOND_AS_OF),
    held_back: bool = True,
) -> DataFrame:
    """dim_provider after two loads made on the given days; it holds every supplier."""
    base = sf_dir.rstrip("/")
    supplier = spark.read.parquet(f"{base}/supplier.parquet")
    spec = ov.specialties(spark.read.parquet(f"{base}/nation.parquet"))
    dept = ov.departments(spark.read.parquet(f"{base}/region.parquet"))
    wh = Warehouse(spark, _folder(spark, sf_dir, f"provider-history-{days[0]}-{held_back}"))
    one, two = (ov.providers(supplier, load, held_back) for load in (1, 2))
    first = dims.dim_provider(one, spec, dept, days[0], FIRST_WATERMARK)
    current = wh.scratch(first.current, "dim_provider", 1)
    history = current.filter("NOT is_current")
    step = dims.dim_provider(two, spec, dept, days[1], FIRST_START, current, history)
    return step.all_with(history)


def diagnosis_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the parts: the second adds keys, changes texts and has lost some rows.

    Every part is in one version at least: what the first lacks, the second has.
    """
    rows = ov.diagnoses(spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet"))
    key = F.col("diagnosis_id")
    changed = F.when(key % 7 == 0, F.concat("icd10_description", F.lit("-R")))
    second = rows.filter((key % 13 != 12) | (key % 11 == 10)).withColumn(
        "icd10_description", F.coalesce(changed, F.col("icd10_description"))
    )
    return rows.filter(key % 11 != 10), second


def upserted_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_diagnosis after both source versions."""
    one, two = diagnosis_versions(spark, sf_dir)
    wh = Warehouse(spark, _folder(spark, sf_dir, "diagnosis-versions"))
    first = wh.scratch(dims.dim_diagnosis(one), "dim_diagnosis", 1)
    return dims.dim_diagnosis(two, first)


def as_of_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters with the provider version valid on the day they began."""
    views = ov.clinical_views(spark, sf_dir)
    stored = full_load(spark, sf_dir).star
    wh = Warehouse(spark, _folder(spark, sf_dir, "as-of"))
    days = (date(1995, 1, 1), date(2000, 7, 1))
    versions = provider_history(spark, sf_dir, days, held_back=False)
    patients = dims.dim_patient(views["patients"], days[0], FIRST_WATERMARK).current
    keyed = facts.lookup_keys(
        views["encounters"],
        stored["dim_date"],
        wh.scratch(patients, "dim_patient", 1),
        wh.scratch(versions, "dim_provider", 1),
        stored["dim_specialty"],
        stored["dim_department"],
        stored["dim_encounter_type"],
        mode="as_of",
    )
    return keyed.filter(F.col("reject_reason").isNull()).select(
        "encounter_id", "provider_id", "provider_key", "specialty_key"
    )


def rejects_outside_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All encounters against the dimensions as the first load left them: rejects per month."""
    loaded = two_loads(spark, sf_dir)
    stored = Star(loaded.warehouse, loaded.results[0].snapshot)
    keyed = facts.lookup_keys(
        ov.clinical_views(spark, sf_dir)["encounters"],
        stored["dim_date"],
        stored["dim_patient"],
        stored["dim_provider"],
        stored["dim_specialty"],
        stored["dim_department"],
        stored["dim_encounter_type"],
    ).withColumnRenamed("encounter_date", "encounter_datetime")
    return (
        facts.rejected(keyed)
        .groupBy(facts.month_of("encounter_datetime").alias("encounter_month"), "reject_reason")
        .agg(F.count("*").alias("encounters"))
    )


def provider_first(views: Mapping[str, DataFrame]) -> DataFrame:
    return dims.dim_provider(
        views["providers"], views["specialties"], views["departments"], ov.FIRST_AS_OF, FIRST_WATERMARK
    ).current


def late_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters per month missing from a fact with the later part and a third of the earlier one."""
    views = ov.clinical_views(spark, sf_dir)
    early = ov.clinical_views(spark, sf_dir, load=1)["encounters"].filter("encounter_id % 3 = 0")
    loaded = ov.clinical_views(spark, sf_dir, load=2)["encounters"].unionByName(early)
    loaded = loaded.withColumnRenamed("encounter_date", "encounter_datetime")
    watermark = facts.new_watermark(loaded).first()[0]
    late = facts.late_arrivals(views["encounters"], loaded, cal.moment(watermark))
    return late.groupBy(facts.month_of("encounter_date").alias("encounter_month")).agg(
        F.count("*").alias("late_encounters"), F.min("encounter_date").alias("oldest")
    )


def merged_diagnosis_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis lines of returned orders, added to those of accepted ones by insert-ignore."""
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")

    def lines(flag: str) -> DataFrame:
        rows = ov.encounter_diagnoses(lineitem.filter(F.col("l_returnflag") == flag))
        return rows.select("encounter_id", "diagnosis_id", "diagnosis_sequence")

    keys, order = ["encounter_id", "diagnosis_id"], ["diagnosis_sequence"]
    none = lines("A").limit(0)
    return insert_ignore(insert_ignore(none, lines("A"), keys, order), lines("R"), keys, order)

