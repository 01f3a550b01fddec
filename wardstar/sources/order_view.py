"""The ten clinical tables as views over order-processing tables.

Customers stand in for patients, suppliers for providers, orders for encounters and
bills, order lines for diagnoses and procedures of an encounter. Every column is a
fixed expression, so nothing here shuffles and filters reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..schemas import SOURCE, conform

# Specialty codes by nation key 0-19.
SPECIALTY_CODES = (
    "CARD", "IM", "ER", "ORTH", "PED", "NEUR", "RAD", "ONC", "DERM", "PSY",
    "ANES", "PATH", "OPHT", "URO", "GI", "NEPH", "PULM", "ENDO", "RHEUM", "SURG",
)

# Departments by region key 0-4 with their capacity.
DEPARTMENTS = (
    ("Emergency Department", 50),
    ("Intensive Care Unit (ICU)", 15),
    ("Outpatient Clinic", 30),
    ("Surgical Suite", 30),
    ("Administration", 30),
)

# Procedure codes of the brands whose number is a multiple of five.
ROUND_BRAND_CODES = ((5, "99213"), (10, "93000"), (15, "71020"), (20, "36415"), (25, "80053"))

# The two loads of the incremental scenario: encounters up to the first date belong to
# load 1, the rest to load 2; rows touched between the loads carry the later time.
SPLIT_AT = datetime(2000, 6, 30)
FIRST_UPDATE = datetime(2001, 12, 1)
SECOND_UPDATE = datetime(2002, 1, 15, 12)
FIRST_AS_OF = date(2002, 1, 1)
SECOND_AS_OF = date(2002, 2, 1)


def _choice(key: Column, values) -> Column:
    """Value at a fixed position, null beyond the list."""
    result = None
    for i, value in enumerate(values):
        hit = key == i
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return result


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def patients(customer: DataFrame, load: int, held_back: bool = False) -> DataFrame:
    """Patients as the source shows them at load 1 or 2.

    held_back: patients whose key is 10 mod 11 appear only at load 2.
    """
    key = F.col("c_custkey")
    changed = (key % 7 == 0) if load == 2 else F.lit(False)
    seen = customer if load == 2 or not held_back else customer.filter(key % 11 != 10)
    last = F.substring_index("c_name", "#", -1)
    return seen.select(
        key.alias("patient_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.when(changed, F.concat(last, F.lit("-R"))).otherwise(last).alias("last_name"),
        F.date_add(F.lit(date(1920, 1, 1)), ((key * 37) % 28500).cast("int")).alias("date_of_birth"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("MRN-"), F.lpad(key.cast("string"), 7, "0")).alias("mrn"),
        F.when(changed, cal.moment(SECOND_UPDATE)).otherwise(cal.moment(FIRST_UPDATE)).alias("last_update"),
    )


def providers(supplier: DataFrame, load: int, held_back: bool = False) -> DataFrame:
    """Providers at load 1 or 2: every fifth moves to the next specialty at load 2.

    held_back: providers whose key is 12 mod 13 appear only at load 2.
    """
    key = F.col("s_suppkey")
    changed = (key % 5 == 0) if load == 2 else F.lit(False)
    seen = supplier if load == 2 or not held_back else supplier.filter(key % 13 != 12)
    return seen.select(
        key.alias("provider_id"),
        F.substring_index("s_name", "#", 1).alias("first_name"),
        F.substring_index("s_name", "#", -1).alias("last_name"),
        F.when(key % 4 == 0, "FWACS").otherwise("MBChB").alias("credential"),
        F.when(changed, (F.col("s_nationkey") + 1) % 25)
        .otherwise(F.col("s_nationkey"))
        .alias("specialty_id"),
        (key % 5).alias("department_id"),
        F.when(changed, cal.moment(SECOND_UPDATE)).otherwise(cal.moment(FIRST_UPDATE)).alias("last_update"),
    )


def specialties(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    code = F.coalesce(_choice(key, SPECIALTY_CODES), F.concat(F.lit("X"), key.cast("string")))
    return nation.select(
        key.alias("specialty_id"), F.col("n_name").alias("specialty_name"), code.alias("specialty_code")
    )


def departments(region: DataFrame) -> DataFrame:
    key = F.col("r_regionkey")
    return region.select(
        key.alias("department_id"),
        _choice(key, [name for name, _ in DEPARTMENTS]).alias("department_name"),
        (key + 1).alias("floor"),
        _choice(key, [capacity for _, capacity in DEPARTMENTS]).alias("capacity"),
    )


def diagnoses(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("string")
    return part.select(
        F.col("p_partkey").alias("diagnosis_id"),
        F.concat(F.upper(F.substring("p_type", 1, 1)), F.lpad(size, 2, "0")).alias("icd10_code"),
        F.concat("p_type", F.lit(" "), size).alias("icd10_description"),
    )


def procedures(part: DataFrame) -> DataFrame:
    brand = F.substring_index("p_brand", "#", -1).cast("int")
    code = (90000 + 400 * brand - 37 * brand * brand).cast("string")
    for number, fixed in ROUND_BRAND_CODES:
        code = F.when(brand == number, fixed).otherwise(code)
    return part.select(
        F.col("p_partkey").alias("procedure_id"),
        code.alias("cpt_code"),
        F.col("p_brand").alias("cpt_description"),
    )


def _encounter_date() -> Column:
    key = F.col("o_orderkey")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))


def _in_load(orders: DataFrame, load: int | None) -> DataFrame:
    if load is None:
        return orders
    early = _encounter_date() <= cal.moment(SPLIT_AT)
    return orders.filter(early if load == 1 else ~early)


def encounters(orders: DataFrame, provider_count: int, load: int | None = None) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    kind = F.when(status == "F", "Inpatient").when(status == "O", "Outpatient").when(status == "P", "ER")
    zero = F.lit(0)
    stay = (
        F.when(status == "F", F.make_dt_interval((key % 10 + 1).cast("int"), zero))
        .when(status == "O", F.make_dt_interval(zero, (key % 4 + 1).cast("int")))
        .otherwise(F.make_dt_interval(zero, (key % 12 + 1).cast("int")))
    )
    return _in_load(orders, load).select(
        key.alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"),
        (key % provider_count).alias("provider_id"),
        kind.alias("encounter_type"),
        _encounter_date().alias("encounter_date"),
        (_encounter_date() + stay).alias("discharge_date"),
        (key % 5).alias("department_id"),
    )


def encounter_diagnoses(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") != "N").select(
        F.col("l_linenumber").alias("encounter_diagnosis_id"),
        F.col("l_orderkey").alias("encounter_id"),
        F.col("l_partkey").alias("diagnosis_id"),
        F.col("l_linenumber").alias("diagnosis_sequence"),
    )


def encounter_procedures(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") != "R").select(
        F.col("l_linenumber").alias("encounter_procedure_id"),
        F.col("l_orderkey").alias("encounter_id"),
        F.col("l_partkey").alias("procedure_id"),
        F.to_date("l_shipdate").alias("procedure_date"),
    )


def billing(orders: DataFrame, load: int | None = None) -> DataFrame:
    claim = F.col("o_totalprice").cast("decimal(12,2)")
    urgency = F.substring("o_orderpriority", 1, 1)
    status = (
        F.when(urgency == "1", "Pending")
        .when(urgency == "2", "Denied")
        .when(urgency == "3", "Under Review")
        .otherwise("Paid")
    )
    billed = _in_load(orders, load).filter(F.col("o_orderkey") % 10 != 0)
    return billed.select(
        F.col("o_orderkey").alias("billing_id"),
        F.col("o_orderkey").alias("encounter_id"),
        claim.alias("claim_amount"),
        F.round(claim * F.lit(Decimal("0.8")), 2).alias("allowed_amount"),
        F.to_date("o_orderdate").alias("claim_date"),
        status.alias("claim_status"),
    )


class ClinicalViews(Mapping):
    """The ten tables by name; a table's files are opened when it is first asked for.

    load picks the encounters of one load, None takes all of them. people_at is the load
    whose patients and providers are seen (by default the same, or the first when all
    encounters are taken).
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        load: int | None = None,
        people_at: int | None = None,
        held_back: bool = False,
    ):
        people = people_at or load or 1

        def table(name: str) -> DataFrame:
            return _table(spark, sf_dir, name)

        def provider_count() -> int:
            return table("supplier").count()  # answered from parquet footers

        self._made: dict[str, DataFrame] = {}
        self._makers: dict[str, Callable[[], DataFrame]] = {
            "patients": lambda: patients(table("customer"), people, held_back),
            "specialties": lambda: specialties(table("nation")),
            "departments": lambda: departments(table("region")),
            "providers": lambda: providers(table("supplier"), people, held_back),
            "encounters": lambda: encounters(table("orders"), provider_count(), load),
            "diagnoses": lambda: diagnoses(table("part")),
            "procedures": lambda: procedures(table("part")),
            "encounter_diagnoses": lambda: encounter_diagnoses(table("lineitem")),
            "encounter_procedures": lambda: encounter_procedures(table("lineitem")),
            "billing": lambda: billing(table("orders"), load),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = conform(self._makers[name](), SOURCE[name])
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def clinical_views(spark: SparkSession, sf_dir: str, **choice) -> ClinicalViews:
    return ClinicalViews(spark, sf_dir, **choice)
