"""Checks of the source, reconciliation with the star, coverage and audits."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clinical import ENCOUNTER_TYPES, text_key
from ..functions.money import percent
from ..schemas import literal_rows

TOLERANCE = Decimal("0.01")  # Fixed value: revenue difference that still passes.


class QualityError(RuntimeError):
    """A check failed; nothing of the batch is published."""


def _check(name: str, counted: DataFrame) -> DataFrame:
    """Turn a one-row count into a check row."""
    bad = F.coalesce(F.col("bad_rows"), F.lit(0)).cast("bigint")
    return counted.select(
        F.lit(name).alias("check"),
        bad.alias("bad_rows"),
        F.when(bad > 0, "FAIL").otherwise("PASS").alias("status"),
    )


def _count_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("bad_rows"))


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Count rows whose key has no parent; counted per key before the anti join."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.join(parents.select(key), key, "left_anti").agg(F.sum("n").alias("bad_rows"))


def duplicates(rows: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = rows.filter(key.isNotNull()).groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum(F.col("n") - 1).alias("bad_rows"))


def source_checks(source: Mapping[str, DataFrame]) -> DataFrame:
    """The four checks that stop a load: one row each."""
    encounters, billing = source["encounters"], source["billing"]
    checks = [
        _check(
            "discharge_before_admission",
            _count_where(encounters, F.col("discharge_date") < F.col("encounter_date")),
        ),
        _check(
            "negative_billing_amount",
            _count_where(billing, (F.col("allowed_amount") < 0) | (F.col("claim_amount") < 0)),
        ),
        _check("encounter_with_unknown_patient", orphans(encounters, source["patients"], "patient_id")),
        _check("encounter_with_unknown_provider", orphans(encounters, source["providers"], "provider_id")),
    ]
    return reduce(DataFrame.unionByName, checks)


def key_checks(source: Mapping[str, DataFrame]) -> DataFrame:
    """Uniqueness the loads rely on but parquet does not enforce."""
    checks = [
        _check("duplicate_mrn", duplicates(source["patients"], F.col("mrn"))),
        _check("duplicate_patient_id", duplicates(source["patients"], F.col("patient_id"))),
        _check("duplicate_provider_id", duplicates(source["providers"], F.col("provider_id"))),
        _check("duplicate_encounter_id", duplicates(source["encounters"], F.col("encounter_id"))),
        _check(
            "duplicate_specialty_code", duplicates(source["specialties"], text_key(F.col("specialty_code")))
        ),
    ]
    return reduce(DataFrame.unionByName, checks)


def require(checks: DataFrame) -> None:
    """Raise when a check failed (a handful of rows reach the driver)."""
    failed = [r for r in checks.collect() if r.status != "PASS"]
    if failed:
        text = "; ".join(f"{r.check}: {r.bad_rows}" for r in failed)
        raise QualityError(f"data quality failed: {text}")


def reconciliation(encounters: DataFrame, billing: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: encounter counts and revenue on both sides, and whether they agree."""
    money = "decimal(22,2)"
    return _agreement(
        encounters.agg(F.count("*").alias("n"), F.lit(0).cast(money).alias("m")).withColumn("s", F.lit("oe")),
        billing.agg(F.lit(0).cast("bigint").alias("n"), F.sum("allowed_amount").cast(money).alias("m"))
        .withColumn("s", F.lit("ob")),
        facts.agg(F.count("*").alias("n"), F.sum("total_allowed_amount").cast(money).alias("m"))
        .withColumn("s", F.lit("f")),
    )


def reconciliation_of_digests(source_digests: DataFrame, fact_months: DataFrame) -> DataFrame:
    """The same row from the digests kept with a snapshot; no encounter, bill or fact is read."""
    money = "decimal(22,2)"
    side = F.when(F.col("source_table") == "encounters", "oe").otherwise("ob")
    return _agreement(
        source_digests.groupBy(side.alias("s")).agg(F.sum("n").alias("n"), F.sum("money").cast(money).alias("m"))
        .select("n", "m", "s"),
        fact_months.agg(F.sum("encounters").alias("n"), F.sum("revenue").cast(money).alias("m"))
        .withColumn("s", F.lit("f")),
    )


def reconciliation_by_month(encounters: DataFrame, billing: DataFrame, fact_months: DataFrame) -> DataFrame:
    """Per month: encounters and revenue on both sides, and whether they agree.

    Bills are summed per encounter before they meet the encounters' months; the fact side
    comes from its month digests. Bills of unknown encounters have the month null.
    """
    money = "decimal(22,2)"
    bills = billing.groupBy("encounter_id").agg(F.sum("allowed_amount").cast(money).alias("m"))
    rows = encounters.select("encounter_id", F.date_format("encounter_date", "yyyy-MM").alias("encounter_month"))
    zero = F.lit(0)
    found = rows.withColumn("n", F.lit(1)).join(bills, "encounter_id", "full_outer")
    left = found.groupBy("encounter_month").agg(F.sum(F.coalesce("n", zero)).alias("n"), F.sum("m").cast(money).alias("m"))
    right = fact_months.select(
        F.col("year_month").alias("_month"), "encounters", F.col("revenue").cast(money).alias("_revenue")
    )
    both = left.join(right, left["encounter_month"].eqNullSafe(right["_month"]), "full_outer").select(
        F.coalesce("encounter_month", "_month").alias("encounter_month"),
        F.coalesce("n", zero).cast("bigint").alias("oltp_encounters"),
        F.coalesce("encounters", zero).cast("bigint").alias("star_encounters"),
        F.coalesce("m", zero).cast(money).alias("oltp_revenue"),
        F.coalesce("_revenue", zero).cast(money).alias("star_revenue"),
    )
    apart = F.abs(F.col("oltp_revenue") - F.col("star_revenue")) > F.lit(TOLERANCE)
    return both.withColumn(
        "status",
        F.when(F.col("oltp_encounters") != F.col("star_encounters"), "FAIL: row count mismatch")
        .when(apart, "FAIL: revenue mismatch")
        .otherwise("PASS"),
    )


def _agreement(*sides: DataFrame) -> DataFrame:
    """One row from the counts and amounts of each side."""
    money = "decimal(22,2)"
    sides = reduce(DataFrame.unionByName, sides)

    def pick(side: str, column: str) -> Column:
        return F.max(F.when(F.col("s") == side, F.coalesce(F.col(column), F.lit(0))))

    row = sides.agg(
        pick("oe", "n").alias("oltp_encounters"),
        pick("f", "n").alias("star_encounters"),
        pick("ob", "m").cast(money).alias("oltp_total_revenue"),
        pick("f", "m").cast(money).alias("star_total_revenue"),
    ).withColumn(
        "revenue_difference",
        F.abs(F.col("oltp_total_revenue") - F.col("star_total_revenue")).cast(money),
    )
    status = (
        F.when(F.col("oltp_encounters") != F.col("star_encounters"), "FAIL: row count mismatch")
        .when(F.col("revenue_difference") > F.lit(TOLERANCE), "FAIL: revenue mismatch")
        .otherwise("PASS")
    )
    return row.select(status.alias("status"), *row.columns)


def require_reconciled(row: DataFrame, explain: Callable[[], str] = str) -> None:
    """Raise when the two sides differ; only then is explain() asked for more."""
    result = row.first()
    if result.status != "PASS":
        raise QualityError(f"reconciliation failed: {result.asDict()}; {explain()}")


def coverage(source: Mapping[str, DataFrame]) -> DataFrame:
    """Per check: rows looked at, rows without a match, their share in percent.

    Covers billing, unknown codes behind every dimension lookup, and unknown births. Each
    table is read once: its rows vote, per check and key, as looking for a match or as
    being one, and all votes are counted together in one shuffle.
    """
    kinds = [values[0].upper() for values in ENCOUNTER_TYPES]

    def looks(check: str, key: Column) -> Column:
        return _vote(check, key, 1, 0)

    def matches(check: str, key: Column) -> Column:
        return _vote(check, key, 0, 1)

    def is_good(check: str, good: Column) -> Column:
        """A row that needs no other table: looking, and its own match if it is good."""
        good = F.coalesce(good, F.lit(False))
        return _vote(check, good, 1, F.when(good, 1).otherwise(0))

    def key(name: str) -> Column:
        return F.col(name)

    votes = {
        "encounters": [
            looks("encounter_without_bill", key("encounter_id")),
            matches("bill_unknown_encounter", key("encounter_id")),
            looks("encounter_unknown_patient", key("patient_id")),
            looks("encounter_unknown_provider", key("provider_id")),
            looks("encounter_unknown_department", key("department_id")),
            is_good("encounter_unknown_type", text_key(key("encounter_type")).isin(*kinds)),
        ],
        "billing": [
            matches("encounter_without_bill", key("encounter_id")),
            looks("bill_unknown_encounter", key("encounter_id")),
        ],
        "patients": [
            matches("encounter_unknown_patient", key("patient_id")),
            is_good("patient_without_birth_date", key("date_of_birth").isNotNull()),
        ],
        "providers": [
            matches("encounter_unknown_provider", key("provider_id")),
            looks("provider_without_specialty", key("specialty_id")),
        ],
        "specialties": [
            matches("provider_without_specialty", F.when(key("specialty_code").isNotNull(), key("specialty_id"))),
        ],
        "departments": [matches("encounter_unknown_department", key("department_id"))],
        "encounter_diagnoses": [looks("diagnosis_line_unknown_code", key("diagnosis_id"))],
        "diagnoses": [matches("diagnosis_line_unknown_code", key("diagnosis_id"))],
        "encounter_procedures": [looks("procedure_line_unknown_code", key("procedure_id"))],
        "procedures": [matches("procedure_line_unknown_code", key("procedure_id"))],
    }
    cast = reduce(
        DataFrame.unionByName,
        [source[table].select(F.explode(F.array(*own)).alias("v")).select("v.*") for table, own in votes.items()],
    )
    per_key = cast.groupBy("check", "key").agg(F.sum("looking").alias("rows"), F.sum("matching").alias("matches"))
    # A null key matches nothing, not even another null.
    missed = F.col("key").isNull() | (F.col("matches") == 0)
    counted = per_key.groupBy("check").agg(
        F.sum("rows").alias("rows"), F.sum(F.when(missed, F.col("rows")).otherwise(0)).alias("misses")
    )
    every = literal_rows(counted.sparkSession, list(enumerate(_CHECKS)), _CHECK_NAME)
    rows = F.coalesce("rows", F.lit(0)).cast("bigint")
    misses = F.coalesce("misses", F.lit(0)).cast("bigint")
    return every.join(counted, "check", "left").select(
        F.col("name").alias("check"),
        rows.alias("rows"),
        misses.alias("misses"),
        F.when(rows > 0, percent(misses, rows)).alias("miss_percent"),
    )


_CHECK_NAME = T.StructType([T.StructField("check", T.IntegerType()), T.StructField("name", T.StringType())])
_CHECKS = (
    "encounter_without_bill", "encounter_unknown_patient", "encounter_unknown_provider",
    "encounter_unknown_department", "encounter_unknown_type", "provider_without_specialty",
    "patient_without_birth_date", "diagnosis_line_unknown_code", "procedure_line_unknown_code",
    "bill_unknown_encounter",
)


def _vote(check: str, key: Column, looking: int, matching: int | Column) -> Column:
    matching = F.lit(matching) if isinstance(matching, int) else matching
    return F.struct(
        F.lit(_CHECKS.index(check)).alias("check"),
        key.cast("bigint").alias("key"),
        F.lit(looking).cast("bigint").alias("looking"),
        matching.cast("bigint").alias("matching"),
    )
