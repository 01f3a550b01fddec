"""Seed rows of the 13,200-encounter data set from their published formulas, by spark.range.

Names and code texts are shortened; what groups with what is the same. Random amounts
and dates become fixed functions of the row number.
"""

from pyspark.sql import functions as F

from wardstar.schemas import SOURCE, conform

def _type(n):
    return F.when(n % 3 == 1, "Outpatient").when(n % 3 == 2, "Inpatient").otherwise("ER")


def _status(n):
    return F.when(n % 10 == 1, "Pending").when(n % 10 == 2, "Denied").when(n % 10 == 3, "Under Review").otherwise("Paid")


def _admitted(first_day):
    n = F.col("id")
    start = F.lit(first_day).cast("timestamp_ntz")
    return start + F.make_dt_interval((n % 365).cast("int"), (n % 24).cast("int"))


def _encounters(rows, first_day, offset):
    n = F.col("id")
    stay_hours = (
        F.when(n % 3 == 1, n % 4 + 1).when(n % 3 == 2, (n % 10 + 1) * 24).otherwise(n % 12 + 1).cast("int")
    )
    admitted = _admitted(first_day)
    return rows.select(
        (n + offset).alias("encounter_id"),
        (n + offset).alias("patient_id"),
        ((n - 1) % 1000 + 1).alias("provider_id"),
        _type(n).alias("encounter_type"),
        admitted.alias("encounter_date"),
        (admitted + F.make_dt_interval(F.lit(0), stay_hours)).alias("discharge_date"),
        ((n - 1) % 15 + 1).alias("department_id"),
    )


def _readmissions(base):
    """200 inpatient stays, 1 to 30 days after the discharge, with another provider."""
    first = base.filter("encounter_type = 'Inpatient' AND encounter_id <= 599")
    e = F.col("encounter_id")
    zero = F.lit(0)
    admitted = F.col("discharge_date") + F.make_dt_interval((e % 30 + 1).cast("int"), zero)
    return first.select(
        (e + 10000).alias("encounter_id"),
        "patient_id",
        (F.col("provider_id") % 1000 + 1).alias("provider_id"),
        "encounter_type",
        admitted.alias("encounter_date"),
        (admitted + F.make_dt_interval((e % 10 + 1).cast("int"), zero)).alias("discharge_date"),
        "department_id",
    )


def seed(spark, with_increment: bool):
    n = F.col("id")
    base, more = spark.range(1, 10001), spark.range(1, 3001)
    old = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def both(make):
        """Rows 1 to 10,000 and, with the increment, 3,000 more from 15,001."""
        first = make(base, 0)
        return first.unionByName(make(more, 15000)) if with_increment else first

    def copies(df, key):
        """Rows of the 200 readmissions: those of their index encounter, ids moved."""
        again = df.filter("encounter_id <= 599 AND encounter_id % 3 = 2")
        return df.unionByName(
            again.withColumn(key, F.col(key) + 10000).withColumn("encounter_id", F.col("encounter_id") + 10000)
        )

    stays = _encounters(base, "2024-01-01", 0)
    encounters = stays.unionByName(_readmissions(stays))
    if with_increment:
        encounters = encounters.unionByName(_encounters(more, "2025-01-01", 15000))
    tables = {
        "specialties": spark.range(1, 21).selectExpr(
            "id AS specialty_id", "'Specialty ' || id AS specialty_name", "'S' || id AS specialty_code"
        ),
        "departments": spark.range(1, 16).selectExpr(
            "id AS department_id", "'Department ' || id AS department_name", "id % 5 + 1 AS floor", "30 AS capacity"
        ),
        "providers": spark.range(1, 1001).select(
            n.alias("provider_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"),
            F.lit("MBChB").alias("credential"), (n % 20 + 1).alias("specialty_id"),
            (n % 15 + 1).alias("department_id"), old.alias("last_update"),
        ),
        "patients": both(lambda r, o: r.select(
            (n + o).alias("patient_id"), F.lit("P").alias("first_name"), n.cast("string").alias("last_name"),
            F.date_add(F.lit("1950-01-01").cast("date"), (n * 7 % 25000).cast("int")).alias("date_of_birth"),
            F.when(n % 2 == 0, "F").otherwise("M").alias("gender"),
            F.concat(F.lit("GHA-"), F.lpad((n + o).cast("string"), 7, "0")).alias("mrn"), old.alias("last_update"),
        )),
        "diagnoses": base.select(
            n.alias("diagnosis_id"),
            F.when(n % 50 != 0, F.concat(F.lit("D"), n % 50)).otherwise(
                F.concat(F.lit("Z"), F.lpad((n % 100).cast("string"), 2, "0"), F.lit("."), n % 10)
            ).alias("icd10_code"),
            F.when(n % 50 != 0, "named").otherwise(F.concat(F.lit("Health Status Code "), n)).alias("icd10_description"),
        ),
        "procedures": base.select(
            n.alias("procedure_id"),
            F.when(n % 40 != 0, F.concat(F.lit("C"), n % 40)).otherwise(
                F.concat(F.lit("999"), F.lpad((n % 100).cast("string"), 2, "0"))
            ).alias("cpt_code"),
            F.when(n % 40 != 0, "named").otherwise(F.concat(F.lit("Medical Procedure "), n)).alias("cpt_description"),
        ),
        "encounters": encounters,
    }
    lines = both(lambda r, o: r.select(
        (n + o).alias("encounter_diagnosis_id"), (n + o).alias("encounter_id"),
        ((n - 1) % 10000 + 1).alias("diagnosis_id"), (n % 5 + 1).alias("diagnosis_sequence"),
    ))
    done = both(lambda r, o: r.select(
        (n + o).alias("encounter_procedure_id"), (n + o).alias("encounter_id"),
        ((n - 1) % 10000 + 1).alias("procedure_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 365).cast("int")).alias("procedure_date"),
    ))
    bills = both(lambda r, o: r.select(
        (n + o).alias("billing_id"), (n + o).alias("encounter_id"),
        (n + 500).alias("claim_amount"), (n + 400).alias("allowed_amount"),
        F.lit("2024-06-01").cast("date").alias("claim_date"), _status(n).alias("claim_status"),
    ))
    tables |= {
        "encounter_diagnoses": copies(lines, "encounter_diagnosis_id"),
        "encounter_procedures": copies(done, "encounter_procedure_id"),
        "billing": copies(bills, "billing_id"),
    }
    return {name: conform(tables[name], schema) for name, schema in SOURCE.items()}
