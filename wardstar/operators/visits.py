"""Encounters and exact distinct patients per month, specialty and type, kept by increments.

A count of distinct patients can't be added up over batches; a set of them can be united.
Surrogate keys are dense, so a set is kept as bitmaps of 2^15 neighbouring patient keys. A
batch adds rows for its own facts and reads no older ones: what a later bill or discharge
changes in a fact is none of these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = ("year_month", "specialty_key", "encounter_type_key")


def month_visits(facts: DataFrame) -> DataFrame:
    """Rows of GROUP and bucket with the number of facts and the bitmap of their patients."""
    key = F.col("patient_key")
    return facts.groupBy(*GROUP, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.count("*").alias("encounters"), F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("patients")
    )


def united(visits: DataFrame, *group: str) -> DataFrame:
    """One row per group and bucket from the rows of several batches."""
    return visits.groupBy(*group, "bucket").agg(
        F.sum("encounters").alias("encounters"), F.bitmap_or_agg("patients").alias("patients")
    )


def counted(visits: DataFrame, *group: str) -> DataFrame:
    """Per group: total_encounters and unique_patients; a patient counts once in any grouping."""
    return united(visits, *group).groupBy(*group).agg(
        F.sum("encounters").alias("total_encounters"),
        F.sum(F.bitmap_count("patients")).alias("unique_patients"),
    )
