"""Many-to-many bridges between encounters and their diagnoses and procedures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal

# Procedure ids per block of an encounter's day.
BLOCK = 1 << 16


def bridge_diagnoses(
    encounter_diagnoses: DataFrame, new_facts: DataFrame, dim_diagnosis: DataFrame, loaded_at: datetime
) -> DataFrame:
    """One row per (encounter, diagnosis) of the new facts; of copies the lowest sequence.

    Lines that have met the facts by encounter are in place for the grouping, so they are
    shuffled once for both, and with the key alone, as a key stands for one diagnosis.
    """
    lines = encounter_diagnoses.select("encounter_id", "diagnosis_id", "diagnosis_sequence")
    facts = new_facts.select("encounter_id", "encounter_key", "encounter_datetime")
    keys = dim_diagnosis.select("diagnosis_id", "diagnosis_key")
    return (
        lines.join(keys, "diagnosis_id")
        .join(facts, "encounter_id")
        .groupBy("encounter_id", "encounter_key", "encounter_datetime", "diagnosis_key")
        .agg(F.min("diagnosis_sequence").alias("diagnosis_sequence"))
        .select(
            "encounter_key",
            "diagnosis_key",
            "diagnosis_sequence",
            F.to_date("encounter_datetime").alias("diagnosis_date"),
            cal.moment(loaded_at).alias("created_date"),
        )
    )


def number_procedures(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """Position of the first row of each (encounter, date, procedure) in its encounter.

    cells stands for n rows per (encounter_id, procedure_date, procedure_id). Order is by
    date and, where the dates tie, by procedure. Each encounter is cut into blocks of one
    date and neighbouring procedure ids; only the block totals are summed per encounter,
    the rows only inside their block, so no encounter is too large for one task.
    """
    where = ["encounter_id", "procedure_date", "_block"]
    cut = cells.withColumn("_block", F.floor(F.col("procedure_id") / block))
    inside = (
        Window.partitionBy(*where).orderBy("procedure_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    across = (
        Window.partitionBy("encounter_id")
        .orderBy("procedure_date", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*where)
        .agg(F.sum("n").alias("_total"))
        .select(*where, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_before"))
        .toDF("_e", "_d", "_b", "_before")
    )
    numbered = cut.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # A missing procedure date is a value of its own, so the join is null-safe.
    same = (
        (numbered["encounter_id"] == offsets["_e"])
        & numbered["procedure_date"].eqNullSafe(offsets["_d"])
        & numbered["_block"].eqNullSafe(offsets["_b"])
    )
    return (
        numbered.join(offsets, same)
        .withColumn("procedure_sequence", F.col("_before") + F.col("_inside") + 1)
        .select(*cells.columns, "procedure_sequence")
    )


def number_within(cells: DataFrame) -> DataFrame:
    """The same positions from one window per encounter, for encounters of bounded size.

    Cells that have met the facts by encounter are in place for it, and for the grouping that
    follows, so neither shuffles them.
    """
    before = (
        Window.partitionBy("encounter_id")
        .orderBy("procedure_date", "procedure_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return cells.withColumn("procedure_sequence", F.coalesce(F.sum("n").over(before), F.lit(0)) + 1)


def all_within(new_facts: DataFrame, block: int) -> bool:
    """Whether each encounter of the facts has at most block lines, by the facts' own count."""
    return new_facts.filter(F.coalesce("procedure_count", F.lit(0)) > block).isEmpty()


def first_positions(numbered: DataFrame) -> DataFrame:
    """Of a procedure's copies in an encounter, the first position and its date.

    Positions follow the dates, missing dates first, so both minima are of one row. They
    are plain numbers, which keeps the aggregate hash-based.
    """
    no_date = F.lit(-(1 << 31))
    day = F.coalesce(F.unix_date("procedure_date"), no_date)
    return (
        numbered.groupBy("encounter_id", "encounter_key", "procedure_id", "procedure_key")
        .agg(F.min("procedure_sequence").alias("procedure_sequence"), F.min(day).alias("_day"))
        .withColumn("procedure_date", F.when(F.col("_day") != no_date, F.date_from_unix_date("_day")))
    )


def bridge_procedures(
    encounter_procedures: DataFrame,
    new_facts: DataFrame,
    dim_procedure: DataFrame,
    loaded_at: datetime,
    block: int = BLOCK,
) -> DataFrame:
    """One row per (encounter, procedure) of the new facts with its position in time.

    Positions count every row whose procedure is known, copies included; a copied
    procedure keeps its first position. Lines that have met the facts by encounter are in
    place for counting, numbering and grouping. Encounters are numbered in blocks if one has
    more lines than a block holds.
    """
    cells = (
        encounter_procedures.select("encounter_id", "procedure_date", "procedure_id")
        .join(dim_procedure.select("procedure_id", "procedure_key"), "procedure_id")
        .join(new_facts.select("encounter_id", "encounter_key"), "encounter_id")
        .groupBy("encounter_id", "encounter_key", "procedure_date", "procedure_id", "procedure_key")
        .agg(F.count("*").alias("n"))
    )
    numbered = number_within(cells) if all_within(new_facts, block) else number_procedures(cells, block)
    return first_positions(numbered).select(
        "encounter_key",
        "procedure_key",
        "procedure_sequence",
        "procedure_date",
        cal.moment(loaded_at).alias("created_date"),
    )
