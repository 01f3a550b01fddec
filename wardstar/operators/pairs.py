"""Diagnosis-procedure pairs, reduced to codes before they are paired.

Pairing bridge rows directly emits (diagnoses x procedures) rows per encounter. Here
each side is first counted per encounter and code, so an encounter emits each pair of
codes once, with the number of row pairs it stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIAGNOSIS = ["icd10_code", "icd10_description"]
PROCEDURE = ["cpt_code", "cpt_description"]
PAIR = DIAGNOSIS + PROCEDURE


def code_groups(dim: DataFrame, natural: str, text: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Number each distinct (code, description) by its least key.

    Returns (natural key -> group) and (group -> texts): rows are shuffled with one
    number instead of two texts.
    """
    groups = dim.groupBy(*text).agg(F.min(natural).alias(name))
    same = None
    g = groups.select(*[F.col(c).alias(f"_{c}") for c in text], name)
    for c in text:
        test = dim[c].eqNullSafe(g[f"_{c}"])
        same = test if same is None else same & test
    members = dim.join(g, same).select(natural, name)
    return members, groups


def code_counts(lines: DataFrame, encounter: str, natural: str, members: DataFrame, name: str, n: str) -> DataFrame:
    """Rows per encounter and code group."""
    return counted(lines.join(members, natural), encounter, name, n)


def counted(lines: DataFrame, encounter: str, name: str, n: str) -> DataFrame:
    return lines.groupBy(encounter, name).agg(F.count("*").alias(n))


def pair_totals(facts: DataFrame, diagnosis_counts: DataFrame, procedure_counts: DataFrame) -> DataFrame:
    """Totals per pair of code groups.

    encounter_count counts an encounter once per pair. Revenue and stay keep the fan-out
    of the row pairs: an encounter with two diagnoses of one code weighs twice. Facts with
    a column `sign` are added or, with sign -1, taken off.
    """
    sign = F.col("sign") if "sign" in facts.columns else F.lit(1)
    weight = F.col("n_d") * F.col("n_p") * sign
    n = weight.cast("decimal(15,0)")
    stay = F.col("length_of_stay_days")
    return (
        diagnosis_counts.join(facts, "encounter_key")
        .join(procedure_counts, "encounter_key")
        .groupBy("diagnosis_group", "procedure_group")
        .agg(
            F.sum(sign).cast("bigint").alias("encounter_count"),
            F.sum(F.col("total_allowed_amount") * n).alias("total_revenue"),
            F.sum(stay * weight).alias("sum_los"),
            F.sum(F.when(stay.isNotNull(), weight)).alias("n_los"),
        )
    )


def with_texts(totals: DataFrame, diagnosis_groups: DataFrame, procedure_groups: DataFrame) -> DataFrame:
    return totals.join(diagnosis_groups, "diagnosis_group").join(procedure_groups, "procedure_group")


def pair_summary(
    facts: DataFrame,
    bridge_diagnoses: DataFrame,
    bridge_procedures: DataFrame,
    dim_diagnosis: DataFrame,
    dim_procedure: DataFrame,
) -> DataFrame:
    """Per pair of codes: encounters, revenue, sum and count of stays."""
    d_members, d_groups = code_groups(dim_diagnosis, "diagnosis_key", DIAGNOSIS, "diagnosis_group")
    p_members, p_groups = code_groups(dim_procedure, "procedure_key", PROCEDURE, "procedure_group")
    # Lines that have met the facts by encounter are in place for counting and for the pairs. A
    # semi join would be moved below the join with the groups, which then moves the lines away.
    ids = facts.select("encounter_key").distinct()  # signed facts are there twice
    d_lines, p_lines = (lines.join(ids, "encounter_key") for lines in (
        bridge_diagnoses.join(d_members, "diagnosis_key"), bridge_procedures.join(p_members, "procedure_key")
    ))
    totals = pair_totals(
        facts.select(
            "encounter_key", "total_allowed_amount", "length_of_stay_days", *[c for c in facts.columns if c == "sign"]
        ),
        counted(d_lines, "encounter_key", "diagnosis_group", "n_d"),
        counted(p_lines, "encounter_key", "procedure_group", "n_p"),
    )
    return with_texts(totals, d_groups, p_groups).select(
        *PAIR,
        "encounter_count",
        F.coalesce(F.col("total_revenue"), F.lit(0)).cast("decimal(38,2)").alias("total_revenue"),
        F.coalesce("sum_los", F.lit(0)).alias("sum_los"),
        F.coalesce("n_los", F.lit(0)).alias("n_los"),
    )


def merge_summaries(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add a batch's summary to the kept one; exact because sums and counts are kept."""
    return merged(old.unionByName(new))


def merged(summaries: DataFrame) -> DataFrame:
    """One row per pair from the rows of several summaries, signed ones too."""
    return (
        summaries.groupBy(*PAIR)
        .agg(
            F.sum("encounter_count").alias("encounter_count"),
            F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
            F.sum("sum_los").alias("sum_los"),
            F.sum("n_los").alias("n_los"),
        )
    )


def texts_changed(old: DataFrame, new: DataFrame, natural: str, text: list[str]) -> DataFrame:
    """Rows of a dimension whose code or description differs from the last snapshot."""
    o = old.select(natural, *[F.col(c).alias(f"_{c}") for c in text])
    joined = new.join(o, natural)
    same = None
    for c in text:
        test = joined[c].eqNullSafe(joined[f"_{c}"])
        same = test if same is None else same & test
    return joined.filter(~same).select(natural)
