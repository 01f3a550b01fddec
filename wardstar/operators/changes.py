"""What changed in the source since the last batch, found without joining it to the facts.

Encounters and bills are digested in blocks of neighbouring encounter ids: rows, money and
two checksums per block, one aggregate on the map side and a shuffle of digests only. The
digests are kept with the snapshot. Blocks whose digest differs, and only they, are then
compared row by row with the stored facts, so a batch without late changes never joins
source and fact, and one with some of them joins the ids around the changed ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import facts

#: Encounter ids per block: 2^BLOCK_BITS.
BLOCK_BITS = 14
#: What a later bill or discharge changes in a fact.
MEASURES = ("discharge_datetime", "length_of_stay_days", "total_claim_amount", "total_allowed_amount", "has_billing")

_MONEY = "decimal(38,2)"


def block_of(encounter_id: Column) -> Column:
    return F.shiftright(encounter_id, BLOCK_BITS)


def row_hash(*columns: str) -> Column:
    """A hash that also tells which of the columns are null."""
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def _digest(rows: DataFrame, table: str, money: Column, *values: str) -> DataFrame:
    """Per block: rows, money, and two sums of row hashes, one of which sees repeated rows."""
    h = row_hash("encounter_id", *values)
    return rows.groupBy(block_of(F.col("encounter_id")).alias("block")).agg(
        F.lit(table).alias("source_table"),
        F.count("*").alias("n"),
        F.coalesce(F.sum(money), F.lit(0)).cast(_MONEY).alias("money"),
        F.bit_xor(h).alias("mixed"),
        F.sum(F.pmod(h, F.lit(1 << 31))).alias("summed"),
    )


def digests(source: Mapping[str, DataFrame]) -> DataFrame:
    """(block, source_table, n, money, mixed, summed) of the encounters and the bills."""
    none = F.lit(0).cast(_MONEY)
    return _digest(source["encounters"], "encounters", none, "encounter_date", "discharge_date").unionByName(
        _digest(source["billing"], "billing", F.col("allowed_amount"), "claim_amount", "allowed_amount")
    )


def changed_blocks(now: DataFrame, before: DataFrame) -> DataFrame:
    """Blocks of ids in which either table is not what it was."""
    same = ["block", "source_table", "n", "money", "mixed", "summed"]
    return (
        now.select(same).withColumn("side", F.lit(1)).unionByName(before.select(same).withColumn("side", F.lit(-1)))
        .groupBy(same).agg(F.sum("side").alias("side")).filter("side <> 0").select("block").distinct()
    )


def in_blocks(rows: DataFrame, blocks: DataFrame, low: int, high: int) -> DataFrame:
    """Rows of some blocks; low and high bound their ids, so that row groups are skipped."""
    near = rows.filter(F.col("encounter_id").between(low, high))
    return near.withColumn("block", block_of(F.col("encounter_id"))).join(blocks, "block", "left_semi").drop("block")


def changed_facts(
    fact: DataFrame, source: Mapping[str, DataFrame], blocks: DataFrame, low: int, high: int
) -> DataFrame:
    """Stored facts of the blocks whose measures the source now gives otherwise.

    One row per fact: its keys, `old_` and `new_` measures. Rows that the source checks
    would stop a batch for, and encounters that are in the source twice, change nothing.
    """
    rows = facts.one_per_encounter(in_blocks(source["encounters"], blocks, low, high))[0]
    money = facts.billing_per_encounter(in_blocks(source["billing"], blocks, low, high))
    fresh = (
        rows.join(money, "encounter_id", "left")
        .filter(~F.coalesce(F.col("_negative"), F.lit(False)))
        .filter(F.coalesce(F.col("discharge_date") >= F.col("encounter_date"), F.lit(True)))
        .select(
            "encounter_id",
            F.col("discharge_date").alias("new_discharge_datetime"),
            facts.length_of_stay(F.col("encounter_date"), F.col("discharge_date")).alias("new_length_of_stay_days"),
            F.col("total_claim_amount").cast("decimal(22,2)").alias("new_total_claim_amount"),
            F.col("total_allowed_amount").cast("decimal(22,2)").alias("new_total_allowed_amount"),
            F.coalesce("has_billing", F.lit(False)).alias("new_has_billing"),
        )
    )
    stored = in_blocks(fact, blocks, low, high).select(
        "encounter_id", "encounter_key", "patient_id", "encounter_type_key", "encounter_datetime", "year_month",
        *[F.col(m).alias(f"old_{m}") for m in MEASURES],
    )
    both = stored.join(fresh, "encounter_id")
    # One hash per side instead of a comparison per measure.
    hashes = [row_hash(*[f"{side}_{m}" for m in MEASURES]) for side in ("old", "new")]
    return both.filter(hashes[0] != hashes[1])


def signed(changes: DataFrame) -> DataFrame:
    """Each changed fact twice: as it was with sign -1, and as it is with sign 1."""

    def side(name: str, sign: int) -> DataFrame:
        return changes.select(
            "encounter_key",
            F.lit(sign).alias("sign"),
            *[F.col(f"{name}_{m}").alias(m) for m in ("total_allowed_amount", "length_of_stay_days")],
        )

    return side("old", -1).unionByName(side("new", 1))


def month_digests(fact: DataFrame) -> DataFrame:
    """(year_month, encounters, revenue, mixed): what a month of facts adds up to."""
    return fact.groupBy("year_month").agg(
        F.count("*").alias("encounters"),
        F.coalesce(F.sum("total_allowed_amount"), F.lit(0)).cast(_MONEY).alias("revenue"),
        F.bit_xor(row_hash("encounter_id", *MEASURES)).alias("mixed"),
    )
