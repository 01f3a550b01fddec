"""Dense surrogate keys without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of a natural key that are cut off at each level of blocks. The windows hold at most
# 2^22 rows, 2^21 blocks and 2^21 blocks of blocks, whatever the keys are.
LEVELS = (22, 43)


def assign_keys(
    new: DataFrame, key: str, natural: Column, start: int = 0, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """Add key = start + rank of the row by its (unique, whole-number) natural key.

    Rows are ranked inside blocks of neighbouring natural keys, blocks are summed inside
    larger blocks, and so on; the largest are few, as a key has 64 bits. So no task sorts
    more than one block at any level, however dense or sparse the keys are. The blocks
    depend on the values alone: a lost executor recomputes the same keys.
    """
    ranked = new.withColumn("_natural", natural.cast("bigint"))
    ranked = ranked.withColumn("_block", F.shiftright("_natural", levels[0]))
    # Rows that are in place and in order for their block's window are so for its offset; else
    # Spark, which can't size the offsets, would broadcast the rows instead.
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("_block").orderBy("_natural")))
    offsets = _offsets(ranked.groupBy("_block").agg(F.count("*").alias("_n")), levels)
    return (
        ranked.hint("merge").join(offsets, "_block")
        .withColumn(key, F.lit(start).cast("bigint") + F.col("_before") + F.col("_rank"))
        .drop("_natural", "_block", "_rank", "_before")
    )


def _offsets(blocks: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Rows in all earlier blocks, per block."""
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    if len(levels) == 1:
        return blocks.select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    upper = F.shiftright("_block", levels[1] - levels[0])
    inside = Window.partitionBy("_upper").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cut = blocks.withColumn("_upper", upper)
    outer = _offsets(cut.groupBy(F.col("_upper").alias("_block")).agg(F.sum("_n").alias("_n")), levels[1:])
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(outer.toDF("_upper", "_outer"), "_upper")
        .select("_block", (F.col("_outer") + F.col("_inside")).alias("_before"))
    )


def max_key(dim: DataFrame | None, key: str) -> int:
    """Highest key in use, 0 for a new table (one row reaches the driver)."""
    if dim is None:
        return 0
    return int(dim.agg(F.max(key)).first()[0] or 0)


def max_key_by_statistics(table: DataFrame, key: str) -> int:
    """The same for a large table, reading little more than parquet footers.

    n distinct keys from 1 upwards reach at least n, so only row groups whose statistics
    allow a key of n or more are read; n itself comes from the footers.
    """
    return max_key(table.filter(F.col(key) >= table.count()), key)
