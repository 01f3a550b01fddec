"""Exact decimal ratios: one HALF_UP rounding, never through floating point."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    ratio = part.cast("decimal(18,0)") * F.lit(Decimal("100.0")) / whole.cast("decimal(18,0)")
    return F.round(ratio, digits).cast(f"decimal(12,{digits})")


def mean(total: Column, count: Column, digits: int) -> Column:
    """total / count rounded to digits; null when count is zero."""
    ratio = total.cast("decimal(28,2)") / F.nullif(count, F.lit(0)).cast("decimal(18,0)")
    return F.round(ratio, digits).cast(f"decimal(22,{digits})")
