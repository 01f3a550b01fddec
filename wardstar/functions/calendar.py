"""Date parts with the semantics the warehouse's calendar needs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(when: datetime) -> Column:
    """A wall-clock literal without time zone.

    lit(datetime) would be a zoned literal: the column would be cast to compare with it,
    which keeps the filter from the scan and depends on the session's zone.
    """
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def week_of_year(d: Column) -> Column:
    """Monday-first week 0-53: week 1 is the first with four or more days of this year.

    Not weekofyear(), which hands the days around New Year to the neighbouring year.
    """
    first_weekday = F.weekday(F.trunc(d, "YEAR"))  # Monday 0
    full_weeks = F.floor((F.dayofyear(d) - 1 + first_weekday) / 7)
    return (full_weeks + F.when(first_weekday <= 3, 1).otherwise(0)).cast("int")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)  # Sunday 1, Saturday 7


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def epoch_day(d: Column) -> Column:
    return F.unix_date(d.cast("date"))
