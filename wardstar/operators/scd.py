"""Insert-ignore, upsert and history keeping, as snapshot to snapshot functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from .keys import assign_keys, max_key

OPEN_END = date(9999, 12, 31)  # Fixed value: expiration of a current version.

Stage = Callable[[DataFrame], DataFrame]


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the least by order then by the other columns.

    An aggregate and not a window: copies of one key collapse before the shuffle.
    """
    values = [c for c in order if c not in keys]
    values += [c for c in df.columns if c not in keys and c not in order]
    if len(values) == 1:  # a plain minimum stays hash-based
        return df.groupBy(*keys).agg(F.min(values[0]).alias(values[0])).select(df.columns)
    least = F.min(F.struct(*values)).alias("_row")
    return df.groupBy(*keys).agg(least).select(*keys, "_row.*").select(df.columns)


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target plus the new rows whose key it does not hold; of equal new keys the first."""
    fresh = first_per_key(new, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def upsert(target: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Overwrite rows with a matching key, add the others, delete nothing.

    keep names columns an update leaves as they are (surrogate key, creation time).
    """
    new = new.withColumn("_hit", F.lit(True))
    joined = target.alias("t").join(new.alias("n"), key, "full_outer")
    columns = []
    for name in target.columns:
        if name == key:
            columns.append(F.col(key))
        elif name in keep:
            columns.append(F.coalesce(F.col(f"t.{name}"), F.col(f"n.{name}")).alias(name))
        else:
            columns.append(
                F.when(F.col("_hit"), F.col(f"n.{name}")).otherwise(F.col(f"t.{name}")).alias(name)
            )
    return joined.select(columns)


def scd1_changes(dim: DataFrame, src: DataFrame, natural: str, key: str) -> DataFrame:
    """Source rows that are new or differ from the dimension; known ones with their key."""
    old = dim.select(
        F.col(natural).alias("_natural"), key, *[F.col(c).alias(f"_{c}") for c in src.columns if c != natural]
    )
    joined = src.join(old, src[natural] == old["_natural"], "left")
    same = F.col(key).isNotNull()
    for c in src.columns:
        if c != natural:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return joined.filter(~same).select(key, *src.columns)


def scd1_apply(dim: DataFrame, changes: DataFrame, natural: str, key: str, order: Column) -> DataFrame:
    """Next snapshot: untouched rows, changed rows under their key, new rows after them.

    The untouched rows meet only the change set, which is broadcast while it is small,
    so the large side is rewritten without a shuffle.
    """
    new = changes.filter(F.col(key).isNull()).drop(key)
    keyed = assign_keys(new, key, order, max_key(dim, key)).select(dim.columns)
    untouched = dim.join(changes.select(natural), natural, "left_anti").select(dim.columns)
    known = changes.filter(F.col(key).isNotNull()).select(dim.columns)
    return untouched.unionByName(known).unionByName(keyed)


def upsert_scd1(
    dim: DataFrame | None,
    src: DataFrame,
    natural: str,
    key: str,
    order: Column | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Next snapshot of an overwrite-in-place dimension; rows are never deleted.

    order ranks new rows when the natural key is not a whole number. stage writes the
    change set and reads it back; with it, a dimension without changes is returned as is.
    """
    order = F.col(natural) if order is None else order
    if dim is None:
        return assign_keys(src, key, order).select(key, *src.columns)
    changes = scd1_changes(dim, src, natural, key)
    if stage is not None:
        changes = stage(changes)
        if changes.isEmpty():
            return dim
    return scd1_apply(dim, changes, natural, key, order)


@dataclass(frozen=True)
class Scd2Next:
    """Outcome of one history-keeping step; earlier history rows stay as they are.

    changes are the rows that replace or join the current ones; within(part) is the same
    step over a part of the current rows that holds all those the changes replace.
    """

    current: DataFrame
    expired: DataFrame
    changes: DataFrame | None = None
    within: Callable[[DataFrame], "Scd2Next"] | None = None

    def all_with(self, history: DataFrame) -> DataFrame:
        return history.unionByName(self.expired).unionByName(self.current)


def changed_keys(src: DataFrame, natural: str, since: datetime) -> DataFrame:
    """Source rows touched after the last load; the change set of this batch only."""
    return src.filter(F.col("last_update") > cal.moment(since)).select(natural)


def scd2_new_versions(
    attrs: DataFrame, current: DataFrame, changed: DataFrame, natural: str
) -> DataFrame:
    """Changed rows that have a current version to replace."""
    touched = current.select(natural).join(changed, natural, "left_semi")
    return attrs.join(touched, natural, "left_semi")


def scd2_new_keys(attrs: DataFrame, known: DataFrame, natural: str) -> DataFrame:
    """Rows the dimension has never seen, in any version."""
    return attrs.join(known.select(natural), natural, "left_anti")


def scd2_expire(current: DataFrame, changes: DataFrame, natural: str, as_of: date) -> DataFrame:
    """Current versions that the change set replaces, closed as of this batch."""
    return (
        current.join(changes.select(natural), natural, "left_semi")
        .withColumn("is_current", F.lit(False))
        .withColumn("expiration_date", F.lit(as_of))
        .select(current.columns)
    )


def scd2_open(rows: DataFrame, natural: str, key: str, start: int, as_of: date) -> DataFrame:
    """Rows as current versions with keys after start."""
    return (
        assign_keys(rows, key, F.col(natural), start)
        .withColumn("effective_date", F.lit(as_of))
        .withColumn("expiration_date", F.lit(OPEN_END))
        .withColumn("is_current", F.lit(True))
        .select(key, *rows.columns, "effective_date", "expiration_date", "is_current")
    )


def scd2_next(
    current: DataFrame | None,
    history: DataFrame | None,
    attrs: DataFrame,
    src: DataFrame,
    natural: str,
    key: str,
    as_of: date,
    since: datetime,
    stage: Stage | None = None,
) -> Scd2Next:
    """Next state from the current versions, closed ones and the source.

    attrs carries the dimension's attributes per natural key; src its last_update. The
    current rows meet only the change set, so while that is small they are rewritten
    without a shuffle. stage writes the change set and reads it back; with it, a
    dimension without changes keeps its current frame.
    """
    if current is None:
        first = scd2_open(attrs, natural, key, 0, as_of)
        return Scd2Next(first, first.limit(0))
    known = current.select(natural).unionByName(history.select(natural))
    changed = changed_keys(src, natural, since)
    changes = scd2_new_versions(attrs, current, changed, natural).unionByName(
        scd2_new_keys(attrs, known, natural)
    )
    if stage is not None:
        changes = stage(changes)
        if changes.isEmpty():
            return Scd2Next(current, current.limit(0))
    start = max(max_key(current, key), max_key(history, key))

    def within(part: DataFrame) -> Scd2Next:
        kept = part.join(changes.select(natural), natural, "left_anti").select(current.columns)
        opened = scd2_open(changes, natural, key, start, as_of).select(current.columns)
        expired = scd2_expire(part, changes, natural, as_of)
        return Scd2Next(kept.unionByName(opened), expired, changes, within)

    return within(current)
