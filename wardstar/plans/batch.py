"""One incremental load: checks, dimensions, facts, bridges, reconciliation, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..context import FIRST_WATERMARK, BatchContext
from ..functions import calendar as cal
from ..functions.clinical import text_key
from ..operators import bridges, changes, dims, facts, pairs, quality, readmission, visits
from ..operators.keys import max_key_by_statistics
from ..operators.scd import upsert
from ..schemas import STATE, TARGET, literal_rows
from ..sources.tables import checked
from ..sources.warehouse import Snapshot, Warehouse, bucket_of, buckets_for

T = TypeVar("T")

# Step names that users of the log look for.
BATCH_STEP = "incremental_etl_batch"
DIM_STEP = "load_dimensions_incremental"
FACT_STEP = "load_fact_incremental"
BRIDGE_STEP = "load_bridge_incremental"
STEPS = (BATCH_STEP, DIM_STEP, FACT_STEP, BRIDGE_STEP)

# Days around a batch in which a discharge can matter to an admission.
REACH = timedelta(days=readmission.WINDOW_DAYS + 1)


@dataclass(frozen=True)
class BatchResult:
    snapshot: Snapshot
    previous_watermark: datetime
    new_watermark: datetime
    new_encounters: int
    rejected: int
    repaired_flags: int
    started_at: datetime
    finished_at: datetime
    refreshed_facts: int = 0


class StepLog:
    """Open and close events of the steps; several events share one small append."""

    def __init__(self, wh: Warehouse, ctx: BatchContext):
        self.wh, self.ctx = wh, ctx
        self.running: list[str] = []
        self.attempt: datetime | None = None  # time of the first event

    def record(self, closed: dict[str, int] | None = None, opened=(), message: str | None = None) -> None:
        rows = []
        for step, n in (closed or {}).items():
            rows.append(self._row(step, "SUCCESS", n))
            self.running.remove(step)
        for step in opened:
            rows.append(self._row(step, "RUNNING", None, message if step == BATCH_STEP else None))
            self.running.append(step)
        self.wh.append_log(rows)

    def fail(self, error: Exception) -> None:
        rows = [self._row(step, "FAILED", None, str(error)) for step in self.running]
        self.running.clear()
        if rows:
            self.wh.append_log(rows)

    def _row(self, step, status, n, message=None):
        log_id = self.ctx.batch_id * len(STEPS) + STEPS.index(step)
        now = self.ctx.clock()
        self.attempt = self.attempt or now
        return (self.ctx.batch_id, self.attempt, log_id, step, now, n, status, message)


@dataclass(frozen=True)
class Marks:
    """Where the last successful load of each table ended."""

    encounters: datetime = FIRST_WATERMARK
    patients: datetime = FIRST_WATERMARK
    providers: datetime = FIRST_WATERMARK


def read_marks(metadata: DataFrame) -> Marks:
    """Watermarks of successful loads (at most one row per loaded table)."""
    rows = {r.table_name: r for r in metadata.filter("last_etl_status = 'SUCCESS'").collect()}

    def mark(table: str, column: str) -> datetime:
        return rows[table][column] if table in rows else FIRST_WATERMARK

    return Marks(
        mark("fact_encounters", "high_watermark"),
        mark("dim_patient", "last_etl_timestamp"),
        mark("dim_provider", "last_etl_timestamp"),
    )


def at_once(*jobs: Callable[[], T]) -> list[T]:
    """Submit independent Spark jobs together and wait for all."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


# -- dimensions ---------------------------------------------------------------------


def _stage(wh: Warehouse, table: str, ctx: BatchContext):
    return lambda df: wh.scratch(df, f"changes_{table}", ctx.batch_id)


def _next_table(wh: Warehouse, snap: Snapshot, ctx: BatchContext, table: str, build) -> tuple[str, list[str]]:
    """Folders of a table after build(current rows, stage); the old ones if it is unchanged."""
    paths = snap.paths.get(table)
    old = wh.read(table, snap) if paths else None
    new = build(old, _stage(wh, table, ctx))
    return table, list(paths) if new is old else [wh.write(new, table, ctx.batch_id)]


def _next_versions(
    wh: Warehouse, snap: Snapshot, ctx: BatchContext, table: str, natural: str, rows: DataFrame, build
) -> tuple[str, list[str]]:
    """The same with history, in buckets of the natural key.

    Only the buckets that hold a changed or new key are written again; the other current
    rows and the older history stay where they are.
    """
    paths = snap.paths.get(table, ())

    def write(df: DataFrame, part: str, buckets: int) -> list[str]:
        return wh.write_buckets(df, table, ctx.batch_id, part, natural, buckets)

    if not paths:
        return table, write(build(None, None, None).current, "is_current=true", buckets_for(rows.count()))
    current, history = wh.read(table, snap, "is_current=true"), wh.read(table, snap, "is_current=false")
    step = build(current, history, _stage(wh, table, ctx))
    if step.current is current:
        return table, list(paths)
    if not all("/buckets=" in p for p in paths):  # a table from before there were buckets
        buckets, kept, closed = buckets_for(rows.count()), [], step.expired.unionByName(history)
    else:
        buckets = int(paths[0].split("/buckets=")[1].split("/")[0])
        hit = step.changes.select(bucket_of(F.col(natural), buckets).alias("b")).distinct()
        ends = tuple(f"/bucket={r.b}" for r in hit.collect())  # bounded by the number of buckets
        touched = [p for p in paths if "is_current=true" in p and p.endswith(ends)]
        kept = [p for p in paths if p not in touched]
        step = step.within(wh.read(table, Snapshot(0, {table: tuple(touched)})))
        closed = step.expired
    live, ended = at_once(
        lambda: write(step.current, "is_current=true", buckets), lambda: write(closed, "is_current=false", buckets)
    )
    return table, [*kept, *ended, *live]


def _calendar_bounds(source: Mapping[str, DataFrame], ctx: BatchContext, marks: Marks) -> DataFrame:
    """Years of the encounters this batch may load; older ones are in the calendar."""
    rows = source["encounters"]
    return dims.calendar_range(facts.delta(rows, None, marks.encounters, ctx.strict))


def load_calendar(
    wh: Warehouse, snap: Snapshot, source: Mapping[str, DataFrame], ctx: BatchContext, marks: Marks
) -> Snapshot:
    """Only the calendar, extended to the years of the arriving encounters."""
    bounds = _calendar_bounds(source, ctx, marks)
    return snap.replaced(*_next_table(wh, snap, ctx, "dim_date", partial(dims.dim_date, bounds)))


def load_dimensions(
    wh: Warehouse, snap: Snapshot, source: Mapping[str, DataFrame], ctx: BatchContext, marks: Marks
) -> Snapshot:
    """All eight dimensions."""

    def plain(table: str, build, src: DataFrame):
        return lambda: _next_table(wh, snap, ctx, table, partial(build, src))

    def patients(*state):
        return dims.dim_patient(source["patients"], ctx.as_of, marks.patients, *state)

    def providers(*state):
        related = source["providers"], source["specialties"], source["departments"]
        return dims.dim_provider(*related, ctx.as_of, marks.providers, *state)

    # The dimensions do not depend on each other, so their jobs share the executors.
    written = at_once(
        lambda: _next_versions(wh, snap, ctx, "dim_patient", "patient_id", source["patients"], patients),
        lambda: _next_versions(wh, snap, ctx, "dim_provider", "provider_id", source["providers"], providers),
        plain("dim_date", dims.dim_date, _calendar_bounds(source, ctx, marks)),
        plain("dim_specialty", dims.dim_specialty, source["specialties"]),
        plain("dim_department", dims.dim_department, source["departments"]),
        plain("dim_encounter_type", dims.dim_encounter_type, wh.spark),
        plain("dim_diagnosis", dims.dim_diagnosis, source["diagnoses"]),
        plain("dim_procedure", dims.dim_procedure, source["procedures"]),
    )
    for table, paths in written:
        snap = snap.replaced(table, paths)
    return snap


# -- facts --------------------------------------------------------------------------


@dataclass(frozen=True)
class FactLoad:
    snapshot: Snapshot
    new_paths: tuple[str, ...]
    loaded: int
    rejected: int
    repaired: int
    high_watermark: datetime | None
    checks: dict[str, int] = field(default_factory=dict)


def stage_facts(
    wh: Warehouse,
    snap: Snapshot,
    source: Mapping[str, DataFrame],
    ctx: BatchContext,
    watermark: datetime,
    lookup: str = "current",
) -> tuple[DataFrame, DataFrame | None, dict]:
    """The batch's encounters with keys, measures and reject reason, written once.

    After the first load the delta is written before anything else, so that its size is
    known and the large tables are reduced to it before any join or count. A strict batch
    has checked that ids are unique; otherwise one row per id goes on, and the second
    result has the reject rows of the other copies. These are found first, from the ids alone,
    and only if there are any, wide rows are reduced to one per id. The third has what was
    observed while writing, so that the written rows needn't be read to be counted.
    """
    loaded = wh.read("fact_encounters", snap) if snap.paths.get("fact_encounters") else None
    if loaded is not None and not ctx.strict and snap.paths.get("fact_ids"):
        # Any id may have arrived before: the list of ids is asked and no fact is read.
        loaded = facts.known_ids(wh.read("fact_ids", snap), source["encounters"])
    new = facts.delta(source["encounters"], loaded, watermark, ctx.strict)
    scope, copies = _whole, None
    if loaded is not None or not ctx.strict:
        new = wh.scratch(new, "delta", ctx.batch_id)
    if loaded is not None:
        scope = partial(_in_batch, new)
    if not ctx.strict:
        single, copies = facts.one_per_encounter(new)
        copies = wh.scratch(copies, "copies", ctx.batch_id)
        if copies.isEmpty():
            copies = None
        else:
            new = single
    versions = None if lookup == "as_of" else "is_current=true"
    diagnoses, procedures, billing = (
        scope(source[t], "encounter_id") for t in ("encounter_diagnoses", "encounter_procedures", "billing")
    )
    rows = facts.lookup_keys(
        new,
        wh.read("dim_date", snap),
        scope(wh.read("dim_patient", snap, versions), "patient_id"),
        scope(wh.read("dim_provider", snap, versions), "provider_id"),
        wh.read("dim_specialty", snap),
        wh.read("dim_department", snap),
        wh.read("dim_encounter_type", snap),
        lookup,
        lambda met: facts.join_measures(met, diagnoses, procedures, billing),
    )
    seen = Observation()
    observed = facts.finish_staged(rows).observe(seen, *facts.staged_metrics(watermark))
    staged = wh.scratch(observed, "facts", ctx.batch_id)
    metrics = dict(seen.get)  # without entries where the planner saw that there are no rows
    for end in ("first_in", "last_in", "last_out"):
        metrics[end] = datetime.fromisoformat(metrics[end]) if metrics.get(end) else None
    return staged, copies, metrics


def _whole(rows: DataFrame, key: str) -> DataFrame:
    return rows


def _in_batch(batch: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return facts.scoped(rows, batch, key)


def load_facts(
    wh: Warehouse,
    snap: Snapshot,
    source: Mapping[str, DataFrame],
    ctx: BatchContext,
    watermark: datetime,
    lookup: str = "current",
) -> FactLoad:
    old_paths = snap.paths.get("fact_encounters", ())
    old = wh.read("fact_encounters", snap) if old_paths else None
    staged, copies, seen = stage_facts(wh, snap, source, ctx, watermark, lookup)
    ok = facts.accepted(staged)
    loaded, n_rejected = seen.get("n", 0), seen.get("rejected", 0)
    checks = {c: seen.get(c, 0) for c in (*facts.COVERAGE, facts.LATE)}
    if copies is not None or n_rejected:
        refused = facts.rejected(staged)
        rejects = wh.write(refused if copies is None else refused.unionByName(copies), "rejects", ctx.batch_id)
        n_rejected = wh.read("rejects", Snapshot(0, {"rejects": (rejects,)})).count()
        if n_rejected:
            snap = snap.extended("rejects", [rejects])
    if not loaded:
        return FactLoad(snap, (), 0, n_rejected, 0, None, checks)

    discharges = ok.filter("is_inpatient").select(
        "patient_id", F.col("discharge_datetime").alias("discharged")
    )
    if old is not None:
        stays = _inpatients(old, wh.read("dim_encounter_type", snap))
        affected = ok.select("patient_id").distinct()
        # Only discharges near the batch can matter; the bound reaches the fact scan.
        near = stays.filter(F.col("discharge_datetime") >= cal.moment(seen["first_in"] - REACH))
        earlier = near.join(affected, "patient_id", "left_semi").select(
            "patient_id", F.col("discharge_datetime").alias("discharged")
        )
        discharges = discharges.unionByName(earlier)

    start = 0 if old is None else max_key_by_statistics(old, "encounter_key")
    keyed = facts.key_facts(ok, start, ctx.started_at)
    new_paths = [wh.write_fact(readmission.flag(keyed, readmission.stays_of(ok), discharges), ctx.batch_id)]
    # The list holds the ids of all facts; one that isn't there yet begins with those stored.
    unlisted = new_paths if old is None or snap.paths.get("fact_ids") else [*old_paths, *new_paths]
    fresh = wh.read("fact_encounters", Snapshot(0, {"fact_encounters": tuple(unlisted)}))
    snap = snap.extended("fact_ids", [wh.write_ids(fresh, ctx.batch_id)])
    repaired = 0
    kept = list(old_paths)
    if old is not None and not ctx.strict and seen["last_out"] is not None:
        last = seen["last_out"] + REACH
        candidates = facts.until(facts.after(stays, seen["first_in"]), last).join(
            affected, "patient_id", "left_semi"
        )
        kept, repaired = _repair_flags(wh, old_paths, candidates, discharges, ctx)
    snap = snap.replaced("fact_encounters", [*kept, *new_paths])
    return FactLoad(snap, tuple(new_paths), loaded, n_rejected, repaired, seen["last_in"], checks)


def _inpatients(fact: DataFrame, dim_encounter_type: DataFrame) -> DataFrame:
    kind = dim_encounter_type.filter(text_key(F.col("encounter_type")) == facts.INPATIENT)
    return fact.join(kind.select("encounter_type_key"), "encounter_type_key", "left_semi")


def _repair_flags(
    wh: Warehouse, old_paths, candidates: DataFrame, discharges: DataFrame, ctx: BatchContext
) -> tuple[list[str], int]:
    """Rewrite the months in which late rows changed a stored flag; return live paths."""
    changed = _changed_flags(wh, candidates, discharges, ctx)
    per_month = {r.year_month: r["count"] for r in changed.groupBy("year_month").count().collect()}
    if not per_month:
        return list(old_paths), 0
    kept = _rewrite_months(wh, old_paths, set(per_month), changed, None, ctx, "repair")
    return kept, sum(per_month.values())


def _changed_flags(wh: Warehouse, candidates: DataFrame, discharges: DataFrame, ctx: BatchContext) -> DataFrame:
    """(encounter_id, year_month, _now): stored stays whose flag is another one now; written."""
    stays = candidates.select(
        "encounter_id", "patient_id", F.col("encounter_datetime").alias("admitted")
    )
    hits = readmission.readmitted(stays, discharges).withColumn("_now", F.lit(True))
    now = F.coalesce("_now", F.lit(False))
    return wh.scratch(
        candidates.select("encounter_id", "is_readmission", "year_month")
        .join(hits, "encounter_id", "left")
        .filter(now != F.col("is_readmission"))
        .select("encounter_id", "year_month", now.alias("_now")),
        "changed_flags",
        ctx.batch_id,
    )


def _rewrite_months(
    wh: Warehouse, old_paths, months: set[str], flags: DataFrame | None, measures: DataFrame | None, ctx: BatchContext, label: str
) -> list[str]:
    """Write the given months again with new flags and measures; return the live paths.

    The edits are few beside the months, so they are broadcast by their size and the rows
    are not shuffled to them.
    """
    kept, touched = wh.without_months(old_paths, months)
    rows = wh.read("fact_encounters", Snapshot(0, {"fact_encounters": tuple(touched)}))
    columns, edited = rows.columns, F.lit(False)
    if flags is not None:
        rows = rows.join(flags.select("encounter_id", "_now"), "encounter_id", "left")
        rows = rows.withColumn("is_readmission", F.coalesce("_now", "is_readmission"))
        edited = edited | F.col("_now").isNotNull()
    if measures is not None:
        fresh = measures.select("encounter_id", F.lit(True).alias("_hit"), *[f"new_{m}" for m in changes.MEASURES])
        rows = rows.join(fresh, "encounter_id", "left")
        for m in changes.MEASURES:
            rows = rows.withColumn(m, F.when(F.col("_hit"), F.col(f"new_{m}")).otherwise(F.col(m)))
        edited = edited | F.col("_hit").isNotNull()
    rows = rows.withColumn("updated_date", F.when(edited, cal.moment(ctx.started_at)).otherwise(F.col("updated_date")))
    return [*kept, wh.write_fact(rows.select(columns), ctx.batch_id, label=label)]


# -- late bills and discharges ------------------------------------------------------


@dataclass(frozen=True)
class Refresh:
    """Facts brought up to the source: the snapshot, the changed facts, how many."""

    snapshot: Snapshot
    changed: DataFrame | None = None
    facts: int = 0
    flags: int = 0


def refresh_facts(wh: Warehouse, snap: Snapshot, source: Mapping[str, DataFrame], ctx: BatchContext) -> Refresh:
    """Bring late bills and discharges into the stored facts.

    Digests of the source tell which blocks of ids changed since the last batch; only those
    are compared with the facts. Changed facts keep their keys. Months that hold one, or a
    stay whose readmission flag follows from a moved discharge, are written again, once.
    """
    before, stored = wh.read("source_digests", snap), snap.paths.get("fact_encounters", ())
    path = wh.write(changes.digests(source), "source_digests", ctx.batch_id)
    state = snap.replaced("source_digests", [path])
    if not stored:
        return Refresh(state)
    blocks = wh.scratch(changes.changed_blocks(wh.read("source_digests", state), before), "changed_blocks", ctx.batch_id)
    ends = blocks.agg(F.min("block").alias("first"), F.max("block").alias("last")).first()
    if ends.first is None:
        return Refresh(state)
    low, high = ends.first << changes.BLOCK_BITS, ((ends.last + 1) << changes.BLOCK_BITS) - 1
    fact = wh.read("fact_encounters", snap)
    changed = wh.scratch(changes.changed_facts(fact, source, blocks, low, high), "changed_facts", ctx.batch_id)
    months = {r.year_month: r["count"] for r in changed.groupBy("year_month").count().collect()}
    if not months:
        return Refresh(state)
    flags = _flags_after(wh, snap, fact, changed, ctx)
    per_month = {} if flags is None else {r.year_month: r["count"] for r in flags.groupBy("year_month").count().collect()}
    paths = _rewrite_months(wh, stored, {*months, *per_month}, flags, changed, ctx, "refresh")
    return Refresh(state.replaced("fact_encounters", paths), changed, sum(months.values()), sum(per_month.values()))


def _flags_after(
    wh: Warehouse, snap: Snapshot, fact: DataFrame, changed: DataFrame, ctx: BatchContext
) -> DataFrame | None:
    """Stored stays whose flag changes with the moved discharges of their patients."""
    kinds = wh.read("dim_encounter_type", snap)
    old, new = F.col("old_discharge_datetime"), F.col("new_discharge_datetime")
    moved = _inpatients(changed.filter(~old.eqNullSafe(new)), kinds)
    span = moved.agg(F.min(F.least(old, new)).alias("first"), F.max(F.greatest(old, new)).alias("last")).first()
    if span.first is None:
        return None
    patients = moved.select("patient_id").distinct()
    stays = _inpatients(fact, kinds).join(patients, "patient_id", "left_semi")
    candidates = facts.until(facts.after(stays, span.first), span.last + REACH)
    now = moved.select("encounter_id", F.lit(True).alias("_moved"), new.alias("_discharged"))
    discharged = F.when(F.col("_moved"), F.col("_discharged")).otherwise(F.col("discharge_datetime"))
    discharges = (
        stays.join(now, "encounter_id", "left")
        .select("patient_id", discharged.alias("discharged"))
        .filter(F.col("discharged") >= cal.moment(span.first - REACH))
    )
    return _changed_flags(wh, candidates, discharges, ctx)


def digest_months(wh: Warehouse, before: Snapshot, snap: Snapshot, ctx: BatchContext) -> Snapshot:
    """Digests of the months this batch wrote, in place of their old ones."""
    fact, old = wh.read("fact_encounters", snap), wh.read("fact_months", before)
    if before.paths.get("fact_months") or not before.paths.get("fact_encounters"):
        months = sorted(wh.months_written(before, snap))
        if not months and before.paths.get("fact_months"):
            return snap
        fact = fact.filter(F.col("year_month").isin(months))  # bounded by the calendar; prunes folders
        old = old.filter(~F.col("year_month").isin(months))
    rows = old.unionByName(changes.month_digests(fact))
    return snap.replaced("fact_months", [wh.write(rows.coalesce(1), "fact_months", ctx.batch_id)])


def load_visits(wh: Warehouse, snap: Snapshot, ctx: BatchContext, load: FactLoad) -> Snapshot:
    """Add the batch's own facts to the kept months; the first time, all facts."""
    if not load.new_paths:
        return snap
    paths = load.new_paths if snap.paths.get("month_visits") else snap.paths["fact_encounters"]
    fresh = wh.read("fact_encounters", Snapshot(0, {"fact_encounters": tuple(paths)}))
    return snap.extended("month_visits", [wh.write(visits.month_visits(fresh), "month_visits", ctx.batch_id)])


def store_checks(wh: Warehouse, snap: Snapshot, ctx: BatchContext, load: FactLoad) -> Snapshot:
    """Keep what was observed of the batch's facts: a row per check."""
    rows = [(ctx.batch_id, check, load.loaded, n) for check, n in load.checks.items()]
    rows.append((ctx.batch_id, "encounter_rejected", load.loaded + load.rejected, load.rejected))
    checks = literal_rows(wh.spark, rows, STATE["batch_checks"]).coalesce(1)
    return snap.extended("batch_checks", [wh.write(checks, "batch_checks", ctx.batch_id)])


# -- bridges and pair summary -------------------------------------------------------


def load_bridges(
    wh: Warehouse, snap: Snapshot, source: Mapping[str, DataFrame], ctx: BatchContext, load: FactLoad
) -> Snapshot:
    if not load.new_paths:
        return snap
    fresh = wh.read("fact_encounters", Snapshot(0, {"fact_encounters": load.new_paths}))
    # The first load takes nearly every line; later ones only those of their own facts.
    first = len(load.new_paths) == len(load.snapshot.paths["fact_encounters"])
    scope = _whole if first else partial(_in_batch, fresh)
    d = bridges.bridge_diagnoses(
        scope(source["encounter_diagnoses"], "encounter_id"), fresh, wh.read("dim_diagnosis", snap), ctx.started_at
    )
    p = bridges.bridge_procedures(
        scope(source["encounter_procedures"], "encounter_id"), fresh, wh.read("dim_procedure", snap), ctx.started_at
    )
    diagnoses, procedures = at_once(
        lambda: wh.write(d, "bridge_encounter_diagnoses", ctx.batch_id),
        lambda: wh.write(p, "bridge_encounter_procedures", ctx.batch_id),
    )
    return snap.extended("bridge_encounter_diagnoses", [diagnoses]).extended(
        "bridge_encounter_procedures", [procedures]
    )


def batch_part(snap: Snapshot, batch_id: int) -> Snapshot:
    """The folders of the bridges that one batch wrote."""
    names = ("bridge_encounter_diagnoses", "bridge_encounter_procedures")
    mine = {t: tuple(p for p in snap.paths.get(t, ()) if f"batch={batch_id}" in p.split("/")) for t in names}
    return Snapshot(batch_id, mine)


def load_pair_summary(
    wh: Warehouse, before: Snapshot, snap: Snapshot, ctx: BatchContext, load: FactLoad, changed: DataFrame | None = None
) -> Snapshot:
    """Add the batch to the kept pair summary; rebuild it if a stored code text changed.

    Changed facts are taken off as they were and added as they are.
    """

    def summary(tables: Snapshot, rows: DataFrame | None = None) -> DataFrame:
        def bridge(table: str) -> DataFrame:
            lines = wh.read(table, tables)
            return lines if rows is None else facts.scoped(lines, rows, "encounter_key")

        return pairs.pair_summary(
            wh.read("fact_encounters", tables) if rows is None else changes.signed(rows),
            bridge("bridge_encounter_diagnoses"),
            bridge("bridge_encounter_procedures"),
            wh.read("dim_diagnosis", tables),
            wh.read("dim_procedure", tables),
        )

    if not before.paths.get("pair_summary"):
        if not load.new_paths:
            return snap
        return snap.replaced("pair_summary", [wh.write(summary(snap), "pair_summary", ctx.batch_id)])

    def renamed(table: str, natural: str, text: list[str]) -> bool:
        if before.paths.get(table) == snap.paths.get(table):
            return False
        diff = pairs.texts_changed(wh.read(table, before), wh.read(table, snap), natural, text)
        return not diff.isEmpty()

    if renamed("dim_diagnosis", "diagnosis_id", pairs.DIAGNOSIS) or renamed(
        "dim_procedure", "procedure_id", pairs.PROCEDURE
    ):
        df = summary(snap)
    elif load.new_paths or changed is not None:
        df = wh.read("pair_summary", snap)
        if changed is not None:
            df = df.unionByName(summary(before, changed))
        if load.new_paths:
            mine = batch_part(snap, ctx.batch_id)
            batch_only = Snapshot(snap.batch_id, {**snap.paths, **mine.paths, "fact_encounters": load.new_paths})
            df = df.unionByName(summary(batch_only))
        df = pairs.merged(df)
    else:
        return snap
    return snap.replaced("pair_summary", [wh.write(df, "pair_summary", ctx.batch_id)])


# -- control ------------------------------------------------------------------------


def next_metadata(
    wh: Warehouse, snap: Snapshot, ctx: BatchContext, watermark: datetime, counts: dict[str, int]
) -> DataFrame:
    """Metadata after this batch: one row per tracked table, keyed by its name.

    The stored time is the start of the batch, so changes made while it ran are seen by
    the next one.
    """
    start = ctx.started_at
    marks = {"fact_encounters": watermark, "dim_patient": start, "dim_provider": start}
    rows = [
        (i, table, start, "SUCCESS", counts[table], mark, start, start)
        for i, (table, mark) in enumerate(marks.items(), 1)
    ]
    new = literal_rows(wh.spark, rows, TARGET["etl_metadata"])
    return upsert(wh.read("etl_metadata", snap), new, "table_name", keep=("metadata_id", "created_at"))


def run_batch(
    wh: Warehouse,
    source: Mapping[str, DataFrame],
    ctx: BatchContext,
    reconcile: bool = True,
    with_dimensions: bool = True,
    lookup: str = "current",
    refresh: bool | None = None,
) -> BatchResult:
    """Load one batch. Nothing becomes visible unless every check passed.

    A strict batch stops at rows that break a check or a key. One that isn't strict loads
    the good rows and puts the others, and further copies of an encounter, into `rejects`.
    reconcile=False when the source holds only new rows (a stream's micro-batch);
    with_dimensions=False keeps the dimensions of the last batch and only extends the
    calendar; lookup="as_of" takes the patient and provider versions valid on the day of
    an encounter instead of the current ones. refresh brings bills and discharges that
    arrived late into the stored facts; it needs the whole source, as reconciling does, and
    is done with it unless told otherwise.
    """
    refresh = reconcile if refresh is None else refresh
    before = wh.snapshot()
    if ctx.batch_id <= before.batch_id:
        raise ValueError(f"batch {ctx.batch_id} is not after batch {before.batch_id}")
    source = checked(source)
    marks = read_marks(wh.read("etl_metadata", before))
    log = StepLog(wh, ctx)
    # Fixed value: the form in which users of the log look for the marks.
    message = f"Encounter Watermark: {marks.encounters} | Timestamp Watermark: {marks.patients}"
    log.record(opened=[BATCH_STEP, DIM_STEP], message=message)
    try:
        if ctx.strict:
            arriving = facts.delta(source["encounters"], None, marks.encounters)
            keys = quality.key_checks({**source, "encounters": arriving})
            quality.require(quality.source_checks(source).unionByName(keys))
        if with_dimensions or not before.paths.get("dim_patient"):
            snap = load_dimensions(wh, before, source, ctx, marks)
        else:
            snap = load_calendar(wh, before, source, ctx, marks)
        live = {t: wh.read(t, snap, "is_current=true").count() for t in ("dim_patient", "dim_provider")}
        log.record({DIM_STEP: live["dim_patient"]}, [FACT_STEP])

        late = refresh_facts(wh, snap, source, ctx) if refresh else Refresh(snap)
        load = load_facts(wh, late.snapshot, source, ctx, marks.encounters, lookup)
        watermark = max(marks.encounters, load.high_watermark or marks.encounters)
        log.record({FACT_STEP: load.loaded}, [BRIDGE_STEP])

        snap = load_bridges(wh, load.snapshot, source, ctx, load)
        snap = load_pair_summary(wh, before, snap, ctx, load, late.changed)
        bridge_rows = wh.read("bridge_encounter_diagnoses", batch_part(snap, ctx.batch_id)).count()

        snap = store_checks(wh, load_visits(wh, snap, ctx, load), ctx, load)
        snap = digest_months(wh, before, snap, ctx)
        if reconcile:
            fact, months = wh.read("fact_encounters", snap), wh.read("fact_months", snap)
            # What refreshing has digested need not be read again.
            totals = (
                quality.reconciliation_of_digests(wh.read("source_digests", snap), months)
                if refresh
                else quality.reconciliation(source["encounters"], source["billing"], fact)
            )
            quality.require_reconciled(
                totals, lambda: _missing_facts(wh, snap, source, fact, months, marks.encounters, load)
            )
        counts = {"fact_encounters": load.loaded, **live}
        metadata = next_metadata(wh, before, ctx, watermark, counts)
        snap = snap.replaced("etl_metadata", [wh.write(metadata, "etl_metadata", ctx.batch_id)])
        snap = wh.publish(snap, ctx.batch_id)
        log.record({BRIDGE_STEP: bridge_rows, BATCH_STEP: load.loaded})
    except Exception as error:
        log.fail(error)
        raise
    return BatchResult(
        snap, marks.encounters, watermark, load.loaded, load.rejected, load.repaired + late.flags, ctx.started_at,
        ctx.clock(), late.facts,
    )


def _missing_facts(
    wh: Warehouse, snap: Snapshot, source: Mapping[str, DataFrame], fact: DataFrame, months: DataFrame,
    watermark: datetime, load: FactLoad,
) -> str:
    """Why the sides may differ: late encounters, the months that differ, rejects by reason."""
    late = facts.late_arrivals(source["encounters"], fact, cal.moment(watermark)).count()
    text = f"late encounters: {late}"
    apart = quality.reconciliation_by_month(source["encounters"], source["billing"], months).filter("status <> 'PASS'")
    names = sorted(str(r[0]) for r in apart.select("encounter_month").collect())  # bounded by the calendar
    text += f"; months that differ: {', '.join(names)}"
    if load.rejected:
        path = snap.paths["rejects"][-1]
        mine = wh.read("rejects", Snapshot(0, {"rejects": (path,)}))
        # One row per reason.
        reasons = sorted((r.reject_reason, r["count"]) for r in mine.groupBy("reject_reason").count().collect())
        text += f"; rejected, in {wh.root}/{path}: " + ", ".join(f"{reason}: {n}" for reason, n in reasons)
    return text


class Star(Mapping):
    """The published star schema by table name; a table is opened when first asked for."""

    def __init__(self, wh: Warehouse, snap: Snapshot | None = None):
        self.wh, self.snap = wh, snap or wh.snapshot()
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._open:
            if table not in TARGET:
                raise KeyError(table)
            log = table == "etl_log"
            self._open[table] = self.wh.log() if log else self.wh.read(table, self.snap)
        return self._open[table]

    def __iter__(self):
        return iter(TARGET)

    def __len__(self) -> int:
        return len(TARGET)
