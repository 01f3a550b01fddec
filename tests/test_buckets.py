"""Dimensions with history that rewrite only the buckets of changed keys, and long histories."""

from datetime import date, timedelta

from conftest import OLD, day, ts, tuples

from wardstar.operators import facts
from wardstar.plans.batch import Star, run_batch
from wardstar.sources import warehouse as stored
from wardstar.sources.warehouse import Snapshot, bucket_of, buckets_for
from pyspark.sql import functions as F


def people(n, changed=(), extra=0):
    later = ts("2024-07-01 12:00:00")
    return [
        (1001 + i, "Una", "Reed-R" if i in changed else "Reed", day("1955-03-15"), "M", f"R-{i}", later if i in changed else OLD)
        for i in range(n + extra)
    ]


def test_one_changed_patient_rewrites_one_bucket(sample, warehouse, batch, spark, monkeypatch):
    monkeypatch.setattr(stored, "BUCKET_ROWS", 8)
    run_batch(warehouse, sample(patients=people(60)), batch(1))
    first = warehouse.snapshot().paths["dim_patient"]
    assert len(first) == 8 and all("/buckets=8/" in p for p in first)
    run_batch(warehouse, sample(patients=people(60, changed={17})), batch(2))
    second = warehouse.snapshot().paths["dim_patient"]
    live = [p for p in second if "is_current=true" in p]
    assert len(set(live) - set(first)) == 1 and len(set(first) - set(live)) == 1
    assert [p for p in second if "is_current=false" in p and "batch=2" in p] and len(second) == 9
    key = spark.range(1018, 1019).select(bucket_of(F.col("id"), 8).alias("b")).first().b
    assert (set(live) - set(first)).pop().endswith(f"/bucket={key}")

    # The same versions as in a warehouse without buckets.
    monkeypatch.setattr(stored, "BUCKET_ROWS", 1 << 18)
    other = type(warehouse)(spark, warehouse.root + "-plain")
    run_batch(other, sample(patients=people(60)), batch(1))
    run_batch(other, sample(patients=people(60, changed={17})), batch(2))
    assert tuples(Star(warehouse)["dim_patient"]) == tuples(Star(other)["dim_patient"])
    assert Star(warehouse)["dim_patient"].filter("patient_id = 1018").count() == 2

    # A new key goes to its own bucket too, and closes nothing.
    run_batch(warehouse, sample(patients=people(60, changed={17}, extra=1)), batch(3))
    third = warehouse.snapshot().paths["dim_patient"]
    assert len([p for p in third if "batch=3" in p]) == 1
    assert Star(warehouse)["dim_patient"].filter("is_current").count() == 61


def test_folders_from_before_there_were_buckets_are_taken_over(sample, warehouse, batch, spark):
    run_batch(warehouse, sample(), batch(1))
    snap = warehouse.snapshot()
    old = warehouse.write(warehouse.read("dim_patient", snap), "dim_patient", 1, "is_current=true", label="old")
    warehouse.publish(snap.replaced("dim_patient", [old]), 1, revision=1)
    later = ts("2024-07-01 12:00:00")
    patients = [(1001, "Una", "Reed-R", day("1955-03-15"), "M", "R-1", later), *[r for r in people(3)[1:]]]
    patients = [*patients[:1], (1002, "Viv", "Stone", day("1962-07-22"), "F", "R-2", OLD), (1003, "Wil", "Ford", day("1948-11-08"), "M", "R-3", OLD)]
    run_batch(warehouse, sample(patients=patients), batch(2))
    rows = tuples(Star(warehouse)["dim_patient"], "patient_key", "last_name", "is_current")
    assert rows == [(1, "Reed", False), (2, "Stone", True), (3, "Ford", True), (4, "Reed-R", True)]


def test_number_of_buckets_follows_the_rows():
    assert [buckets_for(n) for n in (0, 1, 1 << 18, (1 << 18) + 1, 3 << 18)] == [1, 1, 1, 2, 4]


def test_a_long_history_gives_each_row_one_version(spark):
    start = date(2020, 1, 1)
    versions = [(1, 100 + i, start + timedelta(i), start + timedelta(i + 1)) for i in range(1_000)]
    versions += [(2, 5, start, start + timedelta(10)), (2, 6, start + timedelta(20), date(9999, 12, 31))]
    versions += [(3, 7, start, start), (3, 8, start, date(9999, 12, 31))]  # replaced on its first day
    v = spark.createDataFrame(versions, "provider_id long, provider_key long, effective_date date, expiration_date date")
    asked = [(n, 1, start + timedelta(n % 1_000)) for n in range(3_000)]
    asked += [(9_000 + n, 2, start + timedelta(n)) for n in (-1, 0, 9, 10, 19, 20, 400)]
    asked += [(9_500, 3, start), (9_501, 4, start), (9_502, None, start), (9_503, 1, None)]
    rows = spark.createDataFrame(asked, "encounter_id long, provider_id long, _day date")
    got = {r.encounter_id: r.provider_key for r in facts._as_of(rows, v, "provider_id").collect()}

    def plain(key, at):
        return next((k for p, k, a, b in versions if p == key and at is not None and a <= at < b), None)

    assert facts._as_of(rows, v, "provider_id").count() == len(asked)
    assert got == {n: plain(key, at) for n, key, at in asked}
