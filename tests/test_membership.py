"""The list of stored ids that a loose batch asks in place of the facts."""

from conftest import ts, tuples

from wardstar.operators import facts
from wardstar.plans import batch as plans
from wardstar.plans.batch import Star, run_batch
from wardstar.sources.warehouse import Snapshot


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "encounter_id long")


def test_ranges_hold_all_ids_and_leave_gaps_out(spark):
    assert facts.id_ranges(ids(spark, [])) == []
    assert facts.id_ranges(ids(spark, [7, None, 7])) == [(7, 7)]
    assert facts.id_ranges(ids(spark, [1, 2, 1_000_000]), most=10) == [(1, 100_000), (900_001, 1_000_000)]
    values = [3, 50, 51, 52, 900, -40]
    ranges = facts.id_ranges(ids(spark, values))
    assert all(any(a <= v <= b for a, b in ranges) for v in values)
    assert all(b < c - 1 for (_, b), (c, _) in zip(ranges, ranges[1:]))
    assert sum(b - a + 1 for a, b in ranges) < 120


def test_row_groups_outside_the_ranges_are_not_read(spark, warehouse):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = warehouse.write_ids(spark.range(100_000).toDF("encounter_id").repartition(7), 1)
        stored = warehouse.read("fact_ids", Snapshot(1, {"fact_ids": (path,)}))
        found = facts.known_ids(stored, ids(spark, [5, 9, 99_990]))
        assert sorted(r[0] for r in found.collect() if r[0] in (5, 9, 99_990)) == [5, 9, 99_990]
        execution = found._jdf.queryExecution()
        assert "PushedFilters: [Or(And(GreaterThanOrEqual(encounter_id,5)" in execution.toString()
        plan = execution.executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        assert 0 < plan.metrics().get("numOutputRows").get().value() <= 70_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_loose_delta_reads_no_fact(sample, warehouse, batch, monkeypatch):
    run_batch(warehouse, sample(), batch(1))
    asked = []

    def delta(rows, loaded, *rest):
        if loaded is not None:
            asked.extend(loaded.inputFiles())
        return facts_delta(rows, loaded, *rest)

    facts_delta = facts.delta
    monkeypatch.setattr(plans.facts, "delta", delta)
    late = (7006, 1003, 103, "ER", ts("2024-01-20 08:00:00"), ts("2024-01-20 09:00:00"), 3)
    result = run_batch(warehouse, sample(extra={"encounters": [late]}), batch(2, strict=False))
    assert result.new_encounters == 1
    assert asked and all("/fact_ids/" in f for f in asked)
    listed = warehouse.read("fact_ids", warehouse.snapshot())
    assert tuples(listed) == tuples(Star(warehouse)["fact_encounters"], "encounter_id")


def test_a_missing_list_is_made_from_the_stored_facts(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    snap = warehouse.snapshot()
    warehouse.publish(snap.replaced("fact_ids", []), 1, revision=1)
    late = (7006, 1003, 103, "ER", ts("2024-01-20 08:00:00"), ts("2024-01-20 09:00:00"), 3)
    run_batch(warehouse, sample(extra={"encounters": [late]}), batch(2, strict=False))
    listed = warehouse.read("fact_ids", warehouse.snapshot())
    assert tuples(listed) == [(i,) for i in (7001, 7002, 7003, 7004, 7006)]
    assert warehouse.compact().paths["fact_ids"]
