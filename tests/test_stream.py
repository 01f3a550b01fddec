from datetime import datetime

from wardstar.context import ticking_clock
from wardstar.plans.batch import Star
from wardstar.streaming.ingest import load_available

from conftest import ts, tuples


def test_files_are_loaded_once_and_late_ones_repair_flags(sample, warehouse):
    stays = [
        (1, 1003, 103, "Inpatient", ts("2024-06-20 08:00:00"), ts("2024-06-22 08:00:00"), 3),
        (2, 1003, 103, "Inpatient", ts("2024-06-01 08:00:00"), ts("2024-06-05 08:00:00"), 3),
    ]
    src = sample(encounters=stays)
    tables = {k: v for k, v in src.items() if k != "encounters"}
    landing, start = f"{warehouse.root}/landing", datetime(2024, 7, 1)

    def arrive(rows):
        sample(encounters=rows)["encounters"].write.mode("append").parquet(landing)

    def load():
        load_available(
            warehouse, tables, landing, f"{warehouse.root}/cp", started_at=lambda: start, clock=ticking_clock(start)
        )

    arrive(stays[:1])
    load()
    assert tuples(Star(warehouse)["fact_encounters"], "encounter_id", "is_readmission") == [(1, False)]
    load()  # nothing new
    assert warehouse.snapshot().batch_id == 1
    arrive(stays[1:])
    load()
    assert tuples(Star(warehouse)["fact_encounters"], "encounter_id", "is_readmission") == [(1, True), (2, False)]
    assert warehouse.snapshot().batch_id == 2


def test_replayed_epoch_does_nothing(sample, warehouse, batch):
    from wardstar.plans.batch import run_batch

    src = sample()
    run_batch(warehouse, src, batch(1))
    landing = f"{warehouse.root}/landing"
    src["encounters"].write.parquet(landing)
    tables = {k: v for k, v in src.items() if k != "encounters"}
    # Epoch 0 of a fresh checkpoint is batch 1, which is already published.
    load_available(warehouse, tables, landing, f"{warehouse.root}/cp")
    assert warehouse.snapshot().batch_id == 1 and Star(warehouse)["fact_encounters"].count() == 4


def test_rows_are_reduced_to_one_per_id_only_where_ids_are_named_twice(sample, warehouse, batch, monkeypatch):
    from wardstar.operators import facts
    from wardstar.plans.batch import run_batch

    reduced, plain = [], facts.one_per_encounter

    def seen(rows):
        kept, copies = plain(rows)
        reduced.append(kept)
        return kept.filter("false"), copies  # the wide rows of an id, if they are asked for, are gone

    monkeypatch.setattr(facts, "one_per_encounter", seen)
    src = sample()
    run_batch(warehouse, src, batch(1, strict=False), reconcile=False)
    star = Star(warehouse)
    assert reduced and star["fact_encounters"].count() == src["encounters"].count()
    assert "rejects" not in warehouse.snapshot().paths
