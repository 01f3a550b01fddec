"""What a load moves and writes: narrow rows, each as seldom as its joins allow."""

import re
from datetime import datetime
from pathlib import Path

import pytest

from wardstar.operators import bridges, dims, facts
from wardstar.operators.keys import assign_keys
from wardstar.plans.batch import Star, run_batch

from conftest import day, ts, tuples
from pyspark.sql import functions as F

LOADED = datetime(2024, 7, 1)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _staged(spark, source):
    """Staged encounters of a source against its own dimensions."""
    source_dims = (
        dims.dim_date(dims.calendar_range(source["encounters"])),
        dims.dim_patient(source["patients"], day("2024-07-01"), datetime(1900, 1, 1)).current,
        dims.dim_provider(
            source["providers"], source["specialties"], source["departments"], day("2024-07-01"), datetime(1900, 1, 1)
        ).current,
        dims.dim_specialty(source["specialties"]),
        dims.dim_department(source["departments"]),
        dims.dim_encounter_type(spark),
    )
    lines = [source[t] for t in ("encounter_diagnoses", "encounter_procedures", "billing")]
    meet = lambda rows: facts.join_measures(rows, *lines)
    return facts.finish_staged(facts.lookup_keys(source["encounters"], *source_dims, meet=meet))


def test_keys_of_small_lookups_are_not_shuffled_by_encounter(spark, sample, no_broadcast):
    text = _plan(_staged(spark, sample()))
    # Printed from the last step to the first: the calendar is met after the encounters' own lines.
    assert text.index("Exchange hashpartitioning(_day") < text.index("Exchange hashpartitioning(encounter_id")


def test_staged_encounters_keep_measures_and_reasons_of_both_kinds(spark, sample):
    more = [
        (7005, 9999, 101, "ER", ts("2024-06-20 10:00:00"), ts("2024-06-19 10:00:00"), 1),
        (7006, 1002, 101, "ER", ts("2024-06-20 10:00:00"), ts("2024-06-19 10:00:00"), 1),
        (7006, 1002, 101, "ER", ts("2024-06-20 10:00:00"), None, 1),
        (None, 1002, 101, "ER", ts("2024-06-20 10:00:00"), None, 1),
    ]
    got = _staged(spark, sample(extra={"encounters": more}))
    assert not {"encounter_type", "department_id"} & set(got.columns)
    assert tuples(got, "encounter_id", "diagnosis_count", "procedure_count", "has_billing", "reject_reason") == sorted(
        [
            (7001, 2, 2, True, None), (7002, 2, 1, True, None), (7003, 1, 1, False, None), (7004, 1, 0, False, None),
            (7005, 0, 0, False, "unknown patient"), (7006, 0, 0, False, "discharge before admission"),
            (7006, 0, 0, False, None), (None, 0, 0, False, None),
        ],
        key=repr,
    )


def test_diagnosis_lines_go_to_their_encounter_with_the_key_alone(spark, no_broadcast):
    lines = spark.createDataFrame([(7, 50, 3), (7, 50, 2)], "encounter_id bigint, diagnosis_id bigint, diagnosis_sequence int")
    fact = spark.createDataFrame(
        [(7, 1, datetime(2024, 1, 1, 23))], "encounter_id bigint, encounter_key bigint, encounter_datetime timestamp_ntz"
    )
    # An id that the dimension holds twice has two keys and two rows.
    dim = spark.createDataFrame([(50, 5), (50, 6)], "diagnosis_id bigint, diagnosis_key bigint")
    got = bridges.bridge_diagnoses(lines, fact, dim, LOADED)
    moved = re.findall(r"Exchange hashpartitioning\(encounter_id[^\n]*\n[^\n]*Project \[([^]]*)\]", _plan(got))
    assert moved and not any("diagnosis_id" in columns for columns in moved)
    assert tuples(got, "encounter_key", "diagnosis_key", "diagnosis_sequence") == [(1, 5, 2), (1, 6, 2)]


def test_ranked_rows_are_in_place_for_the_offset_of_their_block(spark, no_broadcast):
    rows = spark.range(20).select((F.col("id") * 3).alias("n"))
    got = assign_keys(rows, "k", F.col("n"), 10, levels=(2, 4))
    # The rows once, for window and join; three for the counts of blocks, three for those of larger blocks.
    assert _plan(got).count("Exchange hashpartitioning") == 7
    assert tuples(got, "n", "k") == sorted(((3 * i, 11 + i) for i in range(20)), key=repr)


def test_written_tables_are_compressed_well(spark, sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    files = [f.as_posix() for f in Path(warehouse.root).rglob("*.parquet")]
    wide = [f for f in files if "/fact_encounters/" in f or "/dim_patient/" in f or "/_scratch/" in f]
    assert wide and all(f.endswith(".zstd.parquet") for f in wide)
    assert Star(warehouse)["fact_encounters"].count() == 4
