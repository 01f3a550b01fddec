"""What is broadcast is small in memory, however small its files are."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardstar.operators import bridges, facts
from wardstar.operators.keys import assign_keys
from wardstar.session import tune
from wardstar.sources.warehouse import Snapshot

from conftest import ts, tuples


@pytest.fixture
def limit(spark):
    """Set the size up to which Spark broadcasts."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    tune(spark)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.unset(name)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(warehouse, df, table):
    return warehouse.read(table, Snapshot(0, {table: (warehouse.write(df.coalesce(1), table, 1),)}))


def test_many_stored_ids_are_not_broadcast_for_their_small_files(spark, sample, warehouse, limit):
    ids = _stored(warehouse, spark.range(200_000).select(F.col("id").alias("encounter_id")), "fact_ids")
    arriving = warehouse.scratch(sample()["encounters"], "arriving", 1)
    limit("1m")  # the files have some 0.2 MB, the rows 3.2 MB
    new = facts.delta(arriving, ids, datetime(1900, 1, 1), strict=False)
    text = _plan(new)
    assert re.search(r"SortMergeJoin \[encounter_id#\d+L\], \[encounter_id#\d+L\], LeftAnti", text)
    assert not re.search("BroadcastHashJoin[^\n]*LeftAnti", text)
    assert new.count() == 0


def test_few_stored_ids_are_still_broadcast(spark, sample, warehouse, limit):
    ids = _stored(warehouse, spark.range(100).select(F.col("id").alias("encounter_id")), "fact_ids")
    arriving = warehouse.scratch(sample()["encounters"], "arriving", 1)
    limit("1m")
    new = facts.delta(arriving, ids, datetime(1900, 1, 1), strict=False)
    assert "SortMergeJoin" not in _plan(new)
    assert new.count() == 4


def test_many_dimension_keys_are_not_broadcast_for_their_small_files(spark, warehouse, limit):
    key = F.col("id")
    dim = spark.range(100_000).select(
        (key + 1).alias("diagnosis_key"),
        key.alias("diagnosis_id"),
        F.concat(F.lit("I"), key % 50).alias("icd10_code"),
        F.concat(F.lit("Finding "), key % 50).alias("icd10_description"),
        F.lit("Other").alias("icd10_category"),
    )
    dim = _stored(warehouse, dim, "dim_diagnosis")
    lines = spark.createDataFrame([(7, 50, 3), (7, 50, 2)], "encounter_id bigint, diagnosis_id bigint, diagnosis_sequence int")
    fact = spark.createDataFrame(
        [(7, 1, ts("2024-01-01 23:00:00"))], "encounter_id bigint, encounter_key bigint, encounter_datetime timestamp_ntz"
    )
    limit("256k")  # two of five columns are taken for a fraction of the files, their rows have 2.4 MB
    got = bridges.bridge_diagnoses(lines, fact, dim, datetime(2024, 7, 1))
    assert not re.search(r"BroadcastHashJoin \[diagnosis_id#\d+L\][^\n]*BuildRight", _plan(got))
    assert tuples(got, "encounter_key", "diagnosis_key", "diagnosis_sequence") == [(1, 51, 2)]


def test_rows_to_be_ranked_are_never_broadcast_to_their_offsets(spark, limit):
    rows = spark.range(20).select((F.col("id") * 3).alias("n"))
    got = assign_keys(rows, "k", F.col("n"), 10, levels=(2, 4))
    text = _plan(got)
    assert re.search(r"SortMergeJoin \[_block#\d+L\], \[_block#\d+L\]", text)
    assert not re.search(r"BroadcastHashJoin \[_block#", text)
    assert tuples(got, "n", "k") == sorted(((3 * i, 11 + i) for i in range(20)), key=repr)
