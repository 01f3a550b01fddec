"""Every registered query against its SQL, over whole tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

from check import compare, connect
from oracles import sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry._star_queries()
SQL = sql.statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql_and_the_reverse():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF_DIR) == ""


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["encounter_month", "specialty_name", "encounter_type", "total_encounters", "unique_patients"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["dim_patient_scd2", "dim_provider_scd2", "scd1_upsert", "fact_as_of_provider"])
def test_a_query_built_twice_leaves_the_first_result_readable(spark, name):
    first, _ = QUERIES[name](spark, SF_DIR), QUERIES[name](spark, SF_DIR)
    assert first.count() > 0


def test_the_entry_works_without_the_training_text_package():
    """As if its folders and the pipeline had been deleted."""
    code = (
        "import sys; sys.modules['wardstar.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and set(e.oracle_sql()) == set(e.queries())"
    )
    root = Path(entry.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
