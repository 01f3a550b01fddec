"""Properties of physical plans that matter beyond the test data's size."""

import re

import pytest

import __spark_entry__ as entry
from wardstar.operators import facts
from wardstar.operators.keys import max_key, max_key_by_statistics
from wardstar.plans import questions, scenario
from wardstar.sources import order_view as ov

SF_DIR = "/root/testdata/sf0.001"
# Their result is stored by a stream; the loads inside are covered by the other queries.
BATCHES = [n for n in entry._star_queries() if not n.startswith("stream")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", BATCHES)
def test_every_join_has_a_key_and_no_python_runs(spark, no_broadcast, name):
    """With broadcasts off, each join must still be possible as a shuffle on keys."""
    text = plan(entry._star_queries()[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BroadcastHashJoin|EvalPython|InPandas|MapInArrow", text)


def test_no_job_runs_while_a_query_over_views_is_built(spark):
    views = dict(ov.clinical_views(spark, SF_DIR))  # opening a table reads its footer
    context = spark.sparkContext
    context.setJobGroup("building", "queries are only built")
    for make in (questions.monthly_encounters_source, questions.pairs_source, questions.revenue_source):
        make(views)
    context.setJobGroup("running", "one is run")
    questions.revenue_source(views).count()
    tracker = context.statusTracker()
    assert tracker.getJobIdsForGroup("running") and not tracker.getJobIdsForGroup("building")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_watermark_and_month_reach_the_scans(spark):
    star = scenario.full_load(spark, SF_DIR).star
    text = plan(facts.after(star["fact_encounters"], ov.SPLIT_AT).select("encounter_id"))
    assert "GreaterThan(encounter_datetime,2000-06-30T00:00)" in text
    assert re.search(r"PartitionFilters: \[[^]]*year_month#\d+ >= 2000-06", text)


def test_questions_read_only_their_columns(spark):
    text = plan(entry._star_queries()["q4_star"](spark, SF_DIR))
    scans = [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^]]*)\]", text)]
    fact = next(s for s in scans if "total_allowed_amount" in s)
    folders = {"batch", "part", "year_month"}
    assert fact - folders == {"encounter_key", "specialty_key", "total_allowed_amount", "has_billing"}
    assert "EqualTo(has_billing,true)" in text


def test_highest_key_from_statistics_equals_the_plain_maximum(spark):
    for keys in ([], [1, 2, 3], [5], [1, 9, 4]):
        df = spark.createDataFrame([(k,) for k in keys], "k bigint")
        assert max_key_by_statistics(df, "k") == max_key(df, "k")
