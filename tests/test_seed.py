"""Known totals of the 13,200-encounter data set, loaded in two real batches."""

import pytest
from pyspark.sql import functions as F

from wardstar.operators.quality import QualityError
from wardstar.plans import questions as q
from wardstar.plans.batch import Star, run_batch

from seed import seed


@pytest.fixture(scope="module")
def loaded(spark):
    import uuid

    from wardstar.context import BatchContext, ticking_clock
    from wardstar.session import shared_dir
    from wardstar.sources.warehouse import Warehouse
    from datetime import date, datetime

    def ctx(n, strict):
        start = datetime(2026, 1, n, 2)
        return BatchContext(n, date(2026, 1, n), start, strict, ticking_clock(start))

    wh = Warehouse(spark, f"{shared_dir(spark)}/tests/{uuid.uuid4().hex}")
    first = run_batch(wh, seed(spark, False), ctx(1, True))
    whole = seed(spark, True)
    # Readmissions reach into 2025, so some of the increment is late for a strict load.
    with pytest.raises(QualityError, match="row count"):
        run_batch(wh, whole, ctx(2, True))
    second = run_batch(wh, whole, ctx(3, False))
    return first, second, Star(wh), whole


def test_counts(loaded):
    first, second, star, source = loaded
    assert (first.new_encounters, second.new_encounters) == (10200, 3000)
    fact = star["fact_encounters"]
    assert fact.count() == fact.select("encounter_id").distinct().count() == 13200
    assert fact.select("encounter_key").distinct().count() == 13200
    assert fact.filter("is_readmission").count() == 200
    assert source["encounters"].filter("encounter_type = 'Inpatient'").count() == 4533
    assert source["billing"].filter("claim_status = 'Paid'").count() == 9240


def test_question_groups(loaded):
    _, _, star, source = loaded
    star_groups, source_groups = q.monthly_encounters_star(star), q.monthly_encounters_source(source)
    assert star_groups.count() == source_groups.count() == 1440
    assert q.revenue_star(star).count() == 480
    pairs = q.stored_pairs(star)
    assert pairs.count() == q.pairs_source(source).count() == 592
    assert pairs.filter("encounter_count = 66").count() == 192
    assert pairs.agg(F.max("encounter_count")).first()[0] >= 66


def test_both_readmission_forms_agree_on_this_data(loaded):
    _, _, star, source = loaded
    for rows in (q.readmission_rate_star(star), q.readmission_rate_source(source)):
        got = rows.collect()
        assert [r.readmissions_within_30days for r in got] == [10] * 20
        assert sum(r.total_discharges for r in got) == 4533
