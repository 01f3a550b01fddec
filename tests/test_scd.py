from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardstar.context import FIRST_WATERMARK
from wardstar.operators import dims
from wardstar.operators.keys import LEVELS, assign_keys, max_key
from wardstar.operators.scd import insert_ignore, upsert, upsert_scd1

from conftest import day, tuples


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "start date, end date")



@pytest.mark.parametrize("levels", [(0,), (1, 3), (6, 20, 40), LEVELS])
def test_keys_are_the_rank_of_the_natural_key_for_any_blocks(spark, levels):
    dense = [7, -5, 0, 100, 3, 4, 1_000_003, 2]
    sparse = [hash((i, "x")) for i in range(40)] + [-(2**63), 2**63 - 1]
    for ids in (dense, sparse):
        df = spark.createDataFrame([(i,) for i in ids], "id bigint")
        got = {r.id: r.k for r in assign_keys(df, "k", F.col("id"), 10, levels).collect()}
        assert got == {i: 11 + n for n, i in enumerate(sorted(ids))}


def test_the_last_window_over_blocks_is_small_however_sparse_the_keys_are():
    bits = (0, *LEVELS, 64)
    assert max(b - a for a, b in zip(bits, bits[1:])) <= 22


def test_max_key_of_nothing_is_zero(spark):
    assert max_key(None, "k") == 0
    assert max_key(spark.createDataFrame([], "k bigint"), "k") == 0


def test_insert_ignore_keeps_the_target_and_the_first_new_row(spark):
    target = spark.createDataFrame([(1, 9, "old")], "k int, o int, v string")
    new = spark.createDataFrame([(1, 1, "new"), (2, 5, "late"), (2, 4, "b"), (2, 4, "a")], "k int, o int, v string")
    assert tuples(insert_ignore(target, new, ["k"], ["o"])) == [(1, 9, "old"), (2, 4, "a")]


def test_upsert_overwrites_adds_and_deletes_nothing(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, keep int, v int")
    new = spark.createDataFrame([("b", 99, None), ("c", 3, 30)], "k string, keep int, v int")
    assert tuples(upsert(target, new, "k", keep=("keep",))) == [("a", 1, 10), ("b", 2, None), ("c", 3, 30)]


def test_scd1_keeps_keys_and_numbers_new_rows_after_them(spark):
    first = spark.createDataFrame([(5, "x"), (2, "y")], "id bigint, v string")
    one = upsert_scd1(None, first, "id", "k")
    assert tuples(one, "k", "id", "v") == [(1, 2, "y"), (2, 5, "x")]
    second = spark.createDataFrame([(5, "X"), (1, "z")], "id bigint, v string")
    two = upsert_scd1(one, second, "id", "k")
    assert tuples(two, "k", "id", "v") == [(1, 2, "y"), (2, 5, "X"), (3, 1, "z")]


def _patients(spark, rows):
    return spark.createDataFrame(
        rows,
        "patient_id bigint, first_name string, last_name string, date_of_birth date, gender string, "
        "mrn string, last_update timestamp_ntz",
    )


def test_scd2_closes_changed_rows_and_a_second_run_adds_nothing(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 6, 1)
    one = _patients(spark, [(1, "A", "B", day("1990-01-01"), "F", "m1", old), (2, "C", "D", None, "M", "m2", old)])
    first = dims.dim_patient(one, date(2024, 2, 1), FIRST_WATERMARK)
    assert tuples(first.current, "patient_key", "patient_id", "age_group", "is_current") == [
        (1, 1, "18-34", True),
        (2, 2, "75+", True),
    ]
    history = first.current.filter("NOT is_current")
    two = _patients(
        spark,
        [
            (1, "A", "Z", day("1990-01-01"), "F", "m1", new),
            (2, "C", "D", None, "M", "m2", old),
            (3, "E", "F", day("2020-01-01"), "F", "m3", new),
        ],
    )
    # The same change seen twice on the same day: the second run starts after the first.
    second = dims.dim_patient(two, date(2024, 7, 1), datetime(2024, 2, 1), first.current, history)
    columns = ("patient_key", "patient_id", "last_name", "effective_date", "expiration_date", "is_current")
    end = date(9999, 12, 31)
    assert tuples(second.all_with(history), *columns) == sorted(
        [
            (1, 1, "B", date(2024, 2, 1), date(2024, 7, 1), False),
            (2, 2, "D", date(2024, 2, 1), end, True),
            (3, 1, "Z", date(2024, 7, 1), end, True),
            (4, 3, "F", date(2024, 7, 1), end, True),
        ],
        key=repr,
    )
    again = dims.dim_patient(two, date(2024, 7, 1), datetime(2024, 7, 1), second.current, second.expired)
    assert again.expired.count() == 0
    assert tuples(again.current, *columns) == tuples(second.current, *columns)


def test_scd2_changed_row_without_a_current_version_is_not_added_twice(spark):
    now = datetime(2024, 6, 1)
    src = _patients(spark, [(1, "A", "B", None, "F", "m1", now)])
    first = dims.dim_patient(src, date(2024, 6, 1), FIRST_WATERMARK)
    # The only version is closed; the key is known, so neither step 2 nor step 3 takes it.
    closed = first.current.withColumn("is_current", F.lit(False))
    step = dims.dim_patient(src, date(2024, 6, 2), datetime(2024, 1, 1), first.current.limit(0), closed)
    assert step.current.count() == 0 and step.expired.count() == 0


def test_calendar_extends_and_keeps_keys(spark):
    one = dims.dim_date(bounds(spark, date(2023, 12, 30), date(2024, 1, 2)))
    assert tuples(one, "date_key", "calendar_date", "week_of_year", "day_name") == [
        (1, date(2023, 12, 30), 52, "Saturday"),
        (2, date(2023, 12, 31), 52, "Sunday"),
        (3, date(2024, 1, 1), 1, "Monday"),
        (4, date(2024, 1, 2), 1, "Tuesday"),
    ]
    two = dims.dim_date(bounds(spark, date(2023, 12, 29), date(2024, 1, 3)), one)
    assert tuples(two, "date_key", "calendar_date") == [
        (1, date(2023, 12, 30)),
        (2, date(2023, 12, 31)),
        (3, date(2024, 1, 1)),
        (4, date(2024, 1, 2)),
        (5, date(2023, 12, 29)),
        (6, date(2024, 1, 3)),
    ]


def test_three_year_calendar_has_1096_days(spark):
    days = dims.calendar_days(bounds(spark, date(2024, 1, 1), date(2026, 12, 31)))
    assert days.count() == 1096


def test_provider_without_specialty_or_department_gets_fallbacks(spark, sample):
    src = sample(extra={"providers": [(104, "No", "One", "MD", None, None, datetime(2024, 1, 1))]})
    rows = dims.provider_attrs(src["providers"], src["specialties"], src["departments"])
    row = rows.filter("provider_id = 104").first()
    assert (row.specialty_code, row.specialty_category, row.department_type) == (None, "Medical", "Other")


def test_encounter_types_keep_their_listed_order(spark):
    one = dims.dim_encounter_type(spark)
    expected = [(1, "Outpatient", 0), (2, "Inpatient", 5), (3, "ER", 1)]
    assert tuples(one, "encounter_type_key", "encounter_type", "expected_los_days") == expected
    assert tuples(dims.dim_encounter_type(spark, one), "encounter_type_key", "encounter_type", "expected_los_days") == expected
