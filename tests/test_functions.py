from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from wardstar.functions import calendar as cal
from wardstar.functions import clinical, money


def test_week_counts_from_the_year_start_and_never_rolls_over(spark):
    days = [date(2015, 1, 1) + timedelta(days=i) for i in range(16 * 366)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", cal.week_of_year(F.col("d")).alias("w")).collect()}
    for d in days:
        first = date(d.year, 1, 1)
        # Week 1 starts on the Monday of the first week with at least four days of the year.
        monday = first - timedelta(days=first.weekday())
        start = monday if first.weekday() <= 3 else monday + timedelta(days=7)
        assert got[d] == (d - start).days // 7 + 1, d
    assert got[date(2024, 12, 30)] == 53
    assert got[date(2027, 1, 1)] == 0


def test_ages_of_leap_day_births(spark):
    df = spark.createDataFrame([(date(2000, 2, 29),)], "b date")

    def age(on):
        return df.select(clinical.age_years(F.col("b"), on)).first()[0]

    assert age(date(2023, 2, 28)) == 22
    assert age(date(2023, 3, 1)) == 23
    assert age(date(2024, 2, 29)) == 24


def test_age_groups_at_their_bounds_and_unknown_age(spark):
    ages = [0, 17, 18, 34, 35, 54, 55, 74, 75, 120, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a int")
    got = [r.g for r in df.orderBy("i").select(clinical.age_group(F.col("a")).alias("g")).collect()]
    assert got == ["0-17", "0-17", "18-34", "18-34", "35-54", "35-54", "55-74", "55-74", "75+", "75+", "75+"]


def test_classification_ignores_case_and_takes_the_first_match(spark):
    df = spark.createDataFrame(
        [("Surgical ICU",), ("outpatient clinic",), ("EMERGENCY",), ("Surgical Suite",), ("Lab",), (None,)], "n string"
    )
    got = [r[0] for r in df.select(clinical.department_type(F.col("n"))).collect()]
    # "Outpatient" contains no "Inpatient", so the clinic is an outpatient department.
    assert got == ["Inpatient", "Outpatient", "ER", "Surgical", "Other", "Other"]
    codes = spark.createDataFrame([("surg",), ("RAD",), ("CARD",), (None,)], "c string")
    got = [r[0] for r in codes.select(clinical.specialty_category(F.col("c"))).collect()]
    assert got == ["Surgical", "Diagnostic/Support", "Medical", "Medical"]
    cpt = spark.createDataFrame([("99213",), ("93000",), ("71020",), ("80053",), ("36415",)], "c string")
    got = [r[0] for r in cpt.select(clinical.procedure_category(F.col("c"))).collect()]
    assert got == ["Evaluation & Management", "Medicine", "Radiology", "Laboratory", "Procedure"]


def test_full_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(clinical.full_name(F.col("f"), F.col("l"))).collect()] == ["A B", None]


def test_ratios_round_half_up_in_decimals(spark):
    df = spark.createDataFrame([(1005, 100000), (1, 3), (1, 800), (0, 5)], "p bigint, n bigint")
    got = [r[0] for r in df.select(money.percent(F.col("p"), F.col("n"))).collect()]
    assert got == [Decimal("1.01"), Decimal("33.33"), Decimal("0.13"), Decimal("0.00")]
    sums = spark.createDataFrame([(Decimal("1.01"), 2), (Decimal("5.00"), 0)], "t decimal(12,2), n bigint")
    got = [r[0] for r in sums.select(money.mean(F.col("t"), F.col("n"), 2)).collect()]
    assert got == [Decimal("0.51"), None]


def test_weekend_numbers(spark):
    df = spark.createDataFrame([(date(2024, 6, 1),), (date(2024, 6, 2),), (date(2024, 6, 3),)], "d date")
    assert [r[0] for r in df.select(cal.is_weekend(F.col("d"))).collect()] == [True, True, False]
    assert datetime(2024, 6, 1).weekday() == 5
