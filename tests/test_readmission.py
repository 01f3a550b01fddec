import random
from datetime import datetime, timedelta

from wardstar.operators import readmission

from conftest import ts, tuples


def _frames(spark, stays):
    rows = [(i, *s) for i, s in enumerate(stays)]
    df = spark.createDataFrame(
        rows, "encounter_id int, patient_id int, admitted timestamp_ntz, discharged timestamp_ntz, spec string"
    )
    return df.select("encounter_id", "patient_id", "admitted"), df.select("patient_id", "discharged", "spec")


def _follows(admitted, discharged) -> bool:
    return (
        discharged is not None
        and admitted > discharged
        and (admitted.date() - discharged.date()).days <= 30
    )


def _flags(spark, stays):
    a, d = _frames(spark, stays)
    return {r[0] for r in readmission.readmitted(a, d.drop("spec")).collect()}


def test_bounds_of_the_window(spark):
    out = ts("2024-01-10 12:00:00")
    base = (1, ts("2024-01-08 00:00:00"), out, "A")
    day30 = (1, ts("2024-02-09 23:59:00"), None, "A")
    assert _flags(spark, [base, day30]) == {1}
    assert _flags(spark, [base, (1, ts("2024-02-10 00:00:00"), None, "A")]) == set()
    assert _flags(spark, [base, (1, out, None, "A")]) == set()  # the same instant
    assert _flags(spark, [base, (1, ts("2024-01-10 12:00:01"), None, "A")]) == {1}
    assert _flags(spark, [base, (1, ts("2024-01-10 11:59:00"), None, "A")]) == set()
    assert _flags(spark, [base, (2, ts("2024-01-12 00:00:00"), None, "A")]) == set()
    assert _flags(spark, [(1, ts("2024-01-08 00:00:00"), None, "A"), day30]) == set()


def _random_stays(seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    stays = []
    for _ in range(400):
        # Patient 0 holds a third of the stays; many share days and instants.
        patient = 0 if rng.random() < 0.34 else rng.randrange(1, 40)
        admitted = start + timedelta(hours=rng.randrange(0, 24 * 200, 6))
        left = None if rng.random() < 0.1 else admitted + timedelta(hours=rng.randrange(0, 24 * 9, 6))
        stays.append((patient, admitted, left, rng.choice("ABC")))
    return stays


def test_flags_equal_the_self_join(spark):
    stays = _random_stays(1)
    expected = {
        i for i, s in enumerate(stays) if any(s[0] == t[0] and _follows(s[1], t[2]) for t in stays)
    }
    assert 0 < len(expected) < len(stays)
    assert _flags(spark, stays) == expected


def test_readmissions_per_index_specialty_equal_the_self_join(spark):
    stays = _random_stays(2)
    pairs = {
        (t[3], i) for i, s in enumerate(stays) for t in stays if s[0] == t[0] and _follows(s[1], t[2])
    }
    expected = sorted(
        (
            spec,
            sum(1 for t in stays if t[3] == spec and t[2] is not None),
            sum(1 for p in pairs if p[0] == spec),
        )
        for spec in "ABC"
    )
    a, d = _frames(spark, stays)
    got = readmission.readmissions_by_index(d, a, "spec")
    assert tuples(got, "spec", "discharges", "readmissions") == expected


def test_one_readmission_counts_once_for_each_index_specialty(spark):
    stays = [
        (1, ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"), "A"),
        (1, ts("2024-01-01 06:00:00"), ts("2024-01-03 00:00:00"), "B"),
        (1, ts("2024-01-10 00:00:00"), None, "C"),
    ]
    a, d = _frames(spark, stays)
    got = readmission.readmissions_by_index(d, a, "spec")
    assert tuples(got, "spec", "readmissions") == [("A", 1), ("B", 1)]
