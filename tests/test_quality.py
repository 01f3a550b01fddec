from decimal import Decimal

import pytest

from wardstar.operators import quality

from conftest import OLD, SAMPLE, day, ts, tuples


def _result(checks):
    return {r.check: (r.bad_rows, r.status) for r in checks.collect()}


def test_clean_source_passes(sample):
    checks = _result(quality.source_checks(sample()))
    assert set(checks.values()) == {(0, "PASS")} and len(checks) == 4
    quality.require(quality.source_checks(sample()))


def test_every_source_check_finds_its_fault(sample):
    src = sample(
        extra={
            "encounters": [
                (1, 1001, 101, "ER", ts("2024-05-10 10:00:00"), ts("2024-05-10 09:59:59"), 1),
                (2, 9999, 101, "ER", ts("2024-05-10 10:00:00"), None, 1),
                (3, 9999, 101, "ER", ts("2024-05-10 10:00:00"), None, 1),
                (4, None, 101, "ER", ts("2024-05-10 10:00:00"), None, 1),
                (5, 1001, 999, "ER", ts("2024-05-10 10:00:00"), None, 1),
            ],
            "billing": [
                (1, 7003, Decimal("-0.01"), Decimal("1.00"), day("2024-05-11"), "Paid"),
                (2, 7004, Decimal("1.00"), Decimal("-1.00"), day("2024-05-11"), "Paid"),
                (3, 7004, Decimal("1.00"), Decimal("5.00"), day("2024-05-11"), "Paid"),  # allowed above claim is fine
            ],
        }
    )
    assert _result(quality.source_checks(src)) == {
        "discharge_before_admission": (1, "FAIL"),
        "negative_billing_amount": (2, "FAIL"),
        "encounter_with_unknown_patient": (3, "FAIL"),
        "encounter_with_unknown_provider": (1, "FAIL"),
    }
    with pytest.raises(quality.QualityError, match="negative_billing_amount: 2"):
        quality.require(quality.source_checks(src))


def test_key_checks_count_copies(sample):
    src = sample(
        extra={
            "patients": [(1001, "X", "Y", None, "F", "R-2", OLD)],
            "specialties": [(9, "Heart", "card")],
        }
    )
    checks = _result(quality.key_checks(src))
    assert checks["duplicate_patient_id"] == (1, "FAIL")
    assert checks["duplicate_mrn"] == (1, "FAIL")
    assert checks["duplicate_specialty_code"] == (1, "FAIL")  # equal but for case
    assert checks["duplicate_encounter_id"] == (0, "PASS")


def test_coverage_counts_misses_and_their_share(sample):
    src = sample(
        extra={
            "patients": [(5, "No", "Birth", None, "F", "m5", OLD)],
            "providers": [(9, "No", "Spec", "MD", None, 1, OLD)],
            "encounters": [(7, 1001, 9, "Spa", ts("2024-05-10 10:00:00"), None, 77)],
            "encounter_diagnoses": [(1, 7, 404, 1)],
        }
    )
    rows = {r.check: (r.rows, r.misses, str(r.miss_percent)) for r in quality.coverage(src).collect()}
    assert rows["encounter_without_bill"] == (5, 3, "60.00")
    assert rows["encounter_unknown_department"] == (5, 1, "20.00")
    assert rows["encounter_unknown_type"] == (5, 1, "20.00")
    assert rows["provider_without_specialty"] == (4, 1, "25.00")
    assert rows["patient_without_birth_date"] == (4, 1, "25.00")
    assert rows["diagnosis_line_unknown_code"] == (7, 1, "14.29")
    assert rows["procedure_line_unknown_code"] == (4, 0, "0.00")


def test_reconciliation_reports_both_kinds_of_mismatch(spark, sample):
    src = sample()
    facts = spark.sql("SELECT CAST(280 AS DECIMAL(22,2)) AS total_allowed_amount")
    row = quality.reconciliation(src["encounters"], src["billing"], facts).first()
    assert row.status == "FAIL: row count mismatch"
    four = facts.unionByName(facts).unionByName(facts).unionByName(facts)
    row = quality.reconciliation(src["encounters"], src["billing"], four).first()
    assert row.status == "FAIL: revenue mismatch" and row.revenue_difference == Decimal("9160.00")
    with pytest.raises(quality.QualityError):
        quality.require_reconciled(quality.reconciliation(src["encounters"], src["billing"], four))


def test_empty_source_passes(sample):
    empty = {name: df.limit(0) for name, df in sample().items()}
    assert set(_result(quality.source_checks(empty)).values()) == {(0, "PASS")}
    assert tuples(quality.coverage(empty), "rows", "miss_percent") == [(0, None)] * 10


def test_source_forms_count_a_copied_encounter_once(sample):
    from wardstar.plans import questions

    once, twice = sample(), sample(extra={"encounters": SAMPLE["encounters"]})
    for question in (questions.monthly_encounters_source, questions.readmission_rate_source):
        assert tuples(question(once)) == tuples(question(twice))


def test_coverage_reads_each_table_once(sample):
    text = quality.coverage(sample())._jdf.queryExecution().executedPlan().toString()
    assert text.count("LocalTableScan") <= 12 and text.count("Exchange hashpartitioning(check") <= 3
