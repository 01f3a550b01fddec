from datetime import date, datetime
from decimal import Decimal

import pytest

from wardstar.context import BatchContext, ticking_clock
from wardstar.operators import facts, quality
from wardstar.plans import questions, reports
from wardstar.plans.batch import Star, run_batch
from wardstar.sources.warehouse import Warehouse

from conftest import OLD, SAMPLE, day, ts, tuples

LATER = datetime(2024, 7, 1, 12)


def _fact(wh):
    return Star(wh)["fact_encounters"]


def test_sample_loads_to_the_facts_expected_by_hand(sample, warehouse, batch):
    result = run_batch(warehouse, sample(), batch(1))
    assert (result.new_encounters, result.rejected) == (4, 0)
    columns = ("encounter_key", "encounter_id", "diagnosis_count", "procedure_count", "length_of_stay_days",
               "has_billing", "is_readmission")
    assert tuples(_fact(warehouse), *columns) == [
        (1, 7001, 2, 2, 0, True, False),
        (2, 7002, 2, 1, 4, True, False),
        (3, 7003, 1, 1, 0, False, False),
        (4, 7004, 1, 0, 1, False, False),
    ]
    assert _fact(warehouse).agg({"total_allowed_amount": "sum"}).first()[0] == Decimal("10280.00")
    star = Star(warehouse)
    assert star["bridge_encounter_diagnoses"].count() == 6
    assert tuples(star["bridge_encounter_procedures"], "encounter_key", "procedure_key", "procedure_sequence") == [
        (1, 1, 1), (1, 2, 2), (2, 1, 1), (3, 1, 1),
    ]


def test_rerun_adds_nothing_even_on_the_same_day(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1, date(2024, 7, 1)))
    before = {t: tuples(df) for t, df in Star(warehouse).items() if t not in ("etl_log", "etl_metadata")}
    again = run_batch(warehouse, sample(), batch(2, date(2024, 7, 1)))
    assert again.new_encounters == 0 and again.new_watermark == ts("2024-06-12 23:45:00")
    after = {t: tuples(df) for t, df in Star(warehouse).items() if t not in ("etl_log", "etl_metadata")}
    assert before == after


def test_old_batch_number_is_refused(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    with pytest.raises(ValueError, match="not after"):
        run_batch(warehouse, sample(), batch(1))


def test_second_batch_takes_new_versions_and_appends(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    patients = [(1001, "Una", "Reed-R", day("1955-03-15"), "M", "R-1", LATER), *SAMPLE["patients"][1:]]
    providers = [(101, "Ada", "Quill", "MD", 2, 1, LATER), *SAMPLE["providers"][1:]]
    new = (7005, 1001, 101, "inpatient", ts("2024-07-01 08:00:00"), None, 1)
    src = sample(extra={"encounters": [new], "diagnoses": [(3009, "Z00", "Check-up")]}, patients=patients, providers=providers)
    result = run_batch(warehouse, src, batch(2))
    assert result.new_encounters == 1
    row = _fact(warehouse).filter("encounter_id = 7005").first()
    # New versions of patient and provider, the provider's new specialty, known type despite its case.
    assert (row.encounter_key, row.patient_key, row.provider_key, row.specialty_key) == (5, 4, 4, 2)
    assert row.length_of_stay_days is None and row.is_readmission  # 25 days after 7002 ended
    star = Star(warehouse)
    assert tuples(star["dim_patient"].filter("patient_id = 1001"), "patient_key", "last_name", "is_current") == [
        (1, "Reed", False),
        (4, "Reed-R", True),
    ]
    assert star["dim_diagnosis"].filter("diagnosis_id = 3009").first().diagnosis_key == 4
    # Facts of the first batch keep the version they were loaded with.
    assert _fact(warehouse).filter("encounter_id = 7001").first().patient_key == 1


def test_late_rows_fail_when_strict_and_repair_flags_when_not(sample, warehouse, batch):
    stay = (7006, 1003, 103, "Inpatient", ts("2024-06-20 08:00:00"), ts("2024-06-22 08:00:00"), 3)
    run_batch(warehouse, sample(extra={"encounters": [stay]}), batch(1))
    assert not _fact(warehouse).filter("encounter_id = 7006").first().is_readmission
    late = (7007, 1003, 103, "Inpatient", ts("2024-05-30 08:00:00"), ts("2024-06-01 08:00:00"), 3)
    src = sample(extra={"encounters": [stay, late]})
    with pytest.raises(quality.QualityError, match="row count"):
        run_batch(warehouse, src, batch(2))
    assert warehouse.snapshot().batch_id == 1 and _fact(warehouse).count() == 5
    statuses = {r.status for r in reports.log_view(warehouse.log()).filter("batch_id = 2").collect()}
    assert "FAILED" in statuses and "RUNNING" not in statuses

    result = run_batch(warehouse, src, batch(3, strict=False))
    assert (result.new_encounters, result.repaired_flags) == (1, 1)
    assert result.new_watermark == ts("2024-06-20 08:00:00")  # a late batch never moves it back
    flags = dict(tuples(_fact(warehouse), "encounter_id", "is_readmission"))
    assert flags[7006] and not flags[7007] and _fact(warehouse).count() == 6
    updated = _fact(warehouse).filter("encounter_id = 7006").first()
    assert updated.updated_date > updated.created_date
    untouched = _fact(warehouse).filter("encounter_id = 7004").first()
    assert untouched.updated_date == untouched.created_date


def test_failed_source_check_publishes_nothing(sample, warehouse, batch):
    bad = (1, 1001, 101, "ER", ts("2024-05-10 10:00:00"), ts("2024-05-09 10:00:00"), 1)
    with pytest.raises(quality.QualityError):
        run_batch(warehouse, sample(extra={"encounters": [bad]}), batch(1))
    assert warehouse.snapshot().paths == {}
    rows = reports.log_view(warehouse.log()).collect()
    assert {r.status for r in rows} == {"FAILED"} and "discharge_before_admission" in rows[0].error_message


def test_rejects_carry_their_reason_and_are_stored(sample, warehouse, batch):
    src = sample(
        extra={
            "providers": [(104, "No", "Spec", "MD", None, 1, OLD)],
            "encounters": [
                (1, 1001, 104, "ER", ts("2024-05-11 10:00:00"), None, 1),
                (2, 1001, 101, "Spa", ts("2024-05-11 10:00:00"), None, 1),
                (3, 1001, 101, "ER", ts("2024-05-11 10:00:00"), None, 99),
            ],
        }
    )
    result = run_batch(warehouse, src, batch(1), reconcile=False)
    assert (result.new_encounters, result.rejected) == (4, 3)
    assert tuples(Star(warehouse)["rejects"], "encounter_id", "reject_reason") == [
        (1, "provider without specialty"),
        (2, "unknown encounter type"),
        (3, "unknown department"),
    ]
    with pytest.raises(quality.QualityError):
        run_batch(Warehouse(warehouse.spark, warehouse.root + "-strict"), src, batch(1))


def test_several_bills_keep_one_fact_row(sample, warehouse, batch):
    more = (14003, 7001, Decimal("50.00"), Decimal("20.50"), day("2024-05-12"), "Denied")
    run_batch(warehouse, sample(extra={"billing": [more]}), batch(1))
    row = _fact(warehouse).filter("encounter_id = 7001").first()
    assert (row.total_claim_amount, row.total_allowed_amount) == (Decimal("400.00"), Decimal("300.50"))
    assert _fact(warehouse).count() == 4


def test_duplicate_specialty_code_multiplies_facts_as_the_plain_join_does(sample):
    src = sample(extra={"specialties": [(9, "Heart", "CARD")]})
    from wardstar.context import FIRST_WATERMARK
    from wardstar.operators import dims

    spec = dims.dim_specialty(src["specialties"])
    prov = dims.dim_provider(src["providers"], src["specialties"], src["departments"], date(2024, 7, 1), FIRST_WATERMARK)
    assert facts.provider_lookup(prov.current, spec).filter("provider_id = 101").count() == 2


def test_as_of_lookup_uses_half_open_versions(spark, sample):
    from wardstar.context import FIRST_WATERMARK
    from wardstar.operators import dims

    src = sample()
    versions = spark.createDataFrame(
        [
            (1, 101, "CARD", date(2024, 1, 1), date(2024, 5, 10), False),
            (2, 101, "IM", date(2024, 5, 10), date(9999, 12, 31), True),
            (3, 102, "IM", date(2024, 6, 1), date(9999, 12, 31), True),
            (4, 103, "ER", date(2024, 1, 1), date(9999, 12, 31), True),
        ],
        "provider_key bigint, provider_id bigint, specialty_code string, effective_date date, expiration_date date, is_current boolean",
    )
    patients = dims.dim_patient(src["patients"], date(2024, 1, 1), FIRST_WATERMARK).current
    rows = facts.lookup_keys(
        src["encounters"],
        dims.dim_date(dims.calendar_range(src["encounters"])),
        patients,
        versions,
        dims.dim_specialty(src["specialties"]),
        dims.dim_department(src["departments"]),
        dims.dim_encounter_type(spark),
        mode="as_of",
    )
    assert tuples(rows, "encounter_id", "provider_key", "reject_reason") == [
        (7001, 2, None),
        (7002, 2, None),
        (7003, None, "unknown provider"),
        (7004, 4, None),
    ]


def test_renamed_code_rebuilds_the_pair_summary(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    renamed = [(3001, "I10", "High blood pressure"), *SAMPLE["diagnoses"][1:]]
    run_batch(warehouse, sample(diagnoses=renamed), batch(2))
    star = Star(warehouse)
    from wardstar.operators import pairs

    fresh = pairs.pair_summary(
        star["fact_encounters"], star["bridge_encounter_diagnoses"], star["bridge_encounter_procedures"],
        star["dim_diagnosis"], star["dim_procedure"],
    )
    assert tuples(star["pair_summary"]) == tuples(fresh)
    assert "High blood pressure" in {r.icd10_description for r in star["pair_summary"].collect()}


def test_questions_on_the_sample(sample, warehouse, batch):
    src = sample()
    run_batch(warehouse, src, batch(1))
    star = Star(warehouse)
    expected = [
        ("2024-05", "Cardiology", "Outpatient", 1, 1),
        ("2024-05", "Internal Medicine", "Outpatient", 1, 1),
        ("2024-06", "Cardiology", "Inpatient", 1, 1),
        ("2024-06", "Emergency", "ER", 1, 1),
    ]
    assert [tuple(r) for r in questions.monthly_encounters_star(star).collect()] == expected
    assert [tuple(r) for r in questions.monthly_encounters_source(src).collect()] == expected
    pairs = [tuple(r) for r in questions.top_pairs_star(star).collect()]
    assert pairs[0] == ("E11.9", "Type 2 Diabetes", "99213", "Office Visit", 2, Decimal("280.00"), Decimal("0.0"))
    assert pairs[1] == ("I10", "Hypertension", "99213", "Office Visit", 2, Decimal("10280.00"), Decimal("2.0"))
    assert [r[4] for r in pairs] == [2, 2, 1, 1, 1]  # ties are ordered by code
    assert [tuple(r)[:5] for r in questions.pairs_source(src).collect()] == [p[:5] for p in pairs]
    rate = [("Cardiology", 1, 0, Decimal("0.00"))]
    assert [tuple(r) for r in questions.readmission_rate_star(star).collect()] == rate
    assert [tuple(r) for r in questions.readmission_rate_source(src).collect()] == rate
    money = [
        ("2024-05", "Cardiology", 1, Decimal("280.00"), Decimal("280.00")),
        ("2024-06", "Cardiology", 1, Decimal("10000.00"), Decimal("10000.00")),
    ]
    assert [tuple(r) for r in questions.revenue_star(star).collect()] == money
    assert [tuple(r) for r in questions.revenue_source(src).collect()] == money


def test_metadata_and_log_after_two_batches(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    result = run_batch(warehouse, sample(), batch(2))
    rows = {r.table_name: r for r in Star(warehouse)["etl_metadata"].collect()}
    assert set(rows) == {"fact_encounters", "dim_patient", "dim_provider"}
    assert rows["dim_patient"].last_etl_timestamp == batch(2).started_at  # the start, not the end
    assert rows["dim_patient"].created_at == batch(1).started_at
    assert rows["fact_encounters"].high_watermark == ts("2024-06-12 23:45:00")
    view = reports.log_view(warehouse.log()).collect()
    assert len(view) == 8 and {r.status for r in view} == {"SUCCESS"}
    summary = reports.batch_summary(warehouse.spark, Star(warehouse), result).first()
    assert (summary.new_encounters_loaded, summary.total_encounters, summary.active_patients) == (0, 4, 3)


def test_sources_round_trip_through_parquet(spark, sample, warehouse):
    from wardstar.sources.tables import read_source

    for name, df in sample().items():
        df.write.parquet(f"{warehouse.root}/src/{name}.parquet")
    again = read_source(spark, f"{warehouse.root}/src")
    assert {n: tuples(df) for n, df in again.items()} == {n: tuples(df) for n, df in sample().items()}


# -- deliveries that break the rules ------------------------------------------------


def test_a_strict_batch_refuses_a_repeated_encounter(sample, warehouse, batch):
    again = SAMPLE["encounters"][2]
    with pytest.raises(quality.QualityError, match="duplicate_encounter_id: 1"):
        run_batch(warehouse, sample(extra={"encounters": [again]}), batch(1))
    assert warehouse.snapshot().batch_id == 0


def test_a_loose_batch_keeps_one_copy_and_rejects_bad_rows(sample, warehouse, batch):
    copies = [SAMPLE["encounters"][1]] * 2  # an inpatient stay
    bad = [
        (7010, 1001, 101, "ER", ts("2024-06-20 10:00:00"), ts("2024-06-19 10:00:00"), 1),
        (7011, 9999, 101, "ER", ts("2024-06-20 10:00:00"), None, 1),
        (7012, 1002, 102, "ER", ts("2024-06-21 10:00:00"), None, 1),
        (7013, 1001, 101, "Inpatient", ts("2024-06-25 10:00:00"), None, 1),
    ]
    bill = (14009, 7012, Decimal("-1.00"), Decimal("1.00"), day("2024-06-22"), "Paid")
    src = sample(extra={"encounters": [*copies, *bad, bad[-1]], "billing": [bill]})
    result = run_batch(warehouse, src, batch(1, strict=False), reconcile=False)
    assert (result.new_encounters, result.rejected) == (5, 6)
    fact = _fact(warehouse)
    assert tuples(fact, "encounter_id") == [(7001,), (7002,), (7003,), (7004,), (7013,)]
    assert tuples(fact.filter("is_readmission"), "encounter_id") == [(7013,)]
    assert tuples(Star(warehouse)["rejects"], "encounter_id", "reject_reason") == [
        (7002, "duplicate encounter"),
        (7002, "duplicate encounter"),
        (7010, "discharge before admission"),
        (7011, "unknown patient"),
        (7012, "negative bill"),
        (7013, "duplicate encounter"),
    ]
    # The same rows delivered again change nothing.
    again = run_batch(warehouse, src, batch(2, strict=False), reconcile=False)
    assert again.new_encounters == 0 and _fact(warehouse).count() == 5


def test_the_error_tells_why_encounters_are_missing(sample, warehouse, batch):
    stranger = (7010, 1001, 101, "Other", ts("2024-06-20 10:00:00"), None, 1)
    with pytest.raises(quality.QualityError, match="late encounters: .*rejected, in .*unknown encounter type: 1"):
        run_batch(warehouse, sample(extra={"encounters": [stranger]}), batch(1))
    left = warehouse.spark.read.parquet(f"{warehouse.root}/rejects/batch=1")
    assert tuples(left, "encounter_id") == [(7010,)]


def test_a_commit_that_died_does_not_block_its_batch(spark, sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    spark.createDataFrame([(1,)], "n int").write.parquet(f"{warehouse.root}/_published/batch=2/_temporary/0")
    assert warehouse.snapshot().batch_id == 1
    run_batch(warehouse, sample(), batch(2))
    assert warehouse.snapshot().batch_id == 2


def test_only_a_missing_folder_is_an_empty_warehouse(spark, warehouse):
    from pyspark.errors import AnalysisException

    assert warehouse.snapshot().batch_id == 0 and warehouse.log().count() == 0
    broken = Warehouse(spark, "nosuchscheme://x/y")
    with pytest.raises(Exception) as error:
        broken.snapshot()
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_compacting_changes_no_row_and_the_next_batch_goes_on(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1))
    new = (7005, 1001, 101, "Inpatient", ts("2024-07-01 08:00:00"), None, 1)
    src = sample(extra={"encounters": [new], "encounter_diagnoses": [(8010, 7005, 3001, 1)]})
    run_batch(warehouse, src, batch(2))
    tables = ("fact_encounters", "bridge_encounter_diagnoses", "bridge_encounter_procedures", "dim_patient")
    before = {t: tuples(Star(warehouse)[t]) for t in tables}
    snap = warehouse.compact()
    assert (snap.batch_id, snap.revision) == (2, 1) and warehouse.snapshot() == snap
    assert all(len(snap.paths[t]) == 1 for t in tables[:2])
    assert {t: tuples(Star(warehouse)[t]) for t in tables} == before
    assert warehouse.compact() == snap  # nothing to do
    later = (7006, 1002, 102, "ER", ts("2024-07-02 08:00:00"), None, 2)
    result = run_batch(warehouse, sample(extra={"encounters": [new, later]}), batch(3))
    assert result.new_encounters == 1 and _fact(warehouse).count() == 6


def test_every_attempt_has_its_own_log_rows_and_the_last_message(sample, warehouse, batch):
    bad = (7010, 1001, 101, "ER", ts("2024-06-20 10:00:00"), ts("2024-06-19 10:00:00"), 1)
    with pytest.raises(quality.QualityError):
        run_batch(warehouse, sample(extra={"encounters": [bad]}), batch(1))
    retry = batch(1)
    later = BatchContext(1, retry.as_of, retry.started_at, True, ticking_clock(datetime(2024, 7, 1, 20)))
    run_batch(warehouse, sample(), later)
    rows = reports.log_view(warehouse.log()).collect()
    good = [r for r in rows if r.status == "SUCCESS"]
    failed = [r for r in rows if r.status == "FAILED"]
    assert len(good) == 4 and len(failed) == 2 and all(r.duration_seconds < 60 for r in rows)
    assert all("discharge_before_admission" in r.error_message for r in failed)
    assert [r.error_message for r in good if r.error_message] == [
        "Encounter Watermark: 1900-01-01 00:00:00 | Timestamp Watermark: 1900-01-01 00:00:00"
    ]


def test_a_long_error_is_kept_whole(sample, warehouse, batch):
    from wardstar.plans.batch import StepLog

    log = StepLog(warehouse, batch(1))
    log.record(opened=["incremental_etl_batch"])
    log.fail(RuntimeError("x" * 5_000))
    assert len(reports.log_view(warehouse.log()).first().error_message) == 5_000


def test_a_batch_can_take_the_versions_of_an_encounters_day(sample, warehouse, batch):
    run_batch(warehouse, sample(), batch(1, as_of=date(2024, 1, 1)))
    providers = [(101, "Ada", "Quill", "MD", 2, 1, LATER), *SAMPLE["providers"][1:]]
    new = (7005, 1001, 101, "ER", ts("2024-06-30 08:00:00"), None, 1)
    src = sample(extra={"encounters": [new]}, providers=providers)
    run_batch(warehouse, src, batch(2, as_of=date(2024, 7, 2)), lookup="as_of")
    row = _fact(warehouse).filter("encounter_id = 7005").first()
    assert (row.provider_key, row.specialty_key) == (1, 1)
