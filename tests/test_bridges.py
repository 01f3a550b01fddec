import random
from datetime import date, datetime, timedelta

import pytest

from wardstar.operators import bridges, pairs

from conftest import tuples

LOADED = datetime(2024, 7, 1)


def _lines(seed):
    """Procedure lines where encounter 1 holds a third of all rows, with copies and gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        e = 1 if rng.random() < 0.34 else rng.randrange(2, 60)
        d = None if rng.random() < 0.05 else date(2024, 1, 1) + timedelta(days=rng.randrange(6))
        rows.append((i, e, rng.randrange(0, 40), d))
    return rows


def _expected(rows, known):
    result = {}
    for e in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == e and r[2] in known]
        mine.sort(key=lambda r: (r[3] is not None, r[3] or date.min, r[2]))
        for position, r in enumerate(mine, 1):
            result.setdefault((e * 10, r[2] + 100), (position, r[3]))
    return sorted(((*k, *v) for k, v in result.items()), key=repr)


@pytest.mark.parametrize("block", [1, 4, 64, 1 << 16])
def test_procedure_positions_equal_a_plain_sort_whatever_the_blocks(spark, block):
    rows = _lines(3)
    known = set(range(0, 35))
    lines = spark.createDataFrame(
        rows, "encounter_procedure_id bigint, encounter_id bigint, procedure_id bigint, procedure_date date"
    )
    counts = {e: sum(1 for r in rows if r[1] == e) for e in {r[1] for r in rows}}
    facts = spark.createDataFrame(
        [(e, e * 10, n) for e, n in counts.items()], "encounter_id bigint, encounter_key bigint, procedure_count bigint"
    )
    dim = spark.createDataFrame([(p, p + 100) for p in known], "procedure_id bigint, procedure_key bigint")
    got = bridges.bridge_procedures(lines, facts, dim, LOADED, block)
    assert tuples(
        got, "encounter_key", "procedure_key", "procedure_sequence", "procedure_date"
    ) == _expected(rows, known)


def test_diagnosis_copies_keep_the_lowest_sequence(spark):
    lines = spark.createDataFrame(
        [(1, 7, 50, 3), (2, 7, 50, 2), (3, 7, 51, 1), (4, 8, 50, 1), (5, 7, 99, 1)],
        "encounter_diagnosis_id bigint, encounter_id bigint, diagnosis_id bigint, diagnosis_sequence int",
    )
    facts = spark.createDataFrame(
        [(7, 1, datetime(2024, 1, 1, 23))], "encounter_id bigint, encounter_key bigint, encounter_datetime timestamp_ntz"
    )
    dim = spark.createDataFrame([(50, 5), (51, 6)], "diagnosis_id bigint, diagnosis_key bigint")
    got = bridges.bridge_diagnoses(lines, facts, dim, LOADED).drop("created_date")
    assert tuples(got) == [(1, 5, 2, date(2024, 1, 1)), (1, 6, 1, date(2024, 1, 1))]


def test_pairs_count_an_encounter_once_and_weigh_its_row_pairs(spark):
    """Against brute force over row pairs, with shared codes, a hot encounter and nulls."""
    rng = random.Random(5)
    d_codes = {k: (f"D{k % 4}", f"text {k % 4}" if k % 4 else None) for k in range(12)}
    p_codes = {k: (f"P{k % 3}", f"text {k % 3}") for k in range(9)}
    facts = [(e, rng.choice([None, e * 1.5]), rng.choice([None, e % 5])) for e in range(1, 30)]
    bd = sorted({(1 if rng.random() < 0.3 else rng.randrange(1, 30), rng.randrange(12)) for _ in range(150)})
    bp = sorted({(1 if rng.random() < 0.3 else rng.randrange(1, 30), rng.randrange(9)) for _ in range(120)})
    expected = {}
    amounts, stays = {e: a for e, a, _ in facts}, {e: s for e, _, s in facts}
    for e, d in bd:
        for e2, p in bp:
            if e == e2:
                seen, revenue, los, n = expected.setdefault((*d_codes[d], *p_codes[p]), (set(), 0, 0, 0))
                seen.add(e)
                stay = stays[e]
                expected[(*d_codes[d], *p_codes[p])] = (
                    seen, revenue + (amounts[e] or 0), los + (stay or 0), n + (stay is not None)
                )
    got = pairs.pair_summary(
        spark.createDataFrame(facts, "encounter_key bigint, a double, length_of_stay_days int").selectExpr(
            "encounter_key", "CAST(a AS DECIMAL(22,2)) AS total_allowed_amount", "length_of_stay_days"
        ),
        spark.createDataFrame(bd, "encounter_key bigint, diagnosis_key bigint"),
        spark.createDataFrame(bp, "encounter_key bigint, procedure_key bigint"),
        spark.createDataFrame(
            [(k, *v) for k, v in d_codes.items()], "diagnosis_key bigint, icd10_code string, icd10_description string"
        ),
        spark.createDataFrame(
            [(k, *v) for k, v in p_codes.items()], "procedure_key bigint, cpt_code string, cpt_description string"
        ),
    )
    rows = {tuple(r[:4]): (r[4], float(r[5]), r[6], r[7]) for r in got.collect()}
    assert rows == {k: (len(s), r, los, n) for k, (s, r, los, n) in expected.items()}


def test_merging_two_summaries_adds_sums_and_counts(spark):
    one = spark.sql(
        "SELECT 'a' icd10_code, 'b' icd10_description, 'c' cpt_code, 'd' cpt_description, "
        "2L encounter_count, CAST(5 AS DECIMAL(38,2)) total_revenue, 3L sum_los, 2L n_los"
    )
    merged = pairs.merge_summaries(one, one).collect()
    assert [tuple(map(str, r)) for r in merged] == [("a", "b", "c", "d", "4", "10.00", "6", "4")]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_shuffled_once_per_key_they_meet(spark, no_broadcast):
    """Each side of the two joins; counting, numbering and grouping need no other shuffle."""
    facts = spark.createDataFrame(
        [(7, 70, datetime(2024, 1, 1, 23), 1)],
        "encounter_id bigint, encounter_key bigint, encounter_datetime timestamp_ntz, procedure_count bigint",
    )
    d_lines = spark.createDataFrame([(1, 7, 50, 3)], "l bigint, encounter_id bigint, diagnosis_id bigint, diagnosis_sequence int")
    p_lines = spark.createDataFrame([(1, 7, 50, None)], "l bigint, encounter_id bigint, procedure_id bigint, procedure_date date")
    d_dim = spark.createDataFrame([(50, 5)], "diagnosis_id bigint, diagnosis_key bigint")
    p_dim = spark.createDataFrame([(50, 5)], "procedure_id bigint, procedure_key bigint")
    assert _shuffles(bridges.bridge_diagnoses(d_lines, facts, d_dim, LOADED)) == 4
    assert _shuffles(bridges.bridge_procedures(p_lines, facts, p_dim, LOADED)) == 4


def test_pair_lines_are_shuffled_once_per_key_they_meet(spark, no_broadcast):
    """Lines meet their groups, then their encounter; counting and pairing need no other shuffle."""
    facts = spark.createDataFrame(
        [(1, None, 2)], "encounter_key bigint, total_allowed_amount decimal(22,2), length_of_stay_days int"
    )
    d_lines = spark.createDataFrame([(1, 5)], "encounter_key bigint, diagnosis_key bigint")
    p_lines = spark.createDataFrame([(1, 5)], "encounter_key bigint, procedure_key bigint")
    d_dim = spark.createDataFrame([(5, "D", "d")], "diagnosis_key bigint, icd10_code string, icd10_description string")
    p_dim = spark.createDataFrame([(5, "P", "p")], "procedure_key bigint, cpt_code string, cpt_description string")
    text = pairs.pair_summary(facts, d_lines, p_lines, d_dim, p_dim)._jdf.queryExecution().executedPlan().toString()
    # The ids beside each side's lines, and the facts.
    assert text.count("Exchange hashpartitioning(encounter_key") == 5


def test_pairs_of_facts_named_twice_count_lines_once(spark):
    """Signed facts and copies of a fact weigh each line once per fact, as a semi join did."""
    facts = spark.sql(
        "SELECT 1L encounter_key, sign, CAST(a AS DECIMAL(22,2)) total_allowed_amount, los length_of_stay_days "
        "FROM VALUES (-1, 5, 2), (1, 8, 4) t(sign, a, los)"
    )
    d_lines = spark.createDataFrame([(1, 5), (1, 6), (None, 5)], "encounter_key bigint, diagnosis_key bigint")
    p_lines = spark.createDataFrame([(1, 5), (2, 5)], "encounter_key bigint, procedure_key bigint")
    d_dim = spark.sql("SELECT k diagnosis_key, 'D' icd10_code, 'd' icd10_description FROM VALUES 5L, 6L t(k)")
    p_dim = spark.sql("SELECT 5L procedure_key, 'P' cpt_code, 'p' cpt_description")
    got = pairs.pair_summary(facts, d_lines, p_lines, d_dim, p_dim).collect()
    assert [(r[0], r[2], r[4], float(r[5]), r[6], r[7]) for r in got] == [("D", "P", 0, 6.0, 4, 0)]
