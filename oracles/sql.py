"""One SQL statement per registered query, written from the raw tables alone.

Every statement is built from shared CTEs that restate the clinical mapping, so nothing
here depends on how the Spark jobs compute the same rows. Ratios are rounded half up in
whole-number arithmetic, because DuckDB divides decimals as floating point.
"""

from __future__ import annotations

FIRST, SECOND = "TIMESTAMP '2002-01-01 02:00:00'", "TIMESTAMP '2002-02-01 02:00:00'"
SPLIT = "TIMESTAMP '2000-06-30 00:00:00'"
OPEN_END = "DATE '9999-12-31'"


def ratio(total: str, count: str, digits: int, width: int) -> str:
    """total / count (total >= 0, whole number) rounded half up to digits."""
    scaled = f"CAST({total} AS HUGEINT) * {2 * 10**digits} + {count}"
    step = "0." + "0" * (digits - 1) + "1"
    return (
        f"CAST(CAST(({scaled}) // (2 * CAST({count} AS HUGEINT)) AS DECIMAL(18,0)) * {step} "
        f"AS DECIMAL({width},{digits}))"
    )


def percent(part: str, whole: str) -> str:
    return ratio(f"(100 * CAST({part} AS HUGEINT))", whole, 2, 12)


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS BIGINT)"


def mean_of_cents(total: str, count: str) -> str:
    """Mean of amounts given in cents, as an amount with two digits."""
    return (
        f"CAST(CAST((2 * CAST({total} AS HUGEINT) + {count}) // (2 * CAST({count} AS HUGEINT)) "
        f"AS DECIMAL(18,0)) * 0.01 AS DECIMAL(22,2))"
    )


# The categories, department kinds, age groups, codes and encounter types
# below are those that the engine must give.
def specialty_category(code: str) -> str:
    return (
        f"CASE WHEN {code} IN ('SURG','ORTH','NEUR') THEN 'Surgical' "
        f"WHEN {code} IN ('RAD','PATH','ANES') THEN 'Diagnostic/Support' ELSE 'Medical' END"
    )


def department_type(name: str) -> str:
    return (
        f"CASE WHEN {name} ILIKE '%ICU%' OR {name} ILIKE '%Inpatient%' THEN 'Inpatient' "
        f"WHEN {name} ILIKE '%Clinic%' OR {name} ILIKE '%Outpatient%' THEN 'Outpatient' "
        f"WHEN {name} ILIKE '%Emergency%' THEN 'ER' "
        f"WHEN {name} ILIKE '%Surgical%' THEN 'Surgical' ELSE 'Other' END"
    )


def age(born: str, as_of: str) -> str:
    """Completed years by comparing month and day."""
    return (
        f"CAST(year({as_of}) - year({born}) - CASE WHEN month({as_of}) * 100 + day({as_of}) "
        f"< month({born}) * 100 + day({born}) THEN 1 ELSE 0 END AS INTEGER)"
    )


def age_group(years: str) -> str:
    return (
        f"CASE WHEN {years} < 18 THEN '0-17' WHEN {years} BETWEEN 18 AND 34 THEN '18-34' "
        f"WHEN {years} BETWEEN 35 AND 54 THEN '35-54' WHEN {years} BETWEEN 55 AND 74 THEN '55-74' "
        "ELSE '75+' END"
    )


_CODES = (
    "['CARD','IM','ER','ORTH','PED','NEUR','RAD','ONC','DERM','PSY',"
    "'ANES','PATH','OPHT','URO','GI','NEPH','PULM','ENDO','RHEUM','SURG']"
)


def _patients(name: str, changed: str, keep: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT c_custkey AS patient_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) || CASE WHEN {changed} THEN '-R' ELSE '' END AS last_name,
         CAST(DATE '1920-01-01' + CAST((c_custkey * 37) % 28500 AS INTEGER) AS DATE) AS date_of_birth,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         'MRN-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS mrn
  FROM customer WHERE {keep})"""


def _providers(name: str, changed: str, keep: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT s_suppkey AS provider_id, split_part(s_name, '#', 1) AS first_name,
         split_part(s_name, '#', 2) AS last_name,
         CASE WHEN s_suppkey % 4 = 0 THEN 'FWACS' ELSE 'MBChB' END AS credential,
         CASE WHEN {changed} THEN (s_nationkey + 1) % 25 ELSE s_nationkey END AS specialty_id,
         s_suppkey % 5 AS department_id
  FROM supplier WHERE {keep})"""


MAPPING = f"""
{_patients("patients", "FALSE")},
{_patients("patients2", "c_custkey % 7 = 0")},
{_providers("providers", "FALSE")},
{_providers("providers2", "s_suppkey % 5 = 0")},
specialties AS (
  SELECT CAST(n_nationkey AS BIGINT) AS specialty_id, n_name AS specialty_name,
         CASE WHEN n_nationkey < 20 THEN {_CODES}[n_nationkey + 1] ELSE 'X' || n_nationkey END AS specialty_code
  FROM nation),
departments AS (
  SELECT CAST(r_regionkey AS BIGINT) AS department_id,
         ['Emergency Department', 'Intensive Care Unit (ICU)', 'Outpatient Clinic', 'Surgical Suite',
          'Administration'][r_regionkey + 1] AS department_name,
         CAST(r_regionkey + 1 AS INTEGER) AS floor,
         CAST([50, 15, 30, 30, 30][r_regionkey + 1] AS INTEGER) AS capacity
  FROM region),
diagnoses AS (
  SELECT p_partkey AS diagnosis_id,
         upper(left(p_type, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0') AS icd10_code,
         p_type || ' ' || p_size AS icd10_description
  FROM part),
procedures AS (
  SELECT p_partkey AS procedure_id,
         CASE b WHEN 5 THEN '99213' WHEN 10 THEN '93000' WHEN 15 THEN '71020' WHEN 20 THEN '36415'
                WHEN 25 THEN '80053' ELSE CAST(90000 + 400 * b - 37 * b * b AS VARCHAR) END AS cpt_code,
         p_brand AS cpt_description
  FROM (SELECT p_partkey, p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS b FROM part)),
encounters AS (
  SELECT encounter_id, patient_id, provider_id, encounter_type, encounter_date, department_id,
         CASE encounter_type
           WHEN 'Inpatient' THEN encounter_date + to_days(CAST(encounter_id % 10 + 1 AS INTEGER))
           WHEN 'Outpatient' THEN encounter_date + to_hours(encounter_id % 4 + 1)
           ELSE encounter_date + to_hours(encounter_id % 12 + 1) END AS discharge_date
  FROM (SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
               o_orderkey % (SELECT count(*) FROM supplier) AS provider_id,
               CASE o_orderstatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient'
                    WHEN 'P' THEN 'ER' END AS encounter_type,
               o_orderdate + to_hours(o_orderkey % 24) AS encounter_date,
               o_orderkey % 5 AS department_id
        FROM orders)),
encounter_diagnoses AS (
  SELECT l_orderkey AS encounter_id, l_partkey AS diagnosis_id, l_linenumber AS diagnosis_sequence
  FROM lineitem WHERE l_returnflag <> 'N'),
encounter_procedures AS (
  SELECT l_orderkey AS encounter_id, l_partkey AS procedure_id, CAST(l_shipdate AS DATE) AS procedure_date,
         l_linenumber, l_suppkey
  FROM lineitem WHERE l_returnflag <> 'R'),
billing AS (
  SELECT o_orderkey AS encounter_id, CAST(o_totalprice AS DECIMAL(12,2)) AS claim_amount,
         CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * 0.8, 2) AS DECIMAL(12,2)) AS allowed_amount,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'Pending' WHEN '2' THEN 'Denied'
              WHEN '3' THEN 'Under Review' ELSE 'Paid' END AS claim_status
  FROM orders WHERE o_orderkey % 10 <> 0)"""

DIMENSIONS = f"""
dim_date AS (
  SELECT row_number() OVER (ORDER BY d) AS date_key, d AS calendar_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) AS quarter_name,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
         CAST((dayofyear(d) - 1 + w) // 7 + CASE WHEN w <= 3 THEN 1 ELSE 0 END AS INTEGER) AS week_of_year,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday
  FROM (SELECT d, isodow(CAST(date_trunc('year', d) AS DATE)) - 1 AS w
        FROM (SELECT CAST(unnest(generate_series(
                (SELECT date_trunc('year', min(encounter_date)) FROM encounters),
                (SELECT date_trunc('year', max(encounter_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY
                 FROM encounters), INTERVAL 1 DAY)) AS DATE) AS d))),
dim_specialty AS (
  SELECT row_number() OVER (ORDER BY specialty_id) AS specialty_key, *,
         {specialty_category("specialty_code")} AS specialty_category
  FROM specialties),
dim_department AS (
  SELECT row_number() OVER (ORDER BY department_id) AS department_key, *,
         {department_type("department_name")} AS department_type
  FROM departments),
dim_encounter_type AS (
  SELECT CAST(k AS BIGINT) AS encounter_type_key, encounter_type, encounter_type_category,
         CAST(expected_los_days AS INTEGER) AS expected_los_days
  FROM (VALUES (1, 'Outpatient', 'Ambulatory', 0), (2, 'Inpatient', 'Acute', 5), (3, 'ER', 'Emergency', 1))
       t(k, encounter_type, encounter_type_category, expected_los_days)),
dim_diagnosis AS (
  SELECT row_number() OVER (ORDER BY diagnosis_id) AS diagnosis_key, *, left(icd10_code, 1) AS icd10_category
  FROM diagnoses),
dim_procedure AS (
  SELECT row_number() OVER (ORDER BY procedure_id) AS procedure_key, *,
         CASE WHEN starts_with(cpt_code, '99') THEN 'Evaluation & Management'
              WHEN starts_with(cpt_code, '9') THEN 'Medicine' WHEN starts_with(cpt_code, '7') THEN 'Radiology'
              WHEN starts_with(cpt_code, '8') THEN 'Laboratory' ELSE 'Procedure' END AS procedure_category
  FROM procedures)"""

PROVIDER_COLUMNS = """provider_key, provider_id, first_name, last_name, full_name, credential, specialty_name,
  specialty_code, specialty_category, department_name, department_floor, department_type, effective_date,
  expiration_date, is_current"""
PATIENT_COLUMNS = """patient_key, patient_id, mrn, first_name, last_name, full_name, date_of_birth, age, age_group,
  gender, effective_date, expiration_date, is_current"""


def _patient_rows(source: str, as_of: str, keep: str = "TRUE") -> str:
    years = age("date_of_birth", as_of)
    return f"""SELECT patient_id, mrn, first_name, last_name, first_name || ' ' || last_name AS full_name,
         date_of_birth, {years} AS age, {age_group(years)} AS age_group, gender, {as_of} AS effective_date
  FROM {source} WHERE {keep}"""


def _provider_rows(source: str, as_of: str, keep: str = "TRUE") -> str:
    return f"""SELECT provider_id, first_name, last_name, first_name || ' ' || last_name AS full_name, credential,
         s.specialty_name, s.specialty_code, s.specialty_category, d.department_name,
         d.floor AS department_floor, d.department_type, {as_of} AS effective_date
  FROM {source} p LEFT JOIN dim_specialty s USING (specialty_id) LEFT JOIN dim_department d USING (department_id)
  WHERE {keep}"""


def history(kind: str, rows, held: str, changed: str, days: tuple[str, str], names: tuple[str, str]) -> str:
    """CTEs <kind>_v1, <kind>_v2 and <kind>_all: versions after one and after two loads.

    held: keys that first appear in the second load; changed: keys changed before it.
    """
    key, natural = f"{kind}_key", f"{kind}_id"
    return f"""
{kind}_v1 AS (SELECT row_number() OVER (ORDER BY {natural}) AS {key}, * FROM ({rows(names[0], days[0], f"NOT ({held})")})),
{kind}_v2 AS (
  SELECT (SELECT count(*) FROM {kind}_v1) + row_number() OVER (ORDER BY {natural}) AS {key}, *
  FROM ({rows(names[1], days[1], f"({changed}) OR ({held})")})),
{kind}_all AS (
  SELECT *, CASE WHEN {changed} THEN {days[1]} ELSE {OPEN_END} END AS expiration_date,
         NOT ({changed}) AS is_current FROM {kind}_v1
  UNION ALL SELECT *, {OPEN_END}, TRUE FROM {kind}_v2)"""


DAY1, DAY2 = "DATE '2002-01-01'", "DATE '2002-02-01'"


def _people(held: bool = False, provider_days: tuple[str, str] = (DAY1, DAY2)) -> str:
    return (
        history(
            "patient", _patient_rows, "patient_id % 11 = 10" if held else "FALSE", "patient_id % 7 = 0",
            (DAY1, DAY2), ("patients", "patients2"),
        )
        + ","
        + history(
            "provider", _provider_rows, "provider_id % 13 = 12" if held else "FALSE", "provider_id % 5 = 0",
            provider_days, ("providers", "providers2"),
        )
    )


READMISSIONS = """
inpatients AS (SELECT * FROM encounters WHERE encounter_type = 'Inpatient'),
readmitted AS (
  SELECT DISTINCT a.encounter_id
  FROM inpatients a JOIN inpatients b ON a.patient_id = b.patient_id AND a.encounter_date > b.discharge_date
  WHERE date_diff('day', CAST(b.discharge_date AS DATE), CAST(a.encounter_date AS DATE)) <= 30)"""

MEASURES = """
measures AS (
  SELECT e.*, e.encounter_id IN (SELECT encounter_id FROM readmitted) AS is_readmission,
         coalesce(d.n, 0) AS diagnosis_count, coalesce(p.n, 0) AS procedure_count,
         CAST(date_diff('day', CAST(encounter_date AS DATE), CAST(discharge_date AS DATE)) AS INTEGER)
           AS length_of_stay_days,
         CAST(claim AS DECIMAL(22,2)) AS total_claim_amount,
         CAST(allowed AS DECIMAL(22,2)) AS total_allowed_amount, claim IS NOT NULL AS has_billing
  FROM encounters e
  LEFT JOIN (SELECT encounter_id, count(*) AS n FROM encounter_diagnoses GROUP BY ALL) d USING (encounter_id)
  LEFT JOIN (SELECT encounter_id, count(*) AS n FROM encounter_procedures GROUP BY ALL) p USING (encounter_id)
  LEFT JOIN (SELECT encounter_id, sum(claim_amount) AS claim, sum(allowed_amount) AS allowed
             FROM billing GROUP BY ALL) b USING (encounter_id))"""

FACT_COLUMNS = """encounter_key, date_key, patient_key, provider_key, specialty_key, department_key,
  encounter_type_key, encounter_id, patient_id, provider_id, encounter_datetime, discharge_datetime,
  diagnosis_count, procedure_count, length_of_stay_days, total_claim_amount, total_allowed_amount,
  is_readmission, has_billing, year_month"""


def fact(
    name: str, patients: str, providers: str, order: str = "encounter_id", where: str = "TRUE", dates: str = "dim_date"
) -> str:
    """Fact rows with the given current patient and provider versions."""
    return f"""{name} AS (
  SELECT row_number() OVER (ORDER BY {order}) AS encounter_key, d.date_key, pa.patient_key, pr.provider_key,
         s.specialty_key, de.department_key, t.encounter_type_key, m.encounter_id, m.patient_id, m.provider_id,
         m.encounter_date AS encounter_datetime, m.discharge_date AS discharge_datetime, m.diagnosis_count,
         m.procedure_count, m.length_of_stay_days, m.total_claim_amount, m.total_allowed_amount,
         m.is_readmission, m.has_billing, d.year_month
  FROM measures m
  JOIN {dates} d ON d.calendar_date = CAST(m.encounter_date AS DATE)
  JOIN {patients} pa ON pa.patient_id = m.patient_id
  JOIN {providers} pr ON pr.provider_id = m.provider_id
  JOIN dim_specialty s ON s.specialty_code = pr.specialty_code
  JOIN dim_department de ON de.department_id = m.department_id
  JOIN dim_encounter_type t ON t.encounter_type = m.encounter_type
  WHERE {where})"""


FULL = f"""{fact("fact_encounters", "patient_v1", "provider_v1")}"""
TWO = f"""
patient_now AS (SELECT * FROM patient_all WHERE is_current),
provider_now AS (SELECT * FROM provider_all WHERE is_current),
{fact("fact_one", "patient_v1", "provider_v1", where=f"m.encounter_date <= {SPLIT}")},
{fact("fact_later", "patient_now", "provider_now", where=f"m.encounter_date > {SPLIT}")},
fact_two AS (
  SELECT * REPLACE ((SELECT count(*) FROM fact_one) + encounter_key AS encounter_key) FROM fact_later),
fact_encounters AS (
  SELECT *, {FIRST} AS created_date, {FIRST} AS updated_date FROM fact_one
  UNION ALL SELECT *, {SECOND}, {SECOND} FROM fact_two)"""

BRIDGES = """
bridge_diagnoses AS (
  SELECT f.encounter_key, d.diagnosis_key, min(ed.diagnosis_sequence) AS diagnosis_sequence,
         CAST(f.encounter_datetime AS DATE) AS diagnosis_date
  FROM encounter_diagnoses ed JOIN fact_encounters f USING (encounter_id) JOIN dim_diagnosis d USING (diagnosis_id)
  GROUP BY ALL),
bridge_procedures AS (
  SELECT encounter_key, procedure_key, procedure_sequence, procedure_date
  FROM (SELECT *, row_number() OVER (PARTITION BY encounter_key, procedure_key ORDER BY procedure_sequence) AS copy
        FROM (SELECT f.encounter_key, p.procedure_key, ep.procedure_date,
                     row_number() OVER (PARTITION BY ep.encounter_id ORDER BY ep.procedure_date,
                       ep.procedure_id, ep.l_linenumber, ep.l_suppkey) AS procedure_sequence
              FROM encounter_procedures ep JOIN fact_encounters f USING (encounter_id)
              JOIN dim_procedure p USING (procedure_id)))
  WHERE copy = 1)"""

PAIRS = f"""
pairs AS (
  SELECT icd10_code, icd10_description, cpt_code, cpt_description,
         count(DISTINCT f.encounter_key) AS encounter_count,
         CAST(coalesce(sum(f.total_allowed_amount), 0) AS DECIMAL(38,2)) AS total_revenue,
         coalesce(sum(f.length_of_stay_days), 0) AS sum_los, count(f.length_of_stay_days) AS n_los
  FROM fact_encounters f
  JOIN bridge_diagnoses bd USING (encounter_key) JOIN dim_diagnosis USING (diagnosis_key)
  JOIN bridge_procedures bp USING (encounter_key) JOIN dim_procedure USING (procedure_key)
  GROUP BY icd10_code, icd10_description, cpt_code, cpt_description)"""
PAIR_ORDER = "encounter_count DESC, icd10_code, cpt_code, icd10_description, cpt_description"


def stmt(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (MAPPING, *ctes)) + "\n" + select.strip()


def source(select: str) -> str:
    return stmt(select)


def dimension(select: str) -> str:
    return stmt(select, DIMENSIONS, _people())


def full(select: str, *more: str) -> str:
    return stmt(select, DIMENSIONS, _people(), READMISSIONS, MEASURES, FULL, *more)


def two(select: str, *more: str) -> str:
    return stmt(select, DIMENSIONS, _people(), READMISSIONS, MEASURES, TWO, *more)


def _check(name: str, count: str) -> str:
    return f"""SELECT '{name}' AS "check", CAST(n AS BIGINT) AS bad_rows,
  CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT coalesce({count}, 0) AS n)"""


def _orphans(rows: str, parents: str, key: str) -> str:
    return f"(SELECT count(*) FROM {rows} r LEFT JOIN {parents} p ON r.{key} = p.{key} WHERE p.{key} IS NULL)"


def _copies(rows: str, key: str) -> str:
    return f"(SELECT count({key}) - count(DISTINCT {key}) FROM {rows})"


def _coverage(name: str, rows: str, misses: str) -> str:
    return f"""SELECT '{name}' AS "check", r AS rows, m AS misses,
  CASE WHEN r > 0 THEN {percent("m", "r")} END AS miss_percent
  FROM (SELECT (SELECT count(*) FROM {rows}) AS r, CAST({misses} AS BIGINT) AS m)"""


def statements() -> dict[str, str]:
    union = "\nUNION ALL\n"
    q1 = "SELECT f.year_month AS encounter_month, specialty_name, encounter_type, count(*) AS total_encounters, " \
         "count(DISTINCT f.patient_key) AS unique_patients FROM fact_encounters f " \
         "JOIN dim_specialty USING (specialty_key) JOIN dim_encounter_type USING (encounter_type_key) GROUP BY ALL"
    held = stmt
    batch_checks = union.join(
        f"""SELECT CAST({n} AS BIGINT) AS batch_id, '{check}' AS "check", rows, misses,
  CASE WHEN rows > 0 THEN {percent("misses", "rows")} END AS miss_percent
  FROM (SELECT count(*) AS rows, count(*) FILTER ({missed}) AS misses
        FROM fact_encounters WHERE encounter_datetime {side} {SPLIT})"""
        for n, side in ((1, "<="), (2, ">"))
        for check, missed in (
            ("fact_without_bill", "NOT has_billing"),
            ("fact_without_diagnosis", "diagnosis_count = 0"),
            ("fact_without_procedure", "procedure_count = 0"),
            ("fact_without_discharge", "discharge_datetime IS NULL"),
            ("fact_before_watermark", "FALSE"),
            ("encounter_rejected", "FALSE"),
        )
    )
    out = {
        "dim_date": dimension("SELECT * FROM dim_date"),
        "dim_specialty": dimension("SELECT * FROM dim_specialty"),
        "dim_department": dimension("SELECT * FROM dim_department"),
        "dim_diagnosis": dimension("SELECT * FROM dim_diagnosis"),
        "dim_procedure": dimension("SELECT * FROM dim_procedure"),
        "dim_encounter_type": dimension(
            "SELECT t.*, coalesce(n, 0) AS encounters FROM dim_encounter_type t LEFT JOIN "
            "(SELECT encounter_type, count(*) AS n FROM encounters GROUP BY ALL) USING (encounter_type)"
        ),
        "dim_patient_initial": dimension(
            f"SELECT *, {OPEN_END} AS expiration_date, TRUE AS is_current FROM patient_v1"
        ),
        "dim_provider_initial": dimension(
            f"SELECT *, {OPEN_END} AS expiration_date, TRUE AS is_current FROM provider_v1"
        ),
        "dim_patient_scd2": held(f"SELECT {PATIENT_COLUMNS} FROM patient_all", DIMENSIONS, _people(held=True)),
        "dim_provider_scd2": held(f"SELECT {PROVIDER_COLUMNS} FROM provider_all", DIMENSIONS, _people(held=True)),
        "scd1_upsert": source("""
SELECT CASE WHEN first THEN k1 ELSE (SELECT count(*) FROM diagnoses WHERE diagnosis_id % 11 <> 10) + k2 END
         AS diagnosis_key, diagnosis_id, icd10_code,
       icd10_description || CASE WHEN diagnosis_id % 7 = 0 AND (diagnosis_id % 13 <> 12 OR diagnosis_id % 11 = 10)
         THEN '-R' ELSE '' END
         AS icd10_description, left(icd10_code, 1) AS icd10_category
FROM (SELECT *, diagnosis_id % 11 <> 10 AS first,
             count(*) FILTER (diagnosis_id % 11 <> 10) OVER (ORDER BY diagnosis_id) AS k1,
             count(*) FILTER (diagnosis_id % 11 = 10) OVER (ORDER BY diagnosis_id) AS k2
      FROM diagnoses)"""),
        "insert_ignore_lines": """
SELECT l_orderkey AS encounter_id, l_partkey AS diagnosis_id,
       coalesce(min(l_linenumber) FILTER (l_returnflag = 'A'), min(l_linenumber)) AS diagnosis_sequence
FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL""".strip(),
        "fact_encounters_initial": full("SELECT * FROM fact_encounters"),
        "fact_encounters_incremental": two("SELECT * FROM fact_encounters"),
        "fact_late_changes": two("SELECT * EXCLUDE (updated_date) FROM fact_encounters"),
        "fact_as_of_provider": stmt(
            """SELECT e.encounter_id, e.provider_id, p.provider_key, s.specialty_key
FROM encounters e JOIN provider_all p ON e.provider_id = p.provider_id
 AND p.effective_date <= CAST(e.encounter_date AS DATE) AND CAST(e.encounter_date AS DATE) < p.expiration_date
JOIN dim_specialty s USING (specialty_code)""",
            DIMENSIONS,
            _people(provider_days=("DATE '1995-01-01'", "DATE '2000-07-01'")),
        ),
        "fact_rejects": source(f"""
SELECT strftime(encounter_date, '%Y-%m') AS encounter_month, 'date outside calendar' AS reject_reason,
       count(*) AS encounters
FROM encounters
WHERE year(encounter_date) > (SELECT year(max(encounter_date)) FROM encounters WHERE encounter_date <= {SPLIT})
   OR year(encounter_date) < (SELECT year(min(encounter_date)) FROM encounters WHERE encounter_date <= {SPLIT})
GROUP BY ALL"""),
        "readmission_flags": stmt(
            "SELECT encounter_id, patient_id, encounter_date FROM encounters JOIN readmitted USING (encounter_id)",
            READMISSIONS,
        ),
        "readmission_flags_incremental": stmt(
            "SELECT encounter_id, encounter_id IN (SELECT encounter_id FROM readmitted) AS is_readmission "
            "FROM encounters",
            READMISSIONS,
        ),
        "bridge_diagnoses": full("SELECT * FROM bridge_diagnoses", BRIDGES),
        "bridge_procedures": full("SELECT * FROM bridge_procedures", BRIDGES),
        "q1_star": full(q1),
        "q1_star_versions": two(q1),
        "q1_star_stored": two(q1),
        "dq_batch_checks": two(batch_checks),
        "q1_oltp": source("""
SELECT strftime(e.encounter_date, '%Y-%m') AS encounter_month, s.specialty_name, e.encounter_type,
       count(DISTINCT e.encounter_id) AS total_encounters, count(DISTINCT e.patient_id) AS unique_patients
FROM encounters e JOIN providers p USING (provider_id) JOIN specialties s USING (specialty_id)
GROUP BY ALL"""),
        "q2_star": full(
            f"SELECT icd10_code, icd10_description, cpt_code, cpt_description, encounter_count, total_revenue, "
            f"CASE WHEN n_los > 0 THEN {ratio('sum_los', 'n_los', 1, 22)} ELSE 0 END AS avg_los_days "
            f"FROM pairs ORDER BY {PAIR_ORDER} LIMIT 10",
            BRIDGES,
            PAIRS,
        ),
        "q2_oltp": source("""
SELECT d.icd10_code, d.icd10_description, pr.cpt_code, pr.cpt_description,
       count(DISTINCT ed.encounter_id) AS encounter_count
FROM encounter_diagnoses ed JOIN diagnoses d USING (diagnosis_id)
JOIN encounter_procedures ep USING (encounter_id) JOIN procedures pr USING (procedure_id)
GROUP BY ALL"""),
        "q3_star": full(f"""
SELECT *, {percent("readmissions_within_30days", "total_discharges")} AS readmission_rate_percent
FROM (SELECT specialty_name, count(*) AS total_discharges,
             count(*) FILTER (is_readmission) AS readmissions_within_30days
      FROM fact_encounters JOIN dim_specialty USING (specialty_key)
      JOIN dim_encounter_type USING (encounter_type_key)
      WHERE encounter_type = 'Inpatient' GROUP BY specialty_name)"""),
        "q3_oltp": stmt(
            f"""
SELECT *, {percent("readmissions_within_30days", "total_discharges")} AS readmission_rate_percent
FROM (SELECT s.specialty_name, count(DISTINCT i.encounter_id) AS total_discharges,
             count(DISTINCT r.encounter_id) AS readmissions_within_30days
      FROM inpatients i JOIN providers p USING (provider_id) JOIN specialties s USING (specialty_id)
      LEFT JOIN inpatients r ON r.patient_id = i.patient_id AND r.encounter_date > i.discharge_date
       AND date_diff('day', CAST(i.discharge_date AS DATE), CAST(r.encounter_date AS DATE)) <= 30
      WHERE i.discharge_date IS NOT NULL GROUP BY s.specialty_name)""",
            READMISSIONS,
        ),
        "q4_star": full(f"""
SELECT year_month AS revenue_month, specialty_name, count(*) AS total_encounters,
       CAST(sum(total_allowed_amount) AS DECIMAL(38,2)) AS total_revenue,
       {mean_of_cents(f"sum({cents('total_allowed_amount')})", "count(total_allowed_amount)")}
         AS avg_revenue_per_encounter
FROM fact_encounters JOIN dim_specialty USING (specialty_key) WHERE has_billing GROUP BY ALL"""),
        "q4_oltp": source(f"""
SELECT strftime(e.encounter_date, '%Y-%m') AS revenue_month, s.specialty_name,
       count(DISTINCT e.encounter_id) AS total_encounters,
       CAST(sum(b.allowed_amount) AS DECIMAL(38,2)) AS total_revenue,
       {mean_of_cents(f"sum({cents('b.allowed_amount')})", "count(b.allowed_amount)")} AS avg_revenue_per_encounter
FROM billing b JOIN encounters e USING (encounter_id) JOIN providers p USING (provider_id)
JOIN specialties s USING (specialty_id)
WHERE b.claim_status = 'Paid' GROUP BY 1, 2"""),
        "pair_summary_incremental": two(
            "SELECT icd10_code, icd10_description, cpt_code, cpt_description, encounter_count, total_revenue, "
            f"CASE WHEN n_los > 0 THEN {ratio('sum_los', 'n_los', 4, 22)} END AS avg_length_of_stay_days FROM pairs",
            BRIDGES,
            PAIRS,
        ),
        "pair_summary_late_changes": two(
            "SELECT icd10_code, icd10_description, cpt_code, cpt_description, encounter_count, total_revenue, "
            f"CASE WHEN n_los > 0 THEN {ratio('sum_los', 'n_los', 4, 22)} END AS avg_length_of_stay_days FROM pairs",
            BRIDGES,
            PAIRS,
        ),
        "provider_workload": full(f"""
SELECT w.provider_id, p.full_name, p.specialty_name, total_encounters, multi_diagnosis_encounters,
       {percent("multi_diagnosis_encounters", "total_encounters")} AS multi_diagnosis_percent, total_revenue,
       CASE WHEN n > 0 THEN {ratio("los", "n", 2, 22)} END AS avg_los_days
FROM (SELECT provider_id, count(*) AS total_encounters,
             count(*) FILTER (diagnosis_count >= 3) AS multi_diagnosis_encounters,
             CAST(coalesce(sum(total_allowed_amount), 0) AS DECIMAL(38,2)) AS total_revenue,
             sum(length_of_stay_days) AS los, count(length_of_stay_days) AS n
      FROM fact_encounters GROUP BY provider_id) w JOIN provider_v1 p USING (provider_id)"""),
        "fact_flags_monthly": full("""
SELECT year_month, count(*) AS total_encounters,
       count(*) FILTER (diagnosis_count >= 3) AS multi_diagnosis_encounters,
       count(*) FILTER (procedure_count = 0) AS encounters_without_procedures,
       count(*) FILTER (NOT has_billing) AS unbilled_encounters
FROM fact_encounters GROUP BY year_month"""),
        "age_group_mix": full("""
SELECT age_group, gender, count(*) AS total_encounters, count(DISTINCT p.patient_id) AS unique_patients,
       CAST(coalesce(sum(total_allowed_amount), 0) AS DECIMAL(38,2)) AS total_revenue
FROM fact_encounters f JOIN patient_v1 p USING (patient_key) GROUP BY age_group, gender"""),
        "department_load": full(f"""
SELECT department_name, department_type, capacity, total_encounters, inpatient_bed_days,
       {ratio("inpatient_bed_days", "capacity", 2, 22)} AS bed_days_per_capacity
FROM (SELECT department_key, count(*) AS total_encounters,
             CAST(coalesce(sum(length_of_stay_days) FILTER (encounter_type = 'Inpatient'), 0) AS BIGINT)
               AS inpatient_bed_days
      FROM fact_encounters JOIN dim_encounter_type USING (encounter_type_key) GROUP BY department_key)
JOIN dim_department USING (department_key)"""),
        "los_outliers": full(f"""
SELECT encounter_type, expected_los_days, total_encounters,
       CASE WHEN n > 0 THEN {ratio("los", "n", 2, 22)} END AS avg_los_days, stays_over_expected
FROM (SELECT encounter_type, expected_los_days, count(*) AS total_encounters, sum(length_of_stay_days) AS los,
             count(length_of_stay_days) AS n,
             count(*) FILTER (length_of_stay_days > expected_los_days) AS stays_over_expected
      FROM fact_encounters JOIN dim_encounter_type USING (encounter_type_key) GROUP BY ALL)"""),
        "weekday_profile": full("""
SELECT is_weekend, day_of_week, day_name, count(*) AS total_encounters
FROM fact_encounters JOIN dim_date USING (date_key) GROUP BY ALL"""),
        "dq_source_checks": source(
            union.join([
                _check("discharge_before_admission",
                       "(SELECT count(*) FROM encounters WHERE discharge_date < encounter_date)"),
                _check("negative_billing_amount",
                       "(SELECT count(*) FROM billing WHERE allowed_amount < 0 OR claim_amount < 0)"),
                _check("encounter_with_unknown_patient", _orphans("encounters", "patients", "patient_id")),
                _check("encounter_with_unknown_provider", _orphans("encounters", "providers", "provider_id")),
            ])
        ),
        "dq_key_checks": source(
            union.join([
                _check("duplicate_mrn", _copies("patients", "mrn")),
                _check("duplicate_patient_id", _copies("patients", "patient_id")),
                _check("duplicate_provider_id", _copies("providers", "provider_id")),
                _check("duplicate_encounter_id", _copies("encounters", "encounter_id")),
                _check("duplicate_specialty_code", _copies("specialties", "upper(specialty_code)")),
            ])
        ),
        "reconciliation": two("""
SELECT CASE WHEN e <> f THEN 'FAIL: row count mismatch' WHEN abs(b - r) > 0.01 THEN 'FAIL: revenue mismatch'
       ELSE 'PASS' END AS status, e AS oltp_encounters, f AS star_encounters, b AS oltp_total_revenue,
       r AS star_total_revenue, CAST(abs(b - r) AS DECIMAL(22,2)) AS revenue_difference
FROM (SELECT (SELECT count(*) FROM encounters) AS e, (SELECT count(*) FROM fact_encounters) AS f,
             (SELECT CAST(coalesce(sum(allowed_amount), 0) AS DECIMAL(22,2)) FROM billing) AS b,
             (SELECT CAST(coalesce(sum(total_allowed_amount), 0) AS DECIMAL(22,2)) FROM fact_encounters) AS r)"""),
        "reconciliation_by_month": two("""
SELECT encounter_month, e AS oltp_encounters, f AS star_encounters, b AS oltp_revenue, r AS star_revenue,
       CASE WHEN e <> f THEN 'FAIL: row count mismatch' WHEN abs(b - r) > 0.01 THEN 'FAIL: revenue mismatch'
       ELSE 'PASS' END AS status
FROM (SELECT strftime(encounter_date, '%Y-%m') AS encounter_month, count(*) AS e,
             CAST(coalesce(sum(m), 0) AS DECIMAL(22,2)) AS b
      FROM encounters LEFT JOIN (SELECT encounter_id, sum(allowed_amount) AS m FROM billing GROUP BY ALL)
        USING (encounter_id) GROUP BY ALL)
JOIN (SELECT year_month AS encounter_month, count(*) AS f,
             CAST(coalesce(sum(total_allowed_amount), 0) AS DECIMAL(22,2)) AS r
      FROM fact_encounters GROUP BY ALL) USING (encounter_month)"""),
        "dq_coverage": source(
            union.join([
                _coverage("encounter_without_bill", "encounters", _orphans("encounters", "billing", "encounter_id")),
                _coverage("encounter_unknown_patient", "encounters", _orphans("encounters", "patients", "patient_id")),
                _coverage("encounter_unknown_provider", "encounters",
                          _orphans("encounters", "providers", "provider_id")),
                _coverage("encounter_unknown_department", "encounters",
                          _orphans("encounters", "departments", "department_id")),
                _coverage("encounter_unknown_type", "encounters",
                          "(SELECT count(*) FROM encounters WHERE encounter_type IS NULL)"),
                _coverage("provider_without_specialty", "providers",
                          _orphans("providers", "specialties", "specialty_id")),
                _coverage("patient_without_birth_date", "patients",
                          "(SELECT count(*) FROM patients WHERE date_of_birth IS NULL)"),
                _coverage("diagnosis_line_unknown_code", "encounter_diagnoses",
                          _orphans("encounter_diagnoses", "diagnoses", "diagnosis_id")),
                _coverage("procedure_line_unknown_code", "encounter_procedures",
                          _orphans("encounter_procedures", "procedures", "procedure_id")),
                _coverage("bill_unknown_encounter", "billing", _orphans("billing", "encounters", "encounter_id")),
            ])
        ),
        "late_arrivals": source(f"""
SELECT strftime(encounter_date, '%Y-%m') AS encounter_month, count(*) AS late_encounters,
       min(encounter_date) AS oldest
FROM encounters WHERE encounter_date <= {SPLIT} AND encounter_id % 3 <> 0 GROUP BY 1"""),
        "batch_summary": two(f"""
SELECT 'INCREMENTAL ETL COMPLETED' AS status,
       (SELECT max(encounter_date) FROM encounters WHERE encounter_date <= {SPLIT}) AS previous_watermark,
       (SELECT max(encounter_date) FROM encounters) AS new_watermark,
       (SELECT count(*) FROM fact_two) AS new_encounters_loaded,
       (SELECT count(*) FROM fact_encounters) AS total_encounters,
       (SELECT count(*) FROM patient_all WHERE is_current) AS active_patients,
       (SELECT count(*) FROM patient_all WHERE NOT is_current) AS historical_patient_versions,
       (SELECT count(*) FROM provider_all WHERE is_current) AS active_providers,
       (SELECT CAST(sum(total_allowed_amount) AS DECIMAL(38,2)) FROM fact_encounters) AS total_revenue,
       (SELECT count(*) FROM fact_encounters WHERE is_readmission) AS total_readmissions,
       CAST(8 AS BIGINT) AS execution_seconds"""),
        "table_counts": two(
            union.join(
                f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {cte}) AS row_count"
                for name, cte in (
                    ("etl_metadata", "(VALUES (1), (2), (3))"), ("dim_date", "dim_date"),
                    ("dim_patient", "patient_all"), ("dim_specialty", "dim_specialty"),
                    ("dim_department", "dim_department"), ("dim_provider", "provider_all"),
                    ("dim_encounter_type", "dim_encounter_type"), ("dim_diagnosis", "dim_diagnosis"),
                    ("dim_procedure", "dim_procedure"), ("fact_encounters", "fact_encounters"),
                    ("bridge_encounter_diagnoses", "bridge_diagnoses"),
                    ("bridge_encounter_procedures", "bridge_procedures"), ("pair_summary", "pairs"),
                    # Two batches of four steps, each opened and closed; nothing was rejected.
                    ("etl_log", "range(16)"), ("rejects", "range(0)"),
                )
            ),
            BRIDGES,
            PAIRS,
        ),
        "etl_log_view": two(
            union.join(
                f"""SELECT CAST({batch} AS BIGINT) AS batch_id, CAST({batch * 4 + i} AS BIGINT) AS log_id,
  '{step}' AS etl_step, {start} + INTERVAL {opened} SECOND AS start_time,
  {start} + INTERVAL {closed} SECOND AS end_time, CAST({closed - opened} AS BIGINT) AS duration_seconds,
  CAST(({rows.format(fact=fact_name, batch=batch)}) AS BIGINT) AS rows_affected, 'SUCCESS' AS status,
  {f"'Encounter Watermark: ' || {marks[0]} || ' | Timestamp Watermark: ' || {marks[1]}" if i == 0 else "NULL"}
    AS error_message"""
                for batch, start, fact_name, marks in (
                    (1, FIRST, "fact_one", ("'1900-01-01 00:00:00'", "'1900-01-01 00:00:00'")),
                    (2, SECOND, "fact_two", (
                        "(SELECT strftime(max(encounter_datetime), '%Y-%m-%d %H:%M:%S') FROM fact_one)",
                        "'2002-01-01 02:00:00'")),
                )
                for i, (step, opened, closed, rows) in enumerate((
                    ("incremental_etl_batch", 0, 7, "SELECT count(*) FROM {fact}"),
                    ("load_dimensions_incremental", 1, 2, "SELECT count(*) FROM patients"),
                    ("load_fact_incremental", 3, 4, "SELECT count(*) FROM {fact}"),
                    ("load_bridge_incremental", 5, 6, "SELECT count(*) FROM bridge_diagnoses "
                     "WHERE encounter_key IN (SELECT encounter_key FROM {fact})"),
                ))
            ),
            BRIDGES,
        ),
        "etl_metadata": two(
            union.join(
                f"""SELECT CAST({i} AS BIGINT) AS metadata_id, '{name}' AS table_name, {SECOND} AS last_etl_timestamp,
  'SUCCESS' AS last_etl_status, (SELECT count(*) FROM {cte}) AS rows_processed, {mark} AS high_watermark,
  {FIRST} AS created_at, {SECOND} AS updated_at"""
                for i, name, cte, mark in (
                    (1, "fact_encounters", "fact_two", "(SELECT max(encounter_datetime) FROM fact_encounters)"),
                    (2, "dim_patient", "patients", SECOND),
                    (3, "dim_provider", "providers", SECOND),
                )
            )
        ),
    }
    early, late = f"m.encounter_date <= {SPLIT}", f"m.encounter_date > {SPLIT}"
    out["stream_fact_load"] = _streamed(early, late, "dim_date")
    # The later part brings its years first; those before it get the keys after them.
    out["stream_late_encounters"] = _streamed(late, early, "dim_date_late", f"""
dim_date_late AS (
  SELECT CASE WHEN later THEN nth ELSE (SELECT count(*) FROM dim_date WHERE year >= first_year) + nth END AS date_key,
         calendar_date, year_month
  FROM (SELECT *, year >= first_year AS later,
               row_number() OVER (PARTITION BY year >= first_year ORDER BY calendar_date) AS nth
        FROM dim_date, (SELECT year(min(encounter_date)) AS first_year FROM encounters
                        WHERE encounter_date > {SPLIT})))""")
    out["fact_duplicate_delivery"] = _streamed("TRUE", "FALSE", "dim_date")
    return out


def _streamed(first: str, second: str, dates: str, *more: str) -> str:
    """All fact columns after two parts arrived, with one version of every person."""
    one, two = (
        fact(name, "patient_v1", "provider_v1", where=where, dates=dates)
        for name, where in (("part_one", first), ("part_two", second))
    )
    return stmt(
        f"""SELECT *, {FIRST} AS created_date, {FIRST} AS updated_date FROM (
  SELECT * FROM part_one UNION ALL
  SELECT * REPLACE ((SELECT count(*) FROM part_one) + encounter_key AS encounter_key) FROM part_two)""",
        DIMENSIONS, _people(), READMISSIONS, MEASURES, *more, one, two,
    )
