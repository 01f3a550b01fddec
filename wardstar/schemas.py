"""Column types of the ten source tables and of the star schema.

Keys and ids are bigint so that tables past 2^31 rows load. All times are
timestamp_ntz: wall-clock values that no session time zone can shift.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

# Type names used below. StructType.fromDDL would need a running session at import.
_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(22,2)": T.DecimalType(22, 2),
    "decimal(38,2)": T.DecimalType(38, 2),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split() for column in re.split(r",\s+", columns.strip()))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_SOURCE_COLUMNS = {
    "patients": """patient_id bigint, first_name string, last_name string, date_of_birth date,
        gender string, mrn string, last_update timestamp_ntz""",
    "specialties": "specialty_id bigint, specialty_name string, specialty_code string",
    "departments": "department_id bigint, department_name string, floor int, capacity int",
    "providers": """provider_id bigint, first_name string, last_name string, credential string,
        specialty_id bigint, department_id bigint, last_update timestamp_ntz""",
    "encounters": """encounter_id bigint, patient_id bigint, provider_id bigint, encounter_type string,
        encounter_date timestamp_ntz, discharge_date timestamp_ntz, department_id bigint""",
    "diagnoses": "diagnosis_id bigint, icd10_code string, icd10_description string",
    "procedures": "procedure_id bigint, cpt_code string, cpt_description string",
    "encounter_diagnoses": """encounter_diagnosis_id bigint, encounter_id bigint, diagnosis_id bigint,
        diagnosis_sequence int""",
    "encounter_procedures": """encounter_procedure_id bigint, encounter_id bigint, procedure_id bigint,
        procedure_date date""",
    "billing": """billing_id bigint, encounter_id bigint, claim_amount decimal(12,2),
        allowed_amount decimal(12,2), claim_date date, claim_status string""",
}

_TARGET_COLUMNS = {
    "etl_metadata": """metadata_id bigint, table_name string, last_etl_timestamp timestamp_ntz,
        last_etl_status string, rows_processed bigint, high_watermark timestamp_ntz,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "etl_log": """batch_id bigint, attempt timestamp_ntz, log_id bigint, etl_step string, event_time timestamp_ntz,
        rows_affected bigint, status string, error_message string""",
    "dim_date": """date_key bigint, calendar_date date, year int, quarter int, quarter_name string,
        month int, month_name string, year_month string, week_of_year int, day_of_month int,
        day_of_week int, day_name string, is_weekend boolean, is_holiday boolean""",
    "dim_patient": """patient_key bigint, patient_id bigint, mrn string, first_name string,
        last_name string, full_name string, date_of_birth date, age int, age_group string,
        gender string, effective_date date, expiration_date date, is_current boolean""",
    "dim_specialty": """specialty_key bigint, specialty_id bigint, specialty_name string,
        specialty_code string, specialty_category string""",
    "dim_department": """department_key bigint, department_id bigint, department_name string,
        floor int, capacity int, department_type string""",
    "dim_provider": """provider_key bigint, provider_id bigint, first_name string, last_name string,
        full_name string, credential string, specialty_name string, specialty_code string,
        specialty_category string, department_name string, department_floor int,
        department_type string, effective_date date, expiration_date date, is_current boolean""",
    "dim_encounter_type": """encounter_type_key bigint, encounter_type string,
        encounter_type_category string, expected_los_days int""",
    "dim_diagnosis": """diagnosis_key bigint, diagnosis_id bigint, icd10_code string,
        icd10_description string, icd10_category string""",
    "dim_procedure": """procedure_key bigint, procedure_id bigint, cpt_code string,
        cpt_description string, procedure_category string""",
    # Money is wider than one bill because it is summed over an encounter's bills.
    "fact_encounters": """encounter_key bigint, date_key bigint, patient_key bigint,
        provider_key bigint, specialty_key bigint, department_key bigint, encounter_type_key bigint,
        encounter_id bigint, patient_id bigint, provider_id bigint, encounter_datetime timestamp_ntz,
        discharge_datetime timestamp_ntz, diagnosis_count bigint, procedure_count bigint,
        length_of_stay_days int, total_claim_amount decimal(22,2), total_allowed_amount decimal(22,2),
        is_readmission boolean, has_billing boolean, created_date timestamp_ntz,
        updated_date timestamp_ntz, year_month string""",
    "bridge_encounter_diagnoses": """encounter_key bigint, diagnosis_key bigint,
        diagnosis_sequence int, diagnosis_date date, created_date timestamp_ntz""",
    "bridge_encounter_procedures": """encounter_key bigint, procedure_key bigint,
        procedure_sequence bigint, procedure_date date, created_date timestamp_ntz""",
    "pair_summary": """icd10_code string, icd10_description string, cpt_code string,
        cpt_description string, encounter_count bigint, total_revenue decimal(38,2),
        sum_los bigint, n_los bigint""",
    "rejects": """encounter_id bigint, encounter_datetime timestamp_ntz, reject_reason string""",
}

# Kept with a snapshot for the next batch; no part of the star schema.
_STATE_COLUMNS = {
    "source_digests": """block bigint, source_table string, n bigint, money decimal(38,2), mixed bigint,
        summed bigint""",
    "fact_ids": "encounter_id bigint",
    "fact_months": "year_month string, encounters bigint, revenue decimal(38,2), mixed bigint",
    "month_visits": """year_month string, specialty_key bigint, encounter_type_key bigint, bucket bigint,
        encounters bigint, patients binary""",
    "batch_checks": "batch_id bigint, check string, rows bigint, misses bigint",
}

SOURCE = {name: _struct(columns) for name, columns in _SOURCE_COLUMNS.items()}
TARGET = {name: _struct(columns) for name, columns in _TARGET_COLUMNS.items()}
STATE = {name: _struct(columns) for name, columns in _STATE_COLUMNS.items()}
STORED = {**TARGET, **STATE}


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows; handed over as Arrow, so no Python worker starts for them."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.names]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A stored table without rows, as creating it would leave it."""
    return literal_rows(spark, [], STORED[table])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and with its types."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])
