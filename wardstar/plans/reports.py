"""Batch summary, log and count reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import percent
from .batch import BatchResult


def batch_summary(spark: SparkSession, star: Mapping[str, DataFrame], result: BatchResult) -> DataFrame:
    """One row about a finished batch and the state it left; one scalar per subquery."""
    # Fixed value: the status text that users of the summary look for.
    return spark.sql(
        """
        SELECT 'INCREMENTAL ETL COMPLETED' AS status,
               CAST(:previous AS TIMESTAMP_NTZ) AS previous_watermark,
               CAST(:new AS TIMESTAMP_NTZ) AS new_watermark,
               CAST(:loaded AS BIGINT) AS new_encounters_loaded,
               (SELECT count(*) FROM {fact}) AS total_encounters,
               (SELECT count(*) FROM {patient} WHERE is_current) AS active_patients,
               (SELECT count(*) FROM {patient} WHERE NOT is_current) AS historical_patient_versions,
               (SELECT count(*) FROM {provider} WHERE is_current) AS active_providers,
               (SELECT CAST(sum(total_allowed_amount) AS DECIMAL(38,2)) FROM {fact}) AS total_revenue,
               (SELECT count(*) FROM {fact} WHERE is_readmission) AS total_readmissions,
               CAST(:seconds AS BIGINT) AS execution_seconds
        """,
        args={
            "previous": str(result.previous_watermark),
            "new": str(result.new_watermark),
            "loaded": result.new_encounters,
            "seconds": int((result.finished_at - result.started_at).total_seconds()),
        },
        fact=star["fact_encounters"],
        patient=star["dim_patient"],
        provider=star["dim_provider"],
    )


def log_view(log: DataFrame) -> DataFrame:
    """Latest state of every step of every attempt with its start, end and duration, newest first.

    A batch tried again is a new attempt, with rows of its own. The message is that of the
    step's last event that has one.
    """
    order = F.struct("event_time", F.col("status") != "RUNNING")
    last = F.max_by(F.struct("status", "rows_affected"), order)
    steps = log.groupBy("batch_id", "attempt", "log_id", "etl_step").agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("last_time"),
        last.alias("last"),
        F.max_by("error_message", F.when(F.col("error_message").isNotNull(), order)).alias("error_message"),
    )
    end = F.when(F.col("last.status") != "RUNNING", F.col("last_time"))
    return steps.select(
        "batch_id",
        "log_id",
        "etl_step",
        "start_time",
        end.alias("end_time"),
        F.timestamp_diff("SECOND", F.col("start_time"), end).alias("duration_seconds"),
        F.coalesce(F.col("last.rows_affected"), F.lit(0)).alias("rows_affected"),
        F.col("last.status").alias("status"),
        "error_message",
    ).orderBy(F.desc("start_time"), F.desc("log_id"))


def batch_checks(checks: DataFrame) -> DataFrame:
    """Per batch and check: facts looked at, those that miss it, their share in percent."""
    share = F.when(F.col("rows") > 0, percent(F.col("misses"), F.col("rows")))
    return checks.select("batch_id", "check", "rows", "misses", share.alias("miss_percent")).orderBy("batch_id", "check")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Labelled row counts, one row per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
