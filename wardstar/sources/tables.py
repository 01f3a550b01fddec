"""Reading the ten normalized tables from parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SOURCE, conform, literal_rows


def read_source(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """One frame per source table, with declared types and no inference."""
    base = directory.rstrip("/")
    return {
        name: spark.read.schema(schema).parquet(f"{base}/{name}.parquet")
        for name, schema in SOURCE.items()
    }


def source_from_rows(spark: SparkSession, rows: dict[str, list[tuple]]) -> dict[str, DataFrame]:
    """Source tables from literal rows (fixtures); tables not given are empty."""
    return {name: literal_rows(spark, rows.get(name, []), schema) for name, schema in SOURCE.items()}


def checked(source: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The same tables with exactly the declared columns."""
    return {name: conform(source[name], schema) for name, schema in SOURCE.items()}
