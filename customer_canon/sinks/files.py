"""Output layouts, and the Parquet and JSON files that hold them.

Paths are any URI the cluster can write. Files appear through Spark's commit
protocol, so a task that is retried or lost leaves no partial rows behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from customer_canon.schema import CANONICAL_PROJECTION_FIELDS, PROCESSED_FIELDS, text_schema


def canonical_projection(identified: DataFrame) -> DataFrame:
    """``customer_id, name, tax_id, country, email``: the layout without source references."""
    return identified.select(*CANONICAL_PROJECTION_FIELDS)


def raw_rejects(rejected: DataFrame) -> DataFrame:
    """``raw_record, reason`` with the long reason: the layout that keeps sources untouched."""
    return rejected.selectExpr("raw_record", "reason_detail AS reason")


def check_rows_per_file(rows_per_file: int | None) -> None:
    """Spark takes 0 as "no limit"; asking for it is more likely a mistake."""
    if rows_per_file is not None and rows_per_file <= 0:
        raise ValueError("rows_per_file must be greater than zero")


def write_processed(customers: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Replaces ``path`` with Parquet files of at most ``rows_per_file`` rows each."""
    check_rows_per_file(rows_per_file)
    writer = customers.write.mode("overwrite")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_rejected(rejects: DataFrame, path: str) -> None:
    """Replaces ``path`` with JSON lines; null fields are written as null, not left out."""
    rejects.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_processed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return spark.read.schema(schema or text_schema(PROCESSED_FIELDS)).parquet(path)


def read_rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Reads rejects with their known schema, so an empty output keeps its columns."""
    return spark.read.schema(schema).json(path)
