"""The fixed layouts. All data columns are strings, so ``0001`` stays ``0001``."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType


def _strings(*names: str, optional: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(n, StringType(), nullable=n in optional) for n in names])


# Declares which fields are required (non-nullable). Spark treats every file
# column as nullable, so this is a contract to check, not a storage schema.
CANONICAL = _strings("external_id", "name", "tax_id", "country", "email", optional=("email",))

CANONICAL_FIELDS = tuple(CANONICAL.names)
REQUIRED_FIELDS = tuple(f.name for f in CANONICAL.fields if not f.nullable)
CUSTOMER_FIELDS = ("name", "tax_id", "country", "email")

PROCESSED_FIELDS = (*CANONICAL_FIELDS, "customer_id")
CANONICAL_PROJECTION_FIELDS = ("customer_id", *CUSTOMER_FIELDS)
REJECTED_FIELDS = (*CANONICAL_FIELDS, "reason", "reason_detail")


def text_schema(names: tuple[str, ...]) -> StructType:
    """A nullable all-string schema, for reading outputs back without inference."""
    return _strings(*names, optional=names)


def rejected_schema(source_columns: tuple[str, ...]) -> StructType:
    """Schema of the JSON rejects, including the untouched source record."""
    return text_schema(REJECTED_FIELDS).add("raw_record", text_schema(source_columns))


def raw_rejects_schema(source_columns: tuple[str, ...]) -> StructType:
    """Schema of the JSON rejects in the layout that holds the source record only."""
    return StructType().add("raw_record", text_schema(source_columns)).add("reason", StringType())


LEDGER = StructType(
    [
        StructField("source_system", StringType()),
        StructField("input_source", StringType()),
        StructField("status", StringType()),
        StructField("started_at", TimestampType()),
        StructField("finished_at", TimestampType()),
        StructField("error", StringType()),
        StructField("processed_count", LongType()),
        StructField("rejected_count", LongType()),
        StructField("unique_count", LongType()),
        StructField("unnamed_count", LongType()),
    ]
)
