"""From a source layout to the canonical layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.functions import clean_tax_id, country_code
from customer_canon.rules import STRICT, Rules
from customer_canon.schema import CANONICAL_FIELDS, CUSTOMER_FIELDS, REQUIRED_FIELDS
from customer_canon.sources.csv_scan import INPUT_POSITION, MALFORMED_LINE
from customer_canon.sources.providers import Provider

# Name of the column that carries a row as it was read.
RAW_RECORD = "__raw_record"

# Columns that a step before the mapping must pass on.
CARRIED = (INPUT_POSITION, MALFORMED_LINE, RAW_RECORD)


def quoted(column: str) -> Column:
    """A top-level column by its literal name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def canonical_columns(columns: list[str], provider: Provider) -> list[Column]:
    """One column per canonical field, in canonical order; an absent optional one is null."""

    def pick(field: str) -> Column:
        if field in REQUIRED_FIELDS or provider.mapping.get(field) in columns:
            return quoted(provider.mapping[field]).alias(field)
        return F.lit(None).cast("string").alias(field)

    return [pick(field) for field in CANONICAL_FIELDS]


def carried_columns(source: DataFrame) -> list[str]:
    """What a ``prepare`` step that selects columns has to select besides its own."""
    return [name for name in CARRIED if name in source.columns]


def prepare(source: DataFrame, provider: Provider) -> DataFrame:
    """The provider's step before the mapping; ValueError if it loses a row's place, line or record."""
    if provider.prepare is None:
        return source
    prepared = source.transform(provider.prepare)
    lost = [name for name in carried_columns(source) if name not in prepared.columns]
    if lost:
        raise ValueError(f"The prepare step of {provider.source_system} must pass on {', '.join(lost)}")
    return prepared


def map_columns(source: DataFrame, provider: Provider) -> DataFrame:
    """Chooses and renames the provider's columns; everything else is pruned from the scan."""
    source = prepare(source, provider)
    return source.select(canonical_columns(source.columns, provider))


def normalize(mapped: DataFrame, rules: Rules = STRICT) -> DataFrame:
    """Country first, since the tax ID's prefix is recognised by the country's code."""
    return mapped.withColumn("country", country_code(F.col("country"))).withColumn(
        "tax_id", clean_tax_id(F.col("tax_id"), F.col("country"), rules.trim)
    )


def transform(source: DataFrame, provider: Provider, rules: Rules = STRICT) -> DataFrame:
    return normalize(map_columns(source, provider), rules)


def with_provenance(canonical: DataFrame, provider: Provider) -> DataFrame:
    """``source_system, external_id, customer{...}``: a customer and where it came from."""
    return canonical.select(
        F.lit(provider.source_system).alias("source_system"),
        "external_id",
        F.struct(*CUSTOMER_FIELDS).alias("customer"),
    )


def raw_record(columns: list[str]) -> Column:
    """The untouched source row as one struct."""
    return F.struct(*[quoted(c) for c in columns if c not in CARRIED])


def with_raw_record(source: DataFrame) -> DataFrame:
    return source.withColumn(RAW_RECORD, raw_record(source.columns))
