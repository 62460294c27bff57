"""Deciding for every row whether it is processed or rejected, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.functions import country_code, tax_id_is_valid
from customer_canon.operators.mapping import (
    RAW_RECORD,
    canonical_columns,
    normalize,
    prepare,
    quoted,
    with_raw_record,
)
from customer_canon.operators.required import check_required_fields, required_source_fields
from customer_canon.rules import STRICT, Rules
from customer_canon.schema import CANONICAL_FIELDS, REJECTED_FIELDS
from customer_canon.sources.csv_scan import INPUT_POSITION, MALFORMED_LINE
from customer_canon.sources.providers import Provider

# The texts users see in the rejects.
INVALID_TAX_ID = "Invalid tax ID"
UNSUPPORTED_COUNTRY = "Unsupported country"
MALFORMED_RECORD = "Malformed record"

_SOURCE_COUNTRY = "__source_country"


def _acceptance(rules: Rules) -> Column:
    """Boolean verdict on a normalised row; never null under total rules."""
    tax_id, country = F.col("tax_id"), F.col("country")
    if rules.total:
        verdict = F.coalesce(tax_id_is_valid(tax_id, country, elsewhere=tax_id != ""), F.lit(False))
    else:
        verdict = tax_id_is_valid(tax_id, country)
    if rules.on_unsupported_country == "reject":
        verdict = country.isNotNull() & verdict
    return verdict


def _evaluated_once(verdict: Column) -> Column:
    """The same verdict, computed in one place however often it is filtered on.

    Spark pushes filters below deterministic projections, and would there clean
    the tax ID anew for every mention of it. It does not push them past a row
    id; ids are never negative, so the comparison changes nothing.
    """
    return verdict & (F.monotonically_increasing_id() >= 0)


def _unsupported_detail() -> Column:
    return F.concat(F.lit(f"{UNSUPPORTED_COUNTRY}: "), F.coalesce(_SOURCE_COUNTRY, F.lit("(missing)")))


def _invalid_detail() -> Column:
    return F.concat(F.lit(f"{INVALID_TAX_ID} for country "), F.coalesce("country", _SOURCE_COUNTRY, F.lit("(missing)")))


def classify(
    source: DataFrame,
    provider: Provider,
    rules: Rules = STRICT,
    keep_raw: bool = True,
    evaluate_once: bool = True,
) -> DataFrame:
    """Canonical columns plus ``is_valid``, ``reason``, ``reason_detail`` and ``raw_record``.

    One narrow projection over the source: no shuffle, no Python. The source
    record is kept for rejected rows only; ``keep_raw=False`` lets the scan skip
    the columns that are not mapped. An input position, if the source carries
    one, is passed on. A malformed line, if the source marks those, is rejected as
    such and kept in ``raw_line``. Raises IngestionError before any job if a
    required column is absent.

    ``evaluate_once`` keeps filters on the result above the cleaning, which Spark
    would otherwise repeat for each mention of the verdict. It also keeps filters on
    source columns from reaching the scan: turn it off where few rows are wanted.
    """
    if keep_raw:
        source = with_raw_record(source)
    source = prepare(source, provider)
    check_required_fields(source.columns, required_source_fields(provider))

    marked = MALFORMED_LINE in source.columns
    carried = [F.col(INPUT_POSITION)] if INPUT_POSITION in source.columns else []
    raw = [F.col(RAW_RECORD).alias("raw_record")] if keep_raw else []
    line = [F.col(MALFORMED_LINE).alias("raw_line")] if marked else []
    mapped = source.select(
        *canonical_columns(source.columns, provider),
        quoted(provider.mapping["country"]).alias(_SOURCE_COUNTRY),
        *raw,
        *line,
        *carried,
    )
    malformed = F.col("raw_line").isNotNull() if marked else F.lit(False)
    if rules.on_unsupported_country == "fail":
        country = F.col("country")
        known = country_code(country).isNotNull() | malformed
        mapped = mapped.withColumn("country", F.when(known, country).otherwise(F.raise_error(_unsupported_detail())))

    verdict = ~malformed & _acceptance(rules) if marked else _acceptance(rules)
    is_rejected = ~F.col("is_valid")
    by_country = F.col("country").isNull() & F.lit(rules.on_unsupported_country == "reject")
    return (
        normalize(mapped, rules)
        .withColumn("is_valid", _evaluated_once(verdict) if evaluate_once else verdict)
        .select(
            *CANONICAL_FIELDS,
            "is_valid",
            F.when(malformed, MALFORMED_RECORD)
            .when(is_rejected & by_country, UNSUPPORTED_COUNTRY)
            .when(is_rejected, INVALID_TAX_ID)
            .alias("reason"),
            F.when(malformed, MALFORMED_RECORD)
            .when(is_rejected & by_country, _unsupported_detail())
            .when(is_rejected, _invalid_detail())
            .alias("reason_detail"),
            *([F.when(is_rejected, F.col("raw_record")).alias("raw_record")] if keep_raw else []),
            *(["raw_line"] if marked else []),
            *carried,
        )
    )


def processed(classified: DataFrame) -> DataFrame:
    """The accepted rows in canonical layout."""
    keep = [c for c in (*CANONICAL_FIELDS, INPUT_POSITION) if c in classified.columns]
    return classified.filter("is_valid").select(*keep)


def rejected(classified: DataFrame) -> DataFrame:
    """The other rows with their reason and, if kept, their source record."""
    keep = [c for c in (*REJECTED_FIELDS, "raw_record", "raw_line") if c in classified.columns]
    return classified.filter("NOT is_valid").select(*keep)


def process(
    source: DataFrame, provider: Provider, rules: Rules = STRICT, evaluate_once: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(processed, rejected) as two lazy views of one classification."""
    classified = classify(source, provider, rules, evaluate_once=evaluate_once)
    return processed(classified), rejected(classified)
