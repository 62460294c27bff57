"""One run over the extracts of several source systems."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from customer_canon.errors import IngestionError
from customer_canon.operators.classify import classify, processed
from customer_canon.operators.dedup import first_by_source
from customer_canon.operators.identify import identify
from customer_canon.operators.lineage import lineage
from customer_canon.plans.paths import check_apart
from customer_canon.plans.run import COMPLETED, FAILED, _write_rejects
from customer_canon.plans.settings import ROWS_PER_SHUFFLE_PARTITION, settings, shuffle_for
from customer_canon.rules import STRICT, Rules
from customer_canon.schema import PROCESSED_FIELDS
from customer_canon.sinks.files import check_rows_per_file, write_processed
from customer_canon.sources.csv_scan import scan_csv, with_input_position
from customer_canon.sources.providers import provider_for


@dataclass(frozen=True)
class SourcesReport:
    """What a run over several sources did; counts by source are those of a run over one."""

    status: str
    error: str | None = None
    counts: Mapping[str, Mapping[str, int]] | None = None
    unique_count: int | None = None
    lineage_count: int | None = None


def run_sources(
    spark: SparkSession,
    inputs: Mapping[str, str | list[str]],
    processed_path: str,
    rejected_path: str,
    *,
    priority: Sequence[str] | None = None,
    lineage_path: str | None = None,
    rules: Rules = STRICT,
    rows_per_file: int | None = None,
    rows_per_partition: int = ROWS_PER_SHUFFLE_PARTITION,
) -> SourcesReport:
    """Runs the extracts ``source system -> path`` as one: one processed row per customer over all of them.

    Of the rows of a customer, the first one of the source that comes first in ``priority`` survives, by default in the
    order of ``inputs``. The processed output has a ``source_system`` column more; rejects go to a folder
    ``source_system=<source>`` each, since their source records differ. ``lineage_path``, if given, gets one row for each
    accepted row: its customer, its source and id, and those of the survivor.

    A source without a required column ends the run as FAILED before anything is written.
    """
    check_apart(
        spark, processed=processed_path, rejected=rejected_path, lineage=lineage_path,
        **{f"input {source}": path for source, path in inputs.items()},
    )
    check_rows_per_file(rows_per_file)
    if not inputs:
        raise ValueError("no sources are given")
    order = list(priority or inputs)
    if unknown := set(order) - set(inputs):
        raise ValueError(f"priority names sources that are not read: {sorted(unknown)}")
    try:
        classified = {
            source: classify(
                with_input_position(scan_csv(spark, path, keep_malformed=rules.total)), provider_for(source), rules, True
            )
            for source, path in inputs.items()
        }
    except IngestionError as error:
        return SourcesReport(FAILED, str(error))

    counts = {s: _write_rejects(rows, f"{rejected_path}/source_system={s}", None) for s, rows in classified.items()}
    accepted = reduce(
        DataFrame.unionByName, [processed(rows).withColumn("source_system", F.lit(s)) for s, rows in classified.items()]
    )
    total = sum(c["processed_count"] for c in counts.values())
    with settings(spark, shuffle_for(spark, total, rows_per_partition)):
        unique, traced = Observation("unique customers"), Observation("lineage")
        customers = identify(first_by_source(accepted, order), rules).select(*PROCESSED_FIELDS, "source_system")
        write_processed(customers.observe(unique, F.count(F.lit(1)).alias("n")), processed_path, rows_per_file)
        if lineage_path:
            rows = lineage(accepted, order, rules=rules).observe(traced, F.count(F.lit(1)).alias("n"))
            write_processed(rows, lineage_path, rows_per_file)
    return SourcesReport(COMPLETED, None, counts, unique.get["n"], traced.get["n"] if lineage_path else None)
