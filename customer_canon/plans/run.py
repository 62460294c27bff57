"""A whole run: scan, classify, write both outputs, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from customer_canon.errors import IngestionError
from customer_canon.operators.classify import classify, process, processed, rejected
from customer_canon.operators.dedup import first_per_customer
from customer_canon.operators.identify import identify
from customer_canon.plans.paths import check_apart
from customer_canon.plans.settings import ROWS_PER_SHUFFLE_PARTITION, settings, shuffle_for
from customer_canon.rules import STRICT, Rules
from customer_canon.schema import LEDGER, PROCESSED_FIELDS
from customer_canon.sinks.files import check_rows_per_file, write_processed, write_rejected
from customer_canon.sources.csv_scan import scan_csv, with_input_position
from customer_canon.sources.providers import Provider

RUNNING = "RUNNING"
COMPLETED = "COMPLETED"
FAILED = "FAILED"

Layout = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunReport:
    """What a run did. Counts are rows; None when the run failed before processing.

    processed_count counts accepted rows before, unique_count after the
    first-wins step; unnamed_count the accepted rows without a name.
    """

    source_system: str
    input_source: str
    status: str
    started_at: datetime
    finished_at: datetime | None
    error: str | None = None
    processed_count: int | None = None
    rejected_count: int | None = None
    unique_count: int | None = None
    unnamed_count: int | None = None

    def as_dataframe(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)], LEDGER)


def process_csv(
    spark: SparkSession, path: str | list[str], provider: Provider, rules: Rules = STRICT, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(processed, rejected) of a CSV extract, lazily.

    For first-wins in file order, classify ``with_input_position(scan_csv(...))``
    instead, as ``run`` does; without it the order is by external_id.
    """
    return process(scan_csv(spark, path, multi_line), provider, rules)


def unique_customers(accepted: DataFrame, rules: Rules = STRICT) -> DataFrame:
    """First row per customer, identified, in the processed layout.

    The identity is hashed after the first-wins step: the key determines it, so
    only survivors need it.
    """
    return identify(first_per_customer(accepted), rules).select(*PROCESSED_FIELDS)


def _write_rejects(
    classified: DataFrame, path: str, layout: Layout | None, files: int | None = None
) -> dict[str, int]:
    """Writes the rejects and counts all rows, accepted ones included, on the way.

    This write has no shuffle, so the counts come from its result tasks, which
    Spark counts exactly once even when tasks are retried or executors lost.
    """
    valid = F.col("is_valid")
    counts = Observation("classified rows")
    counted = classified.observe(
        counts,
        F.count(F.when(valid, 1)).alias("processed_count"),
        F.count(F.when(~valid, 1)).alias("rejected_count"),
        F.count(F.when(valid & F.col("name").isNull(), 1)).alias("unnamed_count"),
    )
    rejects = rejected(counted)
    if files is not None:
        rejects = rejects.repartition(files)
    write_rejected(layout(rejects) if layout else rejects, path)
    return counts.get


def _write_unique(
    accepted: DataFrame, path: str, rules: Rules, layout: Layout | None, rows_per_file: int | None
) -> dict[str, int]:
    """Writes the first row per customer and counts them behind the shuffle, again exactly once."""
    counts = Observation("unique customers")
    customers = unique_customers(accepted, rules).observe(counts, F.count(F.lit(1)).alias("unique_count"))
    write_processed(layout(customers) if layout else customers, path, rows_per_file)
    return counts.get


def run(
    spark: SparkSession,
    input_path: str | list[str],
    processed_path: str,
    rejected_path: str,
    provider: Provider,
    *,
    rules: Rules = STRICT,
    multi_line: bool = False,
    keep_raw: bool = True,
    rows_per_file: int | None = None,
    processed_layout: Layout | None = None,
    rejected_layout: Layout | None = None,
    cache: StorageLevel | None = None,
    ledger_path: str | None = None,
    rows_per_partition: int = ROWS_PER_SHUFFLE_PARTITION,
    reject_files: int | None = None,
) -> RunReport:
    """Runs one extract from CSV to both outputs and returns the report.

    A missing required column ends the run as FAILED, without output; every other
    error is raised. The ledger gets a RUNNING row at the start and the final one
    last: COMPLETED means that both outputs are there, RUNNING without another row
    of the same start that the run broke off. No path may equal or contain another.

    Under strict rules a line with more or fewer cells than the header is a reject
    of its own kind, with the line as it was read.

    Each output is written straight from its own pass over the input: parsing
    twice costs no more than storing all rows in between and reading them back.
    Both passes use the file list taken at the start. ``cache`` does keep the
    classified rows, for inputs that are slow to parse because they cannot be
    split (compressed or ``multi_line`` files).

    The layouts are applied to the rows of an output just before they are
    written, e.g. ``canonical_projection`` and ``raw_rejects``. The shuffle gets a
    partition for each ``rows_per_partition`` accepted rows. ``reject_files`` bounds
    the number of reject files, which is that of scan tasks otherwise.
    """
    check_apart(
        spark, input=input_path, processed=processed_path, rejected=rejected_path, ledger=ledger_path
    )
    check_rows_per_file(rows_per_file)
    started_at = datetime.now(UTC)

    def report(status: str, **details: object) -> RunReport:
        finished_at = None if status == RUNNING else datetime.now(UTC)
        source = input_path if isinstance(input_path, str) else ",".join(input_path)
        done = RunReport(provider.source_system, source, status, started_at, finished_at, **details)
        if ledger_path is not None:
            done.as_dataframe(spark).write.mode("append").json(ledger_path)
        return done

    report(RUNNING)
    try:
        source = with_input_position(scan_csv(spark, input_path, multi_line, keep_malformed=rules.total))
        classified = classify(source, provider, rules, keep_raw)
    except IngestionError as error:
        return report(FAILED, error=str(error))

    if cache is not None:
        classified = classified.persist(cache)
    try:
        counts = _write_rejects(classified, rejected_path, rejected_layout, reject_files)
        with settings(spark, shuffle_for(spark, counts["processed_count"], rows_per_partition)):
            counts |= _write_unique(
                processed(classified), processed_path, rules, processed_layout, rows_per_file
            )
    finally:
        if cache is not None:
            classified.unpersist()

    return report(COMPLETED, **counts)
