"""Customers across runs: a stored table of the ids that earlier runs have written."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from customer_canon.plans.paths import check_apart
from customer_canon.plans.run import COMPLETED, RunReport, run
from customer_canon.plans.store import delete, exists
from customer_canon.schema import PROCESSED_FIELDS
from customer_canon.sinks.files import check_rows_per_file, write_processed
from customer_canon.sources.providers import Provider

#: First characters of an id that name its partition: 16 of them, whatever the number of customers. Every run adds files to
#: each one. Spark lists up to 32 folders without a job; beyond, the names of all files go to the driver as results of tasks.
PREFIX_CHARS = 1

_STORED = "customer_id string, run_id string, prefix string"


def _prefix() -> Column:
    return F.substring("customer_id", 1, PREFIX_CHARS)


@dataclass(frozen=True)
class KnownCustomers:
    """Ids and the run that wrote them, as Parquet partitioned by the beginning of the id.

    Ids are hashes, so partitions are of equal size; a run reads only those that its own ids fall into.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        """``customer_id, run_id, prefix``; no rows before the first run."""
        if not exists(spark, self.path):
            return spark.createDataFrame([], _STORED)
        return spark.read.schema(_STORED).parquet(self.path)

    def unknown(self, customers: DataFrame, run_id: str) -> DataFrame:
        """The customers that no other run has stored.

        ``customers`` is read twice, first for the partitions that its ids fall into: give a written table.
        """
        prefixes = [r[0] for r in customers.select(_prefix()).distinct().collect()]
        # tables that were begun with longer prefixes are read, too
        stored = F.substring("prefix", 1, PREFIX_CHARS)
        known = self.read(customers.sparkSession).where(stored.isin(prefixes) & (F.col("run_id") != run_id))
        return customers.join(known.select("customer_id"), "customer_id", "left_anti").select(customers.columns)

    def add(self, customers: DataFrame, run_id: str) -> None:
        """Stores the ids that this run has not stored yet."""
        spark = customers.sparkSession
        stored = self.read(spark).where(F.col("run_id") == run_id).select("customer_id")
        fresh = customers.select("customer_id").distinct().join(stored, "customer_id", "left_anti")
        rows = fresh.select("customer_id", F.lit(run_id).alias("run_id"), _prefix().alias("prefix"))
        # ranges of ids: every task writes few partitions, however many tasks there are
        rows.repartitionByRange("customer_id").write.mode("append").partitionBy("prefix").parquet(self.path)


@dataclass(frozen=True)
class NewCustomersReport:
    """The report of the run, and how many of its unique customers no earlier run had written."""

    run: RunReport
    new_count: int | None = None


def run_new_customers(
    spark: SparkSession,
    input_path: str | list[str],
    processed_path: str,
    rejected_path: str,
    known_path: str,
    run_id: str,
    provider: Provider,
    *,
    rows_per_file: int | None = None,
    **options: object,
) -> NewCustomersReport:
    """As ``run``, but the processed output holds only customers that no earlier run has written.

    Outputs go to the folder ``run_id=<run_id>`` of their paths. A run that broke off, or is repeated, with the same
    ``run_id`` replaces its own folder and counts its own ids as new; any other run passes them over. Ids are stored
    after the output is written, so an id is never known without its customer.

    The unique customers are staged beside the known ids, where the partitions to be read are found, and compared by id
    alone. A layout, if given, must keep ``customer_id``. Runs that share ``known_path`` must not overlap in time.
    """
    check_apart(spark, input=input_path, processed=processed_path, rejected=rejected_path, known=known_path)
    check_rows_per_file(rows_per_file)
    layout = options.pop("processed_layout", None)
    known, staged = KnownCustomers(known_path), f"{known_path.rstrip('/')}.staged-{uuid4().hex}"
    folder = f"run_id={run_id}"
    try:
        report = run(spark, input_path, staged, f"{rejected_path}/{folder}", provider, **options)
        if report.status != COMPLETED:
            return NewCustomersReport(report)
        customers = spark.read.schema(", ".join(f"{c} string" for c in PROCESSED_FIELDS)).parquet(staged)
        counts = Observation("new customers")
        fresh = known.unknown(customers, run_id)
        known_ids = f"{staged}-ids"
        fresh = fresh.observe(counts, F.count(F.lit(1)).alias("new_count"))
        write_processed(layout(fresh) if layout else fresh, f"{processed_path}/{folder}", rows_per_file)
        new_count = counts.get["new_count"]
        # the same comparison again, on ids alone: a layout may have changed what was written
        known.unknown(customers.select("customer_id"), run_id).write.parquet(known_ids)
        known.add(spark.read.schema("customer_id string").parquet(known_ids), run_id)
        return NewCustomersReport(report, new_count)
    finally:
        for path in (staged, f"{staged}-ids"):
            delete(spark, path)
