"""Customers from files that keep arriving in a folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from customer_canon.errors import IngestionError
from customer_canon.plans.known import run_new_customers
from customer_canon.plans.paths import check_apart
from customer_canon.plans.run import FAILED
from customer_canon.plans.store import get_json, put_json
from customer_canon.sources.providers import Provider

_FILES = "path string, modificationTime timestamp, length long, content binary"


def _literal(path: str) -> str:
    """The path as a pattern that names this file alone."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def batch_run_id(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def run_arriving(
    spark: SparkSession,
    input_folder: str,
    processed_path: str,
    rejected_path: str,
    known_path: str,
    progress_path: str,
    provider: Provider,
    *,
    name_filter: str = "*.csv",
    files_per_batch: int = 1000,
    skip_failed: bool = False,
    once: bool = True,
    interval: str = "1 minute",
    **options: object,
) -> StreamingQuery:
    """Every file that appears in the folder goes through ``run_new_customers``, together with those found with it.

    The stream carries file names alone (contents are not read by it); each batch of at most ``files_per_batch`` files is
    a run of its own with the id ``batch-<number>``. What was read is kept below ``progress_path``, so that a stream
    which is started again goes on behind its last batch. A batch that broke off, or is played again, replaces its own
    outputs and counts its own ids as new, so nothing is written twice. A file must appear whole (moved into the folder) and
    is read once, under the name it has: changes to it are not seen.

    ``once`` takes what is there, in as many batches as it needs, and ends; otherwise the folder is looked at in each
    ``interval`` until the query is stopped. A batch without a required column ends the stream with an error, and is tried
    again at the next start; with ``skip_failed`` it is put down as failed in ``batches/`` below ``progress_path`` and passed
    over. All files of a batch must share one header, as in ``run``: for files that do not, set ``files_per_batch`` to 1.
    Files without rows give empty outputs. Other options are those of ``run``.
    """
    check_apart(
        spark, input=input_folder, processed=processed_path, rejected=rejected_path, known=known_path, progress=progress_path
    )
    if files_per_batch < 1:
        raise ValueError("files_per_batch must be at least one")
    progress = progress_path.rstrip("/")

    def take(batch: DataFrame, batch_id: int) -> None:
        # as many names as files_per_batch allows
        files = sorted(row.path for row in batch.select("path").collect())
        if not files:
            return
        marker = f"{progress}/batches/{batch_run_id(batch_id)}.json"
        names = hashlib.sha256("\n".join(files).encode()).hexdigest()
        if (done := get_json(spark, marker)) is not None:
            if done["names"] != names:
                raise ValueError(f"{marker} is of another stream; give another progress_path and other outputs")
            return
        # the session of the caller: that of the batch has no adaptive execution
        done = run_new_customers(
            spark, [_literal(f) for f in files], processed_path, rejected_path, known_path, batch_run_id(batch_id),
            provider, **options,
        )
        if done.run.status == FAILED and not skip_failed:
            raise IngestionError(f"{done.run.error} (batch {batch_id}: {files[0]} and {len(files) - 1} more)")
        counts = {"processed": done.run.processed_count, "rejected": done.run.rejected_count, "new": done.new_count}
        put_json(
            spark, marker,
            {"status": done.run.status, "error": done.run.error, "files": len(files), "names": names, **counts},
        )

    arriving = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", name_filter)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(input_folder)
        .select("path")
    )
    writer = arriving.writeStream.foreachBatch(take).option("checkpointLocation", f"{progress}/stream")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
