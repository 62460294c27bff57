"""Runs whose two outputs become visible together, and which go on where they broke off.

Below a root there is one folder for each run, and one manifest for each published version:

    runs/<run_id>/processed, runs/<run_id>/rejected     outputs, not looked at by readers
    runs/<run_id>/started.json, rejects.json, processed.json   how far the run has come
    versions/<number>.json                               written last: the run that readers see

Readers follow the manifest with the largest number. Until it is there they see the pair of the version before.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from customer_canon.errors import IngestionError
from customer_canon.operators.classify import classify, processed
from customer_canon.plans.paths import check_apart
from customer_canon.plans.run import COMPLETED, FAILED, Layout, _write_rejects, _write_unique
from customer_canon.plans.settings import ROWS_PER_SHUFFLE_PARTITION, settings, shuffle_for
from customer_canon.plans.store import delete, exists, get_json, listing, names, put_json
from customer_canon.rules import STRICT, Rules
from customer_canon.sinks.files import check_rows_per_file
from customer_canon.sources.csv_scan import scan_csv, with_input_position
from customer_canon.sources.providers import Provider

_DIGITS = 12


@dataclass(frozen=True)
class Version:
    """A published pair of outputs, and the counts of the run that wrote it."""

    number: int
    run_id: str
    processed_path: str
    rejected_path: str
    counts: dict[str, int]


@dataclass(frozen=True)
class PublishedReport:
    """What a run did: its version, and which steps an earlier attempt had done already."""

    status: str
    error: str | None = None
    version: Version | None = None
    resumed: tuple[str, ...] = ()


def _version(root: str, number: int, manifest: dict) -> Version:
    folder = f"{root}/runs/{manifest['run_id']}"
    return Version(number, manifest["run_id"], f"{folder}/processed", f"{folder}/rejected", manifest["counts"])


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, f"{root}/versions") if n[0].isdigit()]


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All published versions that are still there, the latest last."""
    root = root.rstrip("/")
    found = [(n, get_json(spark, f"{root}/versions/{n:0{_DIGITS}}.json")) for n in _numbers(spark, root)]
    return [_version(root, n, manifest) for n, manifest in found if manifest]


def latest(spark: SparkSession, root: str) -> Version | None:
    """The version to read; None before the first one."""
    return next(reversed(versions(spark, root)), None)


def _fingerprint(spark: SparkSession, path: str | list[str], *choices: object) -> str:
    """Tells whether input files, provider, rules or options differ from those of an earlier attempt."""
    return hashlib.sha256(repr((listing(spark, path), *choices)).encode()).hexdigest()


def _keep(spark: SparkSession, root: str, kept: int) -> None:
    """Deletes the versions before the last ``kept`` ones: their manifests first, so that nobody finds their folders."""
    for old in versions(spark, root)[:-kept]:
        delete(spark, f"{root}/versions/{old.number:0{_DIGITS}}.json")
        delete(spark, f"{root}/runs/{old.run_id}")


def run_published(
    spark: SparkSession,
    input_path: str | list[str],
    root: str,
    run_id: str,
    provider: Provider,
    *,
    rules: Rules = STRICT,
    multi_line: bool = False,
    keep_raw: bool = True,
    rows_per_file: int | None = None,
    processed_layout: Layout | None = None,
    rejected_layout: Layout | None = None,
    rows_per_partition: int = ROWS_PER_SHUFFLE_PARTITION,
    reject_files: int | None = None,
    keep_versions: int | None = None,
) -> PublishedReport:
    """As ``run``, but readers of ``root`` see both outputs at once, with ``latest``, or those of the version before.

    Repeated under the same ``run_id``, a run that broke off goes on: an output that was finished from the same files,
    provider and options is not written again, one that was not is replaced, and one that is published already is left
    as it is. With other files, lengths or times of change, another provider, rules or options it starts anew, or is a
    ValueError if it is published; layouts and ``prepare`` are told by their names only. ``resumed`` names the steps that
    were not repeated.

    A missing required column ends the run as FAILED; nothing is published. ``keep_versions`` deletes older versions
    with their outputs, which breaks readers that still read them. Runs with different ids may overlap; where two publish at
    the same moment, one takes the next number, if the storage does not overwrite when renaming. Attempts at one
    run must not overlap.
    """
    root = root.rstrip("/")
    check_apart(spark, input=input_path, root=root)
    check_rows_per_file(rows_per_file)
    if not run_id or "/" in run_id or run_id.startswith((".", "_")):
        raise ValueError(f"run_id must be the name of a folder: {run_id!r}")
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep_versions must be at least one")
    layouts = [getattr(layout, "__qualname__", repr(layout)) for layout in (processed_layout, rejected_layout)]
    prepare = getattr(provider.prepare, "__qualname__", repr(provider.prepare))
    fingerprint = _fingerprint(
        spark, input_path, provider.source_system, sorted(provider.mapping.items()), prepare, rules, multi_line,
        keep_raw, rows_per_file, layouts, reject_files,
    )
    folder = f"{root}/runs/{run_id}"
    earlier = get_json(spark, f"{folder}/started.json")
    published = next((v for v in reversed(versions(spark, root)) if v.run_id == run_id), None)
    if earlier and earlier["fingerprint"] == fingerprint:
        if published:
            return PublishedReport(COMPLETED, None, published, ("rejects", "processed", "published"))
    elif published:
        raise ValueError(f"run {run_id} is published and was made from something else; give another run_id")
    elif exists(spark, folder):
        delete(spark, folder)
        earlier = None

    try:
        source = with_input_position(scan_csv(spark, input_path, multi_line, keep_malformed=rules.total))
        classified = classify(source, provider, rules, keep_raw)
    except IngestionError as error:
        return PublishedReport(FAILED, str(error))
    if not earlier:
        put_json(spark, f"{folder}/started.json", {"fingerprint": fingerprint})

    resumed = []

    def step(name: str, write) -> dict[str, int]:
        marker = f"{folder}/{name}.json"
        done = get_json(spark, marker)
        if done is not None:
            resumed.append(name)
            return done
        counts = write()
        put_json(spark, marker, counts)
        return counts

    counts = step("rejects", lambda: _write_rejects(classified, f"{folder}/rejected", rejected_layout, reject_files))
    with settings(spark, shuffle_for(spark, counts["processed_count"], rows_per_partition)):
        unique = step(
            "processed",
            lambda: _write_unique(
                processed(classified), f"{folder}/processed", rules, processed_layout, rows_per_file
            ),
        )
    version = _publish(spark, root, run_id, counts | unique)
    if keep_versions is not None:
        _keep(spark, root, keep_versions)
    return PublishedReport(COMPLETED, None, version, tuple(resumed))


def _publish(spark: SparkSession, root: str, run_id: str, counts: dict[str, int]) -> Version:
    """Writes the next manifest; where another run has just taken the number, the one after."""
    manifest = {"run_id": run_id, "counts": counts}
    number = max(_numbers(spark, root), default=0) + 1
    while True:
        try:
            put_json(spark, f"{root}/versions/{number:0{_DIGITS}}.json", manifest)
            return _version(root, number, manifest)
        except FileExistsError:
            number += 1


def read_published(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame | None:
    """Customers of the latest version; None before the first one. ``schema`` spares a look into the files."""
    version = latest(spark, root)
    if version is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(version.processed_path)
