"""Every operator as a query over whole test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.extracts import extract, skewed_extract, write_csv
from checks.scratch import drop_folder, scratch_folder
from customer_canon.functions import clean_tax_id, country_code, identity_key, tax_id_is_valid
from customer_canon.operators import (
    any_per_customer,
    carried_columns,
    change_set,
    classify,
    first_by_source,
    first_per_customer,
    identify,
    lineage,
    map_columns,
    merge_per_customer,
    process,
    required_source_fields,
    transform,
    with_provenance,
)
from customer_canon.plans.arriving import run_arriving
from customer_canon.plans.job import JobArgs, run_job
from customer_canon.plans.known import run_new_customers
from customer_canon.plans.published import latest, run_published
from customer_canon.plans.run import process_csv, run, unique_customers
from customer_canon.plans.several import run_sources
from customer_canon.rules import DF_PARITY, Rules
from customer_canon.schema import (
    CANONICAL_FIELDS,
    CANONICAL_PROJECTION_FIELDS,
    PROCESSED_FIELDS,
    REJECTED_FIELDS,
    raw_rejects_schema,
    rejected_schema,
    text_schema,
)
from customer_canon.sinks import (
    canonical_projection,
    raw_rejects,
    read_processed,
    read_rejected,
    write_processed,
    write_rejected,
)
from customer_canon.sources import PROVIDERS, provider_for, scan_csv

Query = Callable[[SparkSession, str], DataFrame]

SOURCES = tuple(PROVIDERS)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _per_source(build: Callable[[DataFrame, str], DataFrame]) -> Query:
    """One result over all three extracts, each row tagged with its source system."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _union(
            [build(extract(spark, sf_dir, s), s).withColumn("source_system", F.lit(s)) for s in SOURCES]
        )

    return query


_EXTRACTS: dict[tuple, str] = {}


def _csv(spark: SparkSession, sf_dir: str, source_system: str, *, in_order: bool = False, drop: str = "") -> str:
    """The folder of an extract as CSV, optionally from the last id to the first; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, source_system, in_order, drop)
    if key not in _EXTRACTS:
        folder = scratch_folder(spark, f"extract-{source_system}")
        frame = extract(spark, sf_dir, source_system).drop(drop)
        first = provider_for(source_system).mapping["external_id"]
        write_csv(frame, folder, [F.col(first).desc()] if in_order else ())
        _EXTRACTS[key] = folder
    return _EXTRACTS[key]


# --- mapping and functions ---------------------------------------------------


def _map_source(source_system: str) -> Query:
    return lambda spark, sf_dir: map_columns(extract(spark, sf_dir, source_system), provider_for(source_system))


def map_missing_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(extract(spark, sf_dir, "ERP_B").drop("contact_email"), provider_for("ERP_B"))


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = [
        with_provenance(process(extract(spark, sf_dir, s), provider_for(s))[0], provider_for(s)) for s in SOURCES
    ]
    return _union(wrapped).select("source_system", "external_id", "customer.*")


@_per_source
def normalize_country(source: DataFrame, source_system: str) -> DataFrame:
    country = F.col("country")
    mapped = map_columns(source, provider_for(source_system))
    return mapped.select("external_id", country.alias("source_country"), country_code(country).alias("country"))


@_per_source
def normalize_tax_id(source: DataFrame, source_system: str) -> DataFrame:
    mapped = map_columns(source, provider_for(source_system))
    code = country_code(F.col("country"))
    return mapped.select(
        "external_id", F.col("tax_id").alias("source_tax_id"), clean_tax_id(F.col("tax_id"), code).alias("tax_id")
    )


@_per_source
def transformed(source: DataFrame, source_system: str) -> DataFrame:
    return transform(source, provider_for(source_system))


@_per_source
def validate_tax_id(source: DataFrame, source_system: str) -> DataFrame:
    canonical = transform(source, provider_for(source_system))
    verdict = tax_id_is_valid(F.col("tax_id"), F.col("country"))
    text = F.when(verdict, "valid").when(~verdict, "invalid").otherwise("unknown")
    return canonical.select("external_id", "tax_id", "country", text.alias("verdict"))


# --- routing -----------------------------------------------------------------


@_per_source
def processed_rows(source: DataFrame, source_system: str) -> DataFrame:
    return process(source, provider_for(source_system))[0]


@_per_source
def rejected_rows(source: DataFrame, source_system: str) -> DataFrame:
    return process(source, provider_for(source_system))[1].select(*REJECTED_FIELDS)


def rejected_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = process(extract(spark, sf_dir, "ERP_B"), provider_for("ERP_B"))[1]
    return raw_rejects(rejects).select(
        "raw_record.*", "reason", F.to_json("raw_record", {"ignoreNullFields": "false"}).alias("raw_json")
    )


@_per_source
def processed_df_parity(source: DataFrame, source_system: str) -> DataFrame:
    return identify(process(source, provider_for(source_system), DF_PARITY)[0], DF_PARITY)


@_per_source
def rejected_df_parity(source: DataFrame, source_system: str) -> DataFrame:
    return process(source, provider_for(source_system), DF_PARITY)[1].select(*CANONICAL_FIELDS, "reason")


@_per_source
def outcome_counts(source: DataFrame, source_system: str) -> DataFrame:
    classified = classify(source, provider_for(source_system), keep_raw=False)
    outcome = F.coalesce("reason", F.lit("processed")).alias("outcome")
    return classified.groupBy(outcome).agg(F.count(F.lit(1)).alias("row_count"))


@_per_source
def required_fields(source: DataFrame, source_system: str) -> DataFrame:
    """Source columns of an extract, whether each is required, and how many rows have it filled."""
    mapping = provider_for(source_system).mapping
    required = required_source_fields(provider_for(source_system))
    filled = source.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(column).alias(column) for column in mapping.values()]
    )
    per_column = filled.unpivot("row_count", list(mapping.values()), "source_column", "filled_count")
    return per_column.withColumn("required", F.col("source_column").isin(*sorted(required)).cast("int"))


# --- identity and first-wins -------------------------------------------------


@_per_source
def identity_keys(source: DataFrame, source_system: str) -> DataFrame:
    accepted = process(source, provider_for(source_system))[0]
    return accepted.select("external_id", identity_key(F.col("country"), F.col("tax_id")).alias("identity_key"))


@_per_source
def customer_ids(source: DataFrame, source_system: str) -> DataFrame:
    return identify(process(source, provider_for(source_system))[0]).select("external_id", "customer_id")


@_per_source
def dedup_count(source: DataFrame, source_system: str) -> DataFrame:
    unique = any_per_customer(identify(process(source, provider_for(source_system))[0]))
    return unique.agg(F.count(F.lit(1)).alias("customer_count"))


@_per_source
def dedup_first_wins(source: DataFrame, source_system: str) -> DataFrame:
    return unique_customers(process(source, provider_for(source_system))[0])


def first_wins_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = process(skewed_extract(spark, sf_dir), provider_for("ERP_A"))
    return unique_customers(accepted)


@_per_source
def canonical(source: DataFrame, source_system: str) -> DataFrame:
    return canonical_projection(unique_customers(process(source, provider_for(source_system))[0]))


# --- files and whole runs ----------------------------------------------------


def scan_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, _csv(spark, sf_dir, "ERP_B"))


def csv_to_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_csv(spark, _csv(spark, sf_dir, "ERP_C"), provider_for("ERP_C"))[0]


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "processed")
    customers = unique_customers(process(extract(spark, sf_dir, "ERP_B"), provider_for("ERP_B"))[0])
    write_processed(customers, folder, rows_per_file=1000)
    return read_processed(spark, folder)


def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "rejected")
    source = extract(spark, sf_dir, "ERP_B")
    write_rejected(process(source, provider_for("ERP_B"))[1], folder)
    back = read_rejected(spark, folder, rejected_schema(tuple(source.columns)))
    return back.select(*REJECTED_FIELDS, *[F.col(f"raw_record.{c}").alias(f"raw_{c}") for c in source.columns])


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after four runs: one per source system, and one that lacks a required column."""
    out = scratch_folder(spark, "ledger")
    inputs = [(s, _csv(spark, sf_dir, s)) for s in SOURCES]
    inputs.append(("ERP_B", _csv(spark, sf_dir, "ERP_B", drop="vat_number")))
    reports = [
        run(spark, path, f"{out}/{n}/processed", f"{out}/{n}/rejected", provider_for(source_system))
        for n, (source_system, path) in enumerate(inputs)
    ]
    drop_folder(spark, out)
    ledger = _union([report.as_dataframe(spark) for report in reports])
    return ledger.select(
        "source_system", "status", "error", "processed_count", "rejected_count", "unique_count", "unnamed_count"
    )


def job_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of one job per source system, read back from disk."""
    outputs = []
    for source_system in SOURCES:
        out = scratch_folder(spark, "job")
        source_path = _csv(spark, sf_dir, source_system, in_order=True)
        run_job(spark, JobArgs(source_system, source_path, f"{out}/processed", f"{out}/rejected"))
        customers = read_processed(spark, f"{out}/processed")
        source_columns = tuple(provider_for(source_system).mapping.values())
        rejects = read_rejected(spark, f"{out}/rejected", rejected_schema(source_columns)).select(*REJECTED_FIELDS)
        for outcome, frame in (("processed", customers), ("rejected", rejects)):
            tags = {"outcome": F.lit(outcome), "source_system": F.lit(source_system)}
            outputs.append(frame.withColumns(tags))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), outputs)


def job_source_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose outputs hold customers without source ids, and rejects as untouched source records."""
    out = scratch_folder(spark, "job")
    provider = provider_for("ERP_A")
    source_path = _csv(spark, sf_dir, "ERP_A", in_order=True)
    run(
        spark, source_path, f"{out}/processed", f"{out}/rejected", provider,
        processed_layout=canonical_projection, rejected_layout=raw_rejects,
    )
    customers = read_processed(spark, f"{out}/processed", text_schema(CANONICAL_PROJECTION_FIELDS))
    rejects = read_rejected(spark, f"{out}/rejected", raw_rejects_schema(tuple(provider.mapping.values())))
    flat = rejects.select("reason", F.col("raw_record.customer_id").alias("external_id"), "raw_record.tax_id")
    return customers.unionByName(flat, allowMissingColumns=True)


@_per_source
def processed_any_country(source: DataFrame, source_system: str) -> DataFrame:
    return process(source, provider_for(source_system), Rules(on_unsupported_country="pass"))[0]


def scan_csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with quotes, commas and line breaks, written and scanned."""
    folder = scratch_folder(spark, "multi-line")
    name = F.concat(F.lit('"'), "customer_name", F.lit('", a\nb,"",'))
    write_csv(extract(spark, sf_dir, "ERP_C").withColumn("customer_name", name), folder)
    return scan_csv(spark, folder, multi_line=True)


def provider_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose provider changes cells first: survivors by file order, rejects with the cells of the file."""

    def shouting(source: DataFrame) -> DataFrame:
        own = ["client_code", F.upper("legal_name").alias("legal_name"), F.ltrim("vat_number").alias("vat_number")]
        return source.select(*own, "country", "contact_email", *carried_columns(source))

    provider = replace(provider_for("ERP_B"), prepare=shouting)
    out, source_path = scratch_folder(spark, "job"), _csv(spark, sf_dir, "ERP_B", in_order=True)
    run(spark, source_path, f"{out}/processed", f"{out}/rejected", provider)
    schema = rejected_schema(tuple(provider.mapping.values()))
    rejects = read_rejected(spark, f"{out}/rejected", schema).select(
        *CANONICAL_FIELDS, "reason", F.col("raw_record.legal_name").alias("raw_name"), "raw_record.vat_number"
    )
    return read_processed(spark, f"{out}/processed").unionByName(rejects, allowMissingColumns=True)


def rejected_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a run over lines of which two in seven have a cell too many or too few."""
    out, source_path = scratch_folder(spark, "job"), scratch_folder(spark, "lines")
    provider = provider_for("ERP_B")
    names = list(provider.mapping.values())
    cells = [F.coalesce(F.col(c), F.lit("")) for c in names]
    row = F.substr("client_code", F.lit(2)).cast("long") % 7
    line = F.when(row == 0, F.concat_ws(",", *cells, F.lit("extra"))).when(row == 1, F.concat_ws(",", *cells[:3]))
    lines = extract(spark, sf_dir, "ERP_B").select(line.otherwise(F.concat_ws(",", *cells)).alias(",".join(names)))
    write_csv(lines, source_path, separator="\u0001")
    run(spark, source_path, f"{out}/processed", f"{out}/rejected", provider)
    drop_folder(spark, source_path)
    schema = rejected_schema(tuple(names)).add("raw_line", "string")
    return read_rejected(spark, f"{out}/rejected", schema).select("external_id", "reason", "raw_line")


# --- several runs, several sources -------------------------------------------

#: Suppliers before customers before orders.
PRIORITY = ("ERP_C", "ERP_A", "ERP_B")


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [process(extract(spark, sf_dir, s), provider_for(s))[0].withColumn("source_system", F.lit(s)) for s in SOURCES]
    return _union(frames)


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer over all three sources, by priority."""
    return identify(first_by_source(_accepted(spark, sf_dir), PRIORITY)).drop("reason", "reason_detail")


def lineage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(_accepted(spark, sf_dir), PRIORITY)


def new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a second run, over orders, that the first one, over suppliers, has not written."""
    out = scratch_folder(spark, "known")
    for source in ("ERP_C", "ERP_B"):
        folders = (f"{out}/processed", f"{out}/rejected", f"{out}/known")
        run_new_customers(spark, _csv(spark, sf_dir, source), *folders, source, provider_for(source))
    return read_processed(spark, f"{out}/processed/run_id=ERP_B").select("customer_id", "tax_id", "country")


def sources_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of one run over the files of all three sources: which source each customer comes from."""
    out = scratch_folder(spark, "sources")
    inputs = {s: _csv(spark, sf_dir, s) for s in PRIORITY}
    run_sources(spark, inputs, f"{out}/processed", f"{out}/rejected", lineage_path=f"{out}/lineage")
    return spark.read.parquet(f"{out}/lineage").select("customer_id", "source_system", "external_id", "survivor_system")


def merged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer over all three sources, its name and email from the first row that has them."""
    return merge_per_customer(_accepted(spark, sf_dir), PRIORITY)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From customers without those named "..7" to suppliers and customers with an email."""
    accepted = _accepted(spark, sf_dir)
    customers = F.col("source_system") == "ERP_A"
    later = accepted.where((F.col("source_system") == "ERP_C") | (customers & F.col("email").isNotNull()))
    earlier = accepted.where(customers & ~F.col("name").endswith("7"))
    before, after = first_per_customer(earlier), first_by_source(later, PRIORITY)
    return change_set(*[identify(rows).select(*PROCESSED_FIELDS) for rows in (before, after)])


def published_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of the latest of two published runs, the second of them asked for twice."""
    root = scratch_folder(spark, "published")
    for source in ("ERP_C", "ERP_B", "ERP_B"):
        run_published(spark, _csv(spark, sf_dir, source, in_order=True), root, source, provider_for(source))
    version = latest(spark, root)
    columns = tuple(provider_for(version.run_id).mapping.values())
    rejects = read_rejected(spark, version.rejected_path, rejected_schema(columns)).select(*REJECTED_FIELDS)
    rows = read_processed(spark, version.processed_path).unionByName(rejects, allowMissingColumns=True)
    return rows.withColumn("version", F.lit(version.number))


def arriving_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the files of one extract, taken as a stream of two files at a time, and again from the start."""
    out = scratch_folder(spark, "arriving")
    folders = [f"{out}/{name}" for name in ("processed", "rejected", "known")]
    for _ in range(2):
        run_arriving(
            spark, _csv(spark, sf_dir, "ERP_B"), *folders, f"{out}/progress", provider_for("ERP_B"), files_per_batch=2
        ).awaitTermination()
    return read_processed(spark, folders[0]).select("customer_id", "tax_id", "country")


QUERIES: dict[str, Query] = {
    "map_source_a": _map_source("ERP_A"),
    "map_source_b": _map_source("ERP_B"),
    "map_source_c": _map_source("ERP_C"),
    "map_missing_email": map_missing_email,
    "provenance": provenance,
    "normalize_country": normalize_country,
    "normalize_tax_id": normalize_tax_id,
    "transform": transformed,
    "validate_tax_id": validate_tax_id,
    "processed": processed_rows,
    "rejected": rejected_rows,
    "rejected_raw": rejected_raw,
    "processed_df_parity": processed_df_parity,
    "rejected_df_parity": rejected_df_parity,
    "outcome_counts": outcome_counts,
    "required_fields": required_fields,
    "identity_key": identity_keys,
    "customer_id": customer_ids,
    "dedup_count": dedup_count,
    "dedup_first_wins": dedup_first_wins,
    "first_wins_skewed": first_wins_skewed,
    "canonical_projection": canonical,
    "scan_csv": scan_csv_rows,
    "csv_to_processed": csv_to_processed,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "sink_json_roundtrip": sink_json_roundtrip,
    "run_ledger": run_ledger,
    "job_end_to_end": job_end_to_end,
    "job_source_layout": job_source_layout,
    "processed_any_country": processed_any_country,
    "scan_csv_multi_line": scan_csv_multi_line,
    "provider_prepare": provider_prepare,
    "rejected_malformed": rejected_malformed,
    "survivors_by_source": survivors,
    "lineage": lineage_rows,
    "new_customers": new_customers,
    "sources_run": sources_run,
    "merged_fields": merged_fields,
    "change_set": changes,
    "published_run": published_run,
    "arriving_files": arriving_files,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unique, identified customers of the order-grain extract."""
    return unique_customers(process(extract(spark, sf_dir, "ERP_B"), provider_for("ERP_B"))[0])
