"""CSV scanning, sinks and whole runs, on files."""

import io
import json
from concurrent.futures import ThreadPoolExecutor
from contextlib import redirect_stdout
from operator import attrgetter, itemgetter
from pathlib import Path

import pytest
from pyspark import StorageLevel
from pyspark.errors import PySparkException

from checks.extracts import extract, skewed_extract, write_csv
from checks.scratch import drop_folder, scratch_folder
from customer_canon import DF_PARITY, IngestionError, process_csv, provider_for, run
from customer_canon.plans.job import JobArgs, main, run_job
from customer_canon.plans.settings import ROWS_PER_SHUFFLE_PARTITION, settings, shuffle_for
from customer_canon.schema import (
    CANONICAL_PROJECTION_FIELDS,
    LEDGER,
    PROCESSED_FIELDS,
    REJECTED_FIELDS,
    rejected_schema,
)
from customer_canon.sinks import canonical_projection, raw_rejects, read_rejected, write_processed, write_rejected
from customer_canon.sources.csv_scan import scan_csv, with_input_position

A, B, C = map(provider_for, ("ERP_A", "ERP_B", "ERP_C"))
B_HEADER = "client_code,legal_name,vat_number,country,contact_email\n"
A_HEADER = "customer_id,name,tax_id,country,email\n"


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "processed"), str(tmp_path / "rejected")


def put(path, text, name="part-0.csv"):
    folder = Path(path)
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


def parquet_rows(spark, path):
    return [r.asDict() for r in spark.read.parquet(path).collect()]


def json_rows(path):
    return [json.loads(line) for f in Path(path).glob("*.json") for line in f.read_text("utf-8").splitlines()]


# --- scan --------------------------------------------------------------------


def test_scan_keeps_text_as_it_is(spark, tmp_path):
    put(tmp_path / "x", B_HEADER + '0001, padded ,1.0,Spain,\n"0""2","a,b","",x,y\n')
    rows = [tuple(r) for r in scan_csv(spark, str(tmp_path / "x")).collect()]
    assert rows == [("0001", " padded ", "1.0", "Spain", None), ('0"2', "a,b", None, "x", "y")]


def test_scan_short_long_and_blank_lines(spark, tmp_path):
    put(tmp_path / "x", A_HEADER + "1,a\n\n2,b,c,d,e,extra\n")
    rows = sorted(tuple(r) for r in scan_csv(spark, str(tmp_path / "x")).collect())
    assert rows == [("1", "a", None, None, None), ("2", "b", "c", "d", "e")]


def test_scan_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path / "x", A_HEADER + '1,"two\nlines",t,ES,e\n')
    rows = scan_csv(spark, str(tmp_path / "x"), multi_line=True).collect()
    assert [r.name for r in rows] == ["two\nlines"]


@pytest.mark.parametrize("multi_line", [False, True])
def test_scan_byte_order_mark(spark, tmp_path, multi_line):
    put(tmp_path / "x", "﻿" + A_HEADER + "1,a,B12345678,ES,e\n")
    good, _ = process_csv(spark, str(tmp_path / "x"), A, multi_line=multi_line)
    assert good.first().external_id == "1"


def test_files_with_another_header_fail(spark, tmp_path):
    put(tmp_path / "x", A_HEADER + "1,a,B12345678,ES,e\n", "a.csv")
    put(tmp_path / "x", "customer_id,tax_id,name,country,email\n2,B12345678,b,ES,e\n", "b.csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        process_csv(spark, str(tmp_path / "x"), A)[0].collect()


@pytest.mark.parametrize(
    ("text", "missing"),
    [
        ("", "country, customer_id, name, tax_id"),
        ("customer_id,name,tax_id,country,country\n1,a,b,c,d\n", "country"),
        ("customer_id,Name,tax_id,country\n1,a,b,c\n", "name"),
    ],
    ids=["empty file", "duplicate header", "other case"],
)
def test_unusable_headers(spark, tmp_path, text, missing):
    put(tmp_path / "x", text)
    with pytest.raises(IngestionError, match=f"^Missing required fields: {missing}$"):
        process_csv(spark, str(tmp_path / "x"), A)


@pytest.mark.parametrize("more", [",note,NOTE", ",", ",,note"], ids=["repeated", "blank", "both"])
@pytest.mark.parametrize("multi_line", [False, True])
def test_odd_names_of_unmapped_columns_do_no_harm(spark, paths, more, multi_line):
    source, processed, rejected = paths
    cells = ",x" * more.count(",")
    put(source, A_HEADER.strip() + more + f"\n1,a,B12345678,ES,e{cells}\n2,b,B1,ES,e{cells}\n")
    report = run(spark, source, processed, rejected, A, multi_line=multi_line)
    assert (report.processed_count, report.rejected_count) == (1, 1)


def test_input_position_follows_the_file_whatever_the_splits(spark, tmp_path):
    lines = [f"{i:06d},n{i},B{i % 50:08d},ES,e{i}\n" for i in range(3000)]
    put(tmp_path / "x", A_HEADER + "".join(lines[:2000]), "a.csv")
    put(tmp_path / "x", A_HEADER + "".join(lines[2000:]), "b.csv")
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    with settings(spark, small):
        scan = with_input_position(scan_csv(spark, str(tmp_path / "x")))
        assert scan.rdd.getNumPartitions() > 10
        ids = [r.customer_id for r in scan.orderBy("__input_position").collect()]
    assert ids == [f"{i:06d}" for i in range(3000)]


def test_scan_reads_mapped_columns_only(spark, tmp_path):
    put(tmp_path / "x", "extra," + A_HEADER + "x,1,a,B12345678,ES,e\n")
    good, _ = process_csv(spark, str(tmp_path / "x"), A)
    out = io.StringIO()
    with redirect_stdout(out):
        good.explain("formatted")
    schema = "struct<customer_id:string,name:string,tax_id:string,country:string,email:string>"
    assert f"ReadSchema: {schema}" in out.getvalue()
    assert good.first().external_id == "1"


NUMBERED = "customer_id,phone1,phone2,name,tax_id,country,email\n"


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize(
    ("header", "cells"),
    [(NUMBERED, "1,2"), (NUMBERED.replace("phone1,phone2", "note,NOTE"), "1,2"), (NUMBERED.replace("phone1,phone2", ","), ",")],
    ids=["numbered", "repeated", "blank"],
)
def test_header_check_holds_for_names_like_those_spark_makes_up(spark, paths, header, cells, multi_line):
    source, processed, rejected = paths
    put(source, header + f"a,{cells},ann,B12345678,ES,\n", "a.csv")
    put(source, header + f"b,{cells},bob,B22222222,ES,\n", "b.csv")
    assert run(spark, source, processed, rejected, A, multi_line=multi_line).unique_count == 2
    swapped = header.replace("name,tax_id", "tax_id,name")
    put(source, swapped + f"b,{cells},B22222222,bob,ES,\n", "b.csv")
    try:
        report = run(spark, source, processed, rejected, A, multi_line=multi_line)
        assert (report.status, report.error) == ("FAILED", "CSV headers differ between files")
    except PySparkException as error:
        assert "CSV header does not conform" in str(error)


# --- sinks -------------------------------------------------------------------


def test_rejects_keep_nulls_and_survive_being_empty(spark, tmp_path):
    schema = rejected_schema(("client_code", "country"))
    row = ("C2", None, "B1", "ES", None, "Invalid tax ID", "Invalid tax ID for country ES", ("C2", None))
    path = str(tmp_path / "one")
    write_rejected(spark.createDataFrame([row], schema), path)
    (data,) = json_rows(path)
    assert data["email"] is None and data["raw_record"] == {"client_code": "C2", "country": None}
    write_rejected(raw_rejects(spark.createDataFrame([row], schema)), str(tmp_path / "raw"))
    assert json_rows(tmp_path / "raw") == [
        {"raw_record": {"client_code": "C2", "country": None}, "reason": "Invalid tax ID for country ES"}
    ]
    write_rejected(spark.createDataFrame([], schema), path)
    back = read_rejected(spark, path, schema)
    assert back.columns == [*REJECTED_FIELDS, "raw_record"] and back.count() == 0


def test_rows_per_file(spark, tmp_path):
    frame = spark.range(5).coalesce(1)
    write_processed(frame, str(tmp_path / "x"), rows_per_file=2)
    assert len(list((tmp_path / "x").glob("*.parquet"))) == 3
    with pytest.raises(ValueError, match="rows_per_file"):
        write_processed(frame, str(tmp_path / "x"), rows_per_file=0)


# --- runs --------------------------------------------------------------------


def test_run_writes_both_outputs(spark, paths):
    source, processed, rejected = paths
    put(
        source,
        B_HEADER
        + "K-7,Molinos Sur,es x71-004 28q,Spain,caja@molinos.example\n"
        + "K-9,Molinos del Sur,X7100428Q,ES,\n"
        + "K-3,Ferro, 77-1 ,ES,a@ferro.example\n",
    )
    report = run(spark, source, processed, rejected, B)
    assert parquet_rows(spark, processed) == [
        {
            "external_id": "K-7",
            "name": "Molinos Sur",
            "tax_id": "X7100428Q",
            "country": "ES",
            "email": "caja@molinos.example",
            "customer_id": "a632f193-0d38-5cee-93c9-8487479f0e8d",
        }
    ]
    (reject,) = json_rows(rejected)
    assert (reject["external_id"], reject["tax_id"], reject["reason"]) == ("K-3", "771", "Invalid tax ID")
    assert reject["raw_record"]["vat_number"] == " 77-1 "
    assert (report.status, report.source_system, report.input_source) == ("COMPLETED", "ERP_B", source)
    assert (report.processed_count, report.rejected_count, report.unique_count) == (2, 1, 1)
    assert report.started_at <= report.finished_at and report.error is None


def test_run_on_a_single_file_keeps_the_first_in_file_order(spark, paths):
    source, processed, rejected = paths
    put(source, A_HEADER + "Z9,ACME S.L.,B12345678,ES,\nA1,ACME Sociedad Limitada,B12345678,ES,\n")
    run(spark, f"{source}/part-0.csv", processed, rejected, A)
    assert [r["name"] for r in parquet_rows(spark, processed)] == ["ACME S.L."]


def test_run_without_required_column_writes_nothing(spark, paths, tmp_path):
    source, processed, rejected = paths
    put(source, "client_code,legal_name,country,contact_email\n0001,ACME S.L.,Spain,info@acme.es\n")
    ledger = str(tmp_path / "ledger")
    report = run(spark, source, processed, rejected, B, ledger_path=ledger)
    assert (report.status, report.error) == ("FAILED", "Missing required fields: vat_number")
    assert report.processed_count is None
    assert not Path(processed).exists() and not Path(rejected).exists()
    assert sorted(r.status for r in spark.read.schema(LEDGER).json(ledger).collect()) == ["FAILED", "RUNNING"]


def test_technical_errors_are_raised(spark, paths, tmp_path):
    ledger = tmp_path / "ledger"
    with pytest.raises(PySparkException):
        run(spark, *paths, B, ledger_path=str(ledger))
    assert [r.status for r in spark.read.schema(LEDGER).json(str(ledger)).collect()] == ["RUNNING"]


def test_run_with_header_only(spark, paths):
    source, processed, rejected = paths
    put(source, A_HEADER)
    report = run(spark, source, processed, rejected, A)
    assert (report.status, report.processed_count, report.rejected_count, report.unique_count) == ("COMPLETED", 0, 0, 0)
    assert spark.read.parquet(processed).columns == list(PROCESSED_FIELDS)
    assert json_rows(rejected) == []


def test_run_options(spark, paths):
    source, processed, rejected = paths
    put(source, A_HEADER + '1,"a\nb",B12345678,ES,\n2,b,B87654321,ES,\n3,c,B1,ES,\n4,,X1,FR,\n')
    report = run(
        spark, source, processed, rejected, A,
        multi_line=True, keep_raw=False, rows_per_file=1, processed_layout=canonical_projection,
    )
    rows = parquet_rows(spark, processed)
    assert {r["name"] for r in rows} == {"a\nb", "b", None} and list(rows[0]) == list(CANONICAL_PROJECTION_FIELDS)
    assert "raw_record" not in json_rows(rejected)[0]
    assert report.unnamed_count == 1


def test_run_refuses_bad_arguments_before_working(spark, paths):
    source, processed, rejected = paths
    with pytest.raises(ValueError, match="rows_per_file"):
        run(spark, source, processed, rejected, A, rows_per_file=0)
    with pytest.raises(ValueError, match="must differ"):
        run(spark, source, source, rejected, A)


def test_malformed_lines_are_rejects(spark, paths):
    source, processed, rejected = paths
    put(source, A_HEADER + "1,a,B12345678,ES,e\n2,b\n3,c,B12345679,ES,e,extra\n4,d,B87654321,ES,torn\nrest\n")
    report = run(spark, source, processed, rejected, A)
    assert (report.processed_count, report.rejected_count) == (2, 3)
    lines = {r["raw_line"] for r in json_rows(rejected)}
    assert lines == {"2,b", "3,c,B12345679,ES,e,extra", "rest"}
    assert {r["reason"] for r in json_rows(rejected)} == {"Malformed record"}
    assert run(spark, source, processed, rejected, A, rules=DF_PARITY).rejected_count == 0


@pytest.mark.parametrize(
    ("inputs", "processed", "rejected", "ledger"),
    [
        ("in", "out", "out/rejected", None),
        ("in", "in/", "rejected", None),
        ("d/in", "d", "rejected", None),
        ("in", "processed", "rejected", "rejected"),
        ("in", "x/../in", "rejected", None),
        ("in/*.csv", "in/processed", "rejected", None),
    ],
)
def test_overlapping_paths_are_refused(spark, tmp_path, inputs, processed, rejected, ledger):
    folder = tmp_path / inputs.removesuffix("/*.csv")
    folder.mkdir(parents=True)
    put(folder, A_HEADER + "1,a,B12345678,ES,e\n")
    before = sorted(p.read_bytes() for p in tmp_path.rglob("*") if p.is_file())
    at = [f"file:{tmp_path}/{inputs}", f"{tmp_path}/{processed}", f"{tmp_path}/{rejected}"]
    with pytest.raises(ValueError, match="must differ"):
        run(spark, *at, A, ledger_path=f"{tmp_path}/{ledger}" if ledger else None)
    assert sorted(p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()) == before


def test_runs_in_two_threads(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    for n in (0, 1):
        lines = [f"{i},n{i},B{i % (50 + n):08d},ES,\n" for i in range(3000)]
        put(tmp_path / f"in{n}", A_HEADER + "".join(lines))

    def one(n):
        at = [str(tmp_path / f"{kind}{n}") for kind in ("in", "processed", "rejected")]
        return run(spark, *at, A, rows_per_partition=100).unique_count

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(one, (0, 1))) == [50, 51]
    assert spark.conf.get(key) == before


def test_number_of_reject_files(spark, paths):
    source, processed, rejected = paths
    for n in range(4):
        put(source, A_HEADER + f"{n},a,B1,ES,e\n", f"{n}.csv")
    run(spark, source, processed, rejected, A, reject_files=1)
    assert len(list(Path(rejected).glob("*.json"))) == 1 and len(json_rows(rejected)) == 4


def test_runs_replace_outputs_and_append_to_the_ledger(spark, paths, tmp_path):
    source, processed, rejected = paths
    ledger = str(tmp_path / "ledger")
    put(source, A_HEADER + "1,a,B12345678,ES,\n2,b,B1,ES,\n")
    for _ in range(2):
        run(spark, source, processed, rejected, A, ledger_path=ledger)
    assert len(parquet_rows(spark, processed)) == len(json_rows(rejected)) == 1
    statuses = [r.status for r in spark.read.schema(LEDGER).json(ledger).collect()]
    assert sorted(statuses) == ["COMPLETED"] * 2 + ["RUNNING"] * 2


def test_run_conserves_rows(spark, sf_dir, paths):
    source, processed, rejected = paths
    write_csv(extract(spark, sf_dir, "ERP_B"), source)
    report = run(spark, source, processed, rejected, B)
    assert report.processed_count + report.rejected_count == 1_500
    assert (report.unique_count, len(json_rows(rejected))) == (126, report.rejected_count)


def test_run_with_cache_gives_the_same(spark, sf_dir, paths):
    source, processed, rejected = paths
    write_csv(extract(spark, sf_dir, "ERP_B"), source)
    plain = run(spark, source, processed, rejected, B)
    rows = parquet_rows(spark, processed)
    cached = run(spark, source, processed, rejected, B, cache=StorageLevel.MEMORY_AND_DISK)
    key = itemgetter("customer_id")
    assert sorted(parquet_rows(spark, processed), key=key) == sorted(rows, key=key)
    counts = attrgetter("processed_count", "rejected_count", "unique_count", "unnamed_count")
    assert counts(plain) == counts(cached)


def test_hot_customer_is_pruned_before_the_shuffle(spark, sf_dir, paths):
    source, processed, rejected = paths
    write_csv(skewed_extract(spark, sf_dir).repartition(8), source)
    report = run(spark, source, processed, rejected, A)
    assert report.unique_count < report.processed_count * 2 / 3
    rows = parquet_rows(spark, processed)
    assert len({r["customer_id"] for r in rows}) == len(rows) == report.unique_count
    assert sum((r["tax_id"], r["country"]) == ("B00001000", "ES") for r in rows) == 1


# --- job, scratch, settings --------------------------------------------------


def test_job_args():
    options = {"source_system": "ERP_A", "input_path": "i", "processed_path": "p", "rejected_path": "r", "JOB": "x"}
    assert JobArgs.from_options(options) == JobArgs("ERP_A", "i", "p", "r")
    with pytest.raises(KeyError):
        JobArgs.from_options({"source_system": "ERP_A"})


def test_run_job_by_source_name(spark, paths):
    put(paths[0], "customer_code,customer_name,fiscal_id,country_code,email_address\n7842,ACME S.L.,B-12345678,ES,e\n")
    report = run_job(spark, JobArgs("ERP_C", *paths))
    assert (report.status, report.unique_count) == ("COMPLETED", 1)
    with pytest.raises(ValueError, match="Unsupported source system: ERP_X"):
        run_job(spark, JobArgs("ERP_X", *paths))


def test_main(spark, paths, tmp_path, capsys):
    put(paths[0], A_HEADER + "1,a,B12345678,ES,\n")
    names = ("--input_path", "--processed_path", "--rejected_path")
    argv = ["--source_system", "ERP_A", *(part for pair in zip(names, paths) for part in pair)]
    assert main([*argv, "--ledger_path", str(tmp_path / "ledger")]) == 0
    assert "COMPLETED" in capsys.readouterr().out
    options = ["--rules", "parity", "--cache", "--rows_per_file", "1", "--reject_files", "1", "--no_raw"]
    assert main([*argv, *options]) == 0
    assert main([*argv, "--source_layout"]) == 0
    assert spark.read.parquet(paths[1]).columns == list(CANONICAL_PROJECTION_FIELDS)
    argv[1] = "ERP_B"
    assert main(argv) == 1


def test_scratch_folder(spark):
    folder = scratch_folder(spark, "probe")
    assert folder != scratch_folder(spark, "probe") and not Path(folder).exists()
    spark.range(1).write.parquet(folder)
    drop_folder(spark, folder)
    assert not Path(folder).exists()


def test_shuffle_grows_with_the_rows(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert shuffle_for(spark, 10) == {key: before}
    assert shuffle_for(spark, 1000 * ROWS_PER_SHUFFLE_PARTITION + 1) == {key: "1001"}
    assert shuffle_for(spark, 10**12) == {key: "2000000"}
    assert shuffle_for(spark, 10**4, rows_per_partition=10) == {key: "1000"}
    with settings(spark, {key: "77", "spark.sql.files.minPartitionNum": "3"}):
        assert spark.conf.get(key) == "77"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
