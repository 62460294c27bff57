"""Outputs that become visible together, runs that go on where they broke off, files that keep arriving."""

import json
import shutil
from pathlib import Path

import pytest

from customer_canon import provider_for
from customer_canon.plans import latest, published, read_published, run_arriving, run_published, versions
from customer_canon.plans.known import KnownCustomers
from customer_canon.sinks import canonical_projection

B = provider_for("ERP_B")
HEADER = "client_code,legal_name,vat_number,country,contact_email\n"
FIRST = HEADER + "1,Ann,B00000001,Spain,\n2,Bob,FR1,France,\n3,Bad,,Spain,\n"


def put(path, text, name="part-0.csv"):
    Path(path).mkdir(exist_ok=True)
    (Path(path) / name).write_text(text, encoding="utf-8")


def names_in(spark, path):
    return sorted(r.name for r in spark.read.parquet(str(path)).collect())


def one(spark, tmp_path, run_id, **options):
    return run_published(spark, str(tmp_path / "in"), str(tmp_path / "root"), run_id, B, **options)


def broken(*_, **__):
    raise RuntimeError("lost")


def test_readers_follow_the_latest_version(spark, tmp_path):
    root = str(tmp_path / "root")
    assert latest(spark, root) is None and read_published(spark, root) is None
    put(tmp_path / "in", FIRST)
    report = one(spark, tmp_path, "r1")
    assert (report.status, report.resumed, report.version.number) == ("COMPLETED", (), 1)
    assert report.version.counts == {"processed_count": 2, "rejected_count": 1, "unnamed_count": 0, "unique_count": 2}
    put(tmp_path / "in", FIRST + "5,Eve,DE9,Germany,\n")
    assert one(spark, tmp_path, "r2").version.number == 2
    assert latest(spark, root + "/").run_id == "r2"
    assert names_in(spark, latest(spark, root).processed_path) == ["Ann", "Bob", "Eve"]
    assert read_published(spark, root, "customer_id string").columns == ["customer_id"]
    assert [v.run_id for v in versions(spark, root)] == ["r1", "r2"]
    assert names_in(spark, versions(spark, root)[0].processed_path) == ["Ann", "Bob"]


@pytest.mark.parametrize(("lost", "resumed"), [("_write_rejects", ()), ("_write_unique", ("rejects",)), ("_publish", ("rejects", "processed"))])
def test_run_that_broke_off_leaves_the_old_pair_and_goes_on(spark, tmp_path, monkeypatch, lost, resumed):
    put(tmp_path / "in", FIRST)
    one(spark, tmp_path, "r1")
    put(tmp_path / "in", FIRST + "5,Eve,DE9,Germany,\n6,Worse,,Spain,\n")
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(published, lost, broken)
        one(spark, tmp_path, "r2")
    old = latest(spark, str(tmp_path / "root"))
    assert old.run_id == "r1" and names_in(spark, old.processed_path) == ["Ann", "Bob"]
    assert spark.read.json(old.rejected_path).count() == 1
    with monkeypatch.context() as patch:
        for done in {"rejects": "_write_rejects", "processed": "_write_unique"}.items():
            if done[0] in resumed:
                patch.setattr(published, done[1], broken)
        report = one(spark, tmp_path, "r2")
    assert (report.resumed, report.version.number) == (resumed, 2)
    assert report.version.counts["rejected_count"] == 2 and report.version.counts["unique_count"] == 3
    assert names_in(spark, report.version.processed_path) == ["Ann", "Bob", "Eve"]
    assert spark.read.json(report.version.rejected_path).count() == 2


def test_output_without_its_marker_is_written_again(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", FIRST)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(published, "_publish", broken)
        one(spark, tmp_path, "r1")
    (tmp_path / "root/runs/r1/processed.json").unlink()
    shutil.rmtree(tmp_path / "root/runs/r1/processed")
    assert one(spark, tmp_path, "r1").resumed == ("rejects",)
    assert names_in(spark, tmp_path / "root/runs/r1/processed") == ["Ann", "Bob"]


def test_published_run_is_left_alone(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", FIRST)
    first = one(spark, tmp_path, "r1")
    for name in ("_write_rejects", "_write_unique", "_publish"):
        monkeypatch.setattr(published, name, broken)
    again = one(spark, tmp_path, "r1")
    assert again.version == first.version and again.resumed == ("rejects", "processed", "published")
    with pytest.raises(ValueError, match="another run_id"):
        one(spark, tmp_path, "r1", processed_layout=canonical_projection)
    put(tmp_path / "in", FIRST + "5,Eve,DE9,Germany,\n")
    with pytest.raises(ValueError, match="another run_id"):
        one(spark, tmp_path, "r1")


def test_other_input_starts_an_unpublished_run_anew(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", FIRST)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(published, "_write_unique", broken)
        one(spark, tmp_path, "r1")
    put(tmp_path / "in", HEADER + "7,Kim,DE7,Germany,\n", "part-1.csv")
    report = one(spark, tmp_path, "r1", rows_per_file=1)
    assert report.resumed == () and report.version.counts["processed_count"] == 3


def test_failed_run_and_bad_arguments(spark, tmp_path):
    put(tmp_path / "in", "client_code\n1\n")
    report = one(spark, tmp_path, "r1")
    assert (report.status, report.version) == ("FAILED", None) and "vat_number" in report.error
    assert latest(spark, str(tmp_path / "root")) is None
    for run_id in ("", "a/b", "_x"):
        with pytest.raises(ValueError, match="run_id"):
            one(spark, tmp_path, run_id)
    with pytest.raises(ValueError, match="keep_versions"):
        one(spark, tmp_path, "r1", keep_versions=0)
    with pytest.raises(ValueError, match="apart"):
        run_published(spark, str(tmp_path / "in"), str(tmp_path / "in/root"), "r1", B)


def test_numbers_go_on_and_old_versions_go(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    put(tmp_path / "in", FIRST)
    for n in range(3):
        one(spark, tmp_path, f"r{n}", keep_versions=2)
    assert [(v.number, v.run_id) for v in versions(spark, root)] == [(2, "r1"), (3, "r2")]
    assert sorted(p.name for p in (tmp_path / "root/runs").iterdir()) == ["r1", "r2"]
    numbers = published._numbers
    monkeypatch.setattr(published, "_numbers", lambda *a: numbers(*a)[:-1])  # another run takes 3 meanwhile
    assert published._publish(spark, root, "r9", {}).number == 4


# --- arriving files ----------------------------------------------------------


def arrive(spark, tmp_path, **options):
    at = [str(tmp_path / name) for name in ("in", "processed", "rejected", "known", "progress")]
    query = run_arriving(spark, *at, B, **options)
    query.awaitTermination()
    return [json.loads(p.read_text()) for p in sorted((tmp_path / "progress/batches").glob("*.json"))]


def test_files_are_taken_as_they_arrive(spark, tmp_path):
    put(tmp_path / "in", FIRST)
    done = arrive(spark, tmp_path)
    assert [(b["files"], b["processed"], b["rejected"], b["new"]) for b in done] == [(1, 2, 1, 2)]
    assert len(arrive(spark, tmp_path)) == 1  # nothing has arrived
    put(tmp_path / "in", HEADER + "4,Ann again,ES-B00000001,ES,\n5,Eve,DE9,Germany,\n", "odd [1]{a}*.csv")
    put(tmp_path / "in", "not looked at", "notes.txt")
    done = arrive(spark, tmp_path)
    assert [b["new"] for b in done] == [2, 1]
    assert names_in(spark, tmp_path / "processed") == ["Ann", "Bob", "Eve"]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    put(tmp_path / "in", FIRST)
    put(tmp_path / "in", HEADER + "5,Eve,DE9,Germany,\n", "part-1.csv")
    assert len(arrive(spark, tmp_path, files_per_batch=1)) == 2
    rows = names_in(spark, tmp_path / "processed")
    # as if the driver had been lost before the stream noted its last batch
    (tmp_path / "progress/stream/commits/1").unlink()
    (tmp_path / "progress/stream/commits/.1.crc").unlink(missing_ok=True)
    arrive(spark, tmp_path, files_per_batch=1)
    assert names_in(spark, tmp_path / "processed") == rows == ["Ann", "Bob", "Eve"]
    # and before the batch was put down as done
    (tmp_path / "progress/stream/commits/1").unlink()
    (tmp_path / "progress/stream/commits/.1.crc").unlink(missing_ok=True)
    marker = tmp_path / "progress/batches/batch-000000000001.json"
    before = json.loads(marker.read_text())
    marker.unlink()
    marker.with_name(f".{marker.name}.crc").unlink(missing_ok=True)
    assert arrive(spark, tmp_path, files_per_batch=1)[-1] == before
    assert names_in(spark, tmp_path / "processed") == rows
    assert KnownCustomers(str(tmp_path / "known")).read(spark).count() == 3


def test_batch_without_a_required_column(spark, tmp_path):
    put(tmp_path / "in", "client_code\n1\n")
    with pytest.raises(Exception, match="vat_number"):
        arrive(spark, tmp_path)
    assert not (tmp_path / "progress/batches").exists()
    put(tmp_path / "in", FIRST, "part-1.csv")
    done = arrive(spark, tmp_path, skip_failed=True, files_per_batch=1)
    assert [b["status"] for b in done] == ["FAILED", "COMPLETED"] and "vat_number" in done[0]["error"]
    assert names_in(spark, tmp_path / "processed") == ["Ann", "Bob"]


def test_batches_of_another_stream_and_bad_arguments(spark, tmp_path):
    put(tmp_path / "in", FIRST)
    arrive(spark, tmp_path, ledger_path=str(tmp_path / "ledger"))
    assert spark.read.json(str(tmp_path / "ledger")).count() == 2
    shutil.rmtree(tmp_path / "progress/stream")
    put(tmp_path / "in", FIRST, "part-1.csv")
    with pytest.raises(Exception, match="another stream"):
        arrive(spark, tmp_path)
    with pytest.raises(ValueError, match="files_per_batch"):
        arrive(spark, tmp_path, files_per_batch=0)
