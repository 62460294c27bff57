"""Survivorship by field, and the change set between two sets of customers."""

import pytest

from customer_canon.operators import change_set, merge_per_customer, with_digest
from customer_canon.operators.changes import DIGEST

CANON = "external_id string, name string, tax_id string, country string, email string"
SOURCED = f"{CANON}, source_system string"


def merged(spark, rows, priority=None, schema=CANON, **options):
    frame = merge_per_customer(spark.createDataFrame(rows, schema), priority, **options)
    return {r.tax_id: r.asDict() for r in frame.collect()}


def test_each_field_comes_from_the_first_row_that_has_it(spark):
    rows = [
        ("3", "C", "t", "ES", "c@x"), ("1", None, "t", "ES", None), ("2", "B", "t", "ES", None),
        ("9", None, "u", "FR", None), ("8", None, "u", "FR", None),
    ]
    got = merged(spark, rows + rows[:2])
    assert got["t"] == {
        "external_id": "1", "tax_id": "t", "country": "ES", "name": "B", "name_from": "2", "email": "c@x", "email_from": "3",
    }
    assert got["u"] == {
        "external_id": "8", "tax_id": "u", "country": "FR", "name": None, "name_from": None, "email": None, "email_from": None,
    }


def test_sources_by_priority_before_ids(spark):
    rows = [("1", "A", "t", "ES", None, "ERP_A"), ("2", None, "t", "ES", "b@x", "ERP_B"), ("0", "Z", "t", "ES", "z@x", "OTHER")]
    got = merged(spark, rows, ["ERP_B", "ERP_A"], SOURCED)["t"]
    assert (got["external_id"], got["source_system"]) == ("2", "ERP_B")
    assert (got["name"], got["name_from"], got["name_source"]) == ("A", "1", "ERP_A")
    assert (got["email"], got["email_from"], got["email_source"]) == ("b@x", "2", "ERP_B")


def test_own_order_nulls_in_keys_and_no_rows(spark):
    rows = [("1", "A", None, "ES", "1"), ("2", "B", None, "ES", "0")]
    assert merged(spark, rows, order_by=["email"])[None]["name"] == "B"
    assert merged(spark, rows, order_by=["name"], fields=["email"])[None] == {
        "external_id": "1", "tax_id": None, "country": "ES", "email": "1", "email_from": "1",
    }
    assert merged(spark, []) == {}


def test_merging_has_one_exchange_and_combines_before_it(spark):
    rows = spark.range(1000).selectExpr(
        "string(id) external_id", "string(id) name", "string(id % 3) tax_id", "'ES' country", "string(null) email"
    )
    plan = merge_per_customer(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan
    assert "Window" not in plan and "Python" not in plan


FIELDS = "customer_id string, name string, email string"


def changed(spark, before, after, **options):
    frames = [rows if not isinstance(rows, list) else spark.createDataFrame(rows, FIELDS) for rows in (before, after)]
    return sorted((tuple(r) for r in change_set(*frames, **options).collect()), key=str)


def test_new_changed_gone(spark):
    before = [("a", "A", None), ("b", "B", "b@x"), ("c", "C", None), ("n", None, "null")]
    after = [("a", "A", None), ("b", "B", None), ("d", "D", None), ("n", "null", None)]
    want = [("b", "B", None, "changed"), ("c", None, None, "gone"), ("d", "D", None, "new"), ("n", "null", None, "changed")]
    assert changed(spark, before, after) == want
    assert changed(spark, before, after, keep_unchanged=True) == [("a", "A", None, "unchanged"), *want]
    assert changed(spark, before, after, fields=["name"]) == [w for w in want if w[0] != "b"]


def test_empty_sides_and_rows_without_id(spark):
    rows = [("a", "A", None), (None, "B", None)]
    assert changed(spark, rows, []) == [("a", None, None, "gone"), (None, None, None, "gone")]
    assert changed(spark, [], rows) == [("a", "A", None, "new"), (None, "B", None, "new")]
    assert sorted(r[-1] for r in changed(spark, rows[1:], rows[1:])) == ["gone", "new"]
    assert changed(spark, [], []) == []


@pytest.mark.parametrize(("left", "right"), [("a,b", "c"), ('a","email":"b', "c"), ("", None)])
def test_cells_do_not_run_together(spark, left, right):
    one, other = [("i", left, right)], [("i", "a", "b,c")]
    assert [r[-1] for r in changed(spark, one, other)] == ["changed"]
    assert changed(spark, one, one) == []


def test_stored_digest_spares_the_fields_of_before(spark, tmp_path):
    before = spark.createDataFrame([("a", "A", None), ("b", "B", None)], FIELDS)
    with_digest(before).write.parquet(str(tmp_path / "before"))
    stored = spark.read.parquet(str(tmp_path / "before"))
    after = spark.createDataFrame([("a", "A", None), ("b", "X", None)], FIELDS)
    changes = change_set(stored, after)
    assert [tuple(r) for r in changes.collect()] == [("b", "X", None, "changed")]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "email" not in plan.split("ReadSchema:")[1].split("\n")[0] and DIGEST in plan
