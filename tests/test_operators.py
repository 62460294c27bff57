"""Mapping, routing, identity and first-wins on small inputs with known results."""

import io
from contextlib import redirect_stdout
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.extracts import extract
from customer_canon import DF_PARITY, STRICT, IngestionError, Provider, Rules, provider_for
from customer_canon.operators import (
    any_per_customer,
    check_required_fields,
    classify,
    first_per_customer,
    identify,
    map_columns,
    process,
    processed,
    rejected,
    required_source_fields,
    transform,
    with_provenance,
)
from customer_canon.schema import CANONICAL_FIELDS, REJECTED_FIELDS
from customer_canon.operators.mapping import carried_columns
from customer_canon.sources.providers import PROVIDERS

B = provider_for("ERP_B")
B_COLUMNS = "client_code string, legal_name string, vat_number string, country string, contact_email string"
CANONICAL = "external_id string, name string, tax_id string, country string, email string"


def source_b(spark, *rows):
    return spark.createDataFrame(rows, B_COLUMNS)


def plan_text(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


# --- layouts -----------------------------------------------------------------


def test_unknown_source_system():
    with pytest.raises(ValueError, match="Unsupported source system: ERP_X"):
        provider_for("ERP_X")


@pytest.mark.parametrize("provider", PROVIDERS.values(), ids=list(PROVIDERS))
def test_map_columns_of_every_source(spark, provider):
    source = spark.createDataFrame(
        [("0001", "ACME S.L.", "B-12345678", "ES", "info@acme.es", "ignored")],
        [*provider.mapping.values(), "extra"],
    )
    mapped = map_columns(source, provider)
    assert mapped.columns == list(CANONICAL_FIELDS)
    assert tuple(mapped.first()) == ("0001", "ACME S.L.", "B-12345678", "ES", "info@acme.es")
    assert transform(source, provider).first().tax_id == "B12345678"


def test_required_source_fields():
    assert required_source_fields(B) == {"client_code", "legal_name", "vat_number", "country"}
    with pytest.raises(KeyError):
        required_source_fields(Provider("X", {"external_id": "id"}))


def test_check_required_fields():
    check_required_fields(["client_code", "legal_name", "vat_number", "country"], required_source_fields(B))
    with pytest.raises(IngestionError, match="^Missing required fields: country, vat_number$"):
        check_required_fields(["client_code", "legal_name", "Country"], required_source_fields(B))


def test_missing_required_column_fails_before_any_job(spark):
    source = source_b(spark, ("C1", "n", "t", "ES", "e")).drop("vat_number")
    with pytest.raises(IngestionError, match="vat_number"):
        classify(source, B)


def test_missing_email_is_null(spark):
    source = source_b(spark, ("C1", "n", "B12345678", "ES", "e")).drop("contact_email")
    assert processed(classify(source, B)).first().email is None


def test_column_names_with_dots_and_backticks(spark):
    provider = Provider("D", {"external_id": "a.id", "name": "na`me", "tax_id": "t", "country": "c", "email": "e"})
    source = spark.createDataFrame([("1", "n", "B1234", "ES", "e", "x")], ["a.id", "na`me", "t", "c", "e", "x.y"])
    row = rejected(classify(source, provider)).first()
    assert (row.external_id, row.name) == ("1", "n")
    assert row.raw_record.asDict()["x.y"] == "x"


def test_prepare_runs_before_the_mapping(spark):
    renaming = Provider("ERP_B", B.mapping, prepare=lambda df: df.withColumnRenamed("vat", "vat_number"))
    source = source_b(spark, ("C1", "n", "B12345678", "ES", "e")).withColumnRenamed("vat_number", "vat")
    assert processed(classify(source, renaming)).first().tax_id == "B12345678"
    assert map_columns(source, renaming).first().tax_id == "B12345678"


def test_provenance(spark):
    canonical = spark.createDataFrame([("0001", "ACME", "B12345678", "ES", None)], CANONICAL)
    row = with_provenance(canonical, B).first()
    assert (row.source_system, row.external_id) == ("ERP_B", "0001")
    assert row.customer.asDict() == {"name": "ACME", "tax_id": "B12345678", "country": "ES", "email": None}


# --- routing -----------------------------------------------------------------


def test_process_splits_good_and_bad(spark):
    source = source_b(
        spark,
        ("K-7", "Molinos Sur", "es x71-004 28q", "Spain", "caja@molinos.example"),
        ("K-3", "Ferro", " 77-1 ", "ES", "a@ferro.example"),
        ("K-4", "Atelier", "fr 90-55 1", "France", None),
    )
    good, bad = process(source, B)
    assert sorted(map(tuple, good.collect())) == [
        ("K-4", "Atelier", "90551", "FR", None),
        ("K-7", "Molinos Sur", "X7100428Q", "ES", "caja@molinos.example"),
    ]
    row = bad.collect()[0].asDict(recursive=True)
    assert row == {
        "external_id": "K-3",
        "name": "Ferro",
        "tax_id": "771",
        "country": "ES",
        "email": "a@ferro.example",
        "reason": "Invalid tax ID",
        "reason_detail": "Invalid tax ID for country ES",
        "raw_record": {
            "client_code": "K-3",
            "legal_name": "Ferro",
            "vat_number": " 77-1 ",
            "country": "ES",
            "contact_email": "a@ferro.example",
        },
    }


ODD_ROWS = [
    ("italy", "n", "B12345678", "Italy", None),
    ("nowhere", "n", "B12345678", None, None),
    ("es-null", "n", None, "ES", None),
    ("es-empty", "n", "", "ES", None),
    ("fr-null", "n", None, "FR", None),
    ("fr-blank", "n", " - ", "FR", None),
    ("no-name", None, "B12345678", "ES", None),
]


def test_strict_routing_is_total(spark):
    good, bad = process(source_b(spark, *ODD_ROWS), B)
    assert [r.external_id for r in good.collect()] == ["no-name"]
    assert {r.external_id: (r.reason, r.reason_detail) for r in bad.collect()} == {
        "italy": ("Unsupported country", "Unsupported country: Italy"),
        "nowhere": ("Unsupported country", "Unsupported country: (missing)"),
        "es-null": ("Invalid tax ID", "Invalid tax ID for country ES"),
        "es-empty": ("Invalid tax ID", "Invalid tax ID for country ES"),
        "fr-null": ("Invalid tax ID", "Invalid tax ID for country FR"),
        "fr-blank": ("Invalid tax ID", "Invalid tax ID for country FR"),
    }


def test_parity_routing_accepts_more_and_loses_rows(spark):
    good, bad = process(source_b(spark, *ODD_ROWS), B, DF_PARITY)
    assert {r.external_id for r in good.collect()} == {"italy", "nowhere", "fr-null", "fr-blank", "no-name"}
    assert {r.external_id for r in bad.collect()} == {"es-empty"}


def test_unsupported_country_can_pass_or_abort(spark):
    source = source_b(spark, *ODD_ROWS[:1])
    passing, _ = process(source, B, replace(STRICT, on_unsupported_country="pass"))
    assert passing.first().country is None
    no_tax_id = source_b(spark, ("C1", "n", None, "Italy", None))
    kept, bad = process(no_tax_id, B, replace(STRICT, on_unsupported_country="pass"))
    assert kept.count() == 0
    assert bad.first().reason_detail == "Invalid tax ID for country Italy"
    failing, _ = process(source, B, Rules(on_unsupported_country="fail"))
    with pytest.raises(PySparkException, match="Unsupported country: Italy"):
        failing.collect()
    fine, _ = process(source_b(spark, ODD_ROWS[-1]), B, Rules(on_unsupported_country="fail"))
    assert fine.count() == 1


def test_raw_record_is_optional(spark):
    classified = classify(source_b(spark, *ODD_ROWS), B, keep_raw=False)
    assert rejected(classified).columns == list(REJECTED_FIELDS)


def test_classification_is_one_narrow_stage(spark, sf_dir):
    text = plan_text(classify(extract(spark, sf_dir, "ERP_B"), B))
    assert "Exchange" not in text
    assert "Python" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in text


def test_views_clean_once_and_prune_columns(spark, sf_dir):
    source = extract(spark, sf_dir, "ERP_B").withColumn("unmapped", F.rand())
    views = (
        processed(classify(source, B)),
        rejected(classify(source, B, keep_raw=False)),
    )
    for view in views:
        text = plan_text(view)
        condition = next(line for line in text.splitlines() if line.startswith("Condition"))
        assert "upper" not in condition and "rand" not in text
        assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in text


# Input, processed, unsupported country, invalid tax ID, distinct customers.
GOLDEN = {
    ("0.001", "ERP_A"): (150, 126, 19, 5, 126),
    ("0.001", "ERP_B"): (1_500, 1_266, 181, 53, 126),
    ("0.001", "ERP_C"): (10, 9, 1, 0, 9),
    ("0.01", "ERP_A"): (1_500, 1_248, 201, 51, 1_248),
    ("0.01", "ERP_B"): (15_000, 12_526, 1_956, 518, 1_248),
    ("0.01", "ERP_C"): (100, 84, 13, 3, 84),
    ("0.1", "ERP_A"): (15_000, 12_494, 2_010, 496, 12_254),
    ("0.1", "ERP_B"): (150_000, 124_978, 19_992, 5_030, 12_253),
    ("0.1", "ERP_C"): (1_000, 833, 134, 33, 833),
}

# Processed, rejected, in neither output, distinct identity keys.
GOLDEN_PARITY = {
    ("0.001", "ERP_B"): (1_354, 146, 0, 243),
    ("0.01", "ERP_A"): (1_347, 147, 6, 1_342),
    ("0.01", "ERP_B"): (13_514, 1_433, 53, 2_442),
    ("0.1", "ERP_B"): (135_490, 13_951, 559, 23_742),
    ("0.1", "ERP_C"): (899, 98, 3, 896),
}


@pytest.mark.parametrize("key", GOLDEN, ids="-".join)
def test_golden_counts(spark, sf_dir, key):
    sf, source_system = key
    source = extract(spark, sf_dir.replace("sf0.001", f"sf{sf}"), source_system)
    classified = classify(source, provider_for(source_system))
    rows = dict(classified.groupBy("reason").count().collect())
    unique = first_per_customer(processed(classified)).count()
    total, accepted, country, tax_id, customers = GOLDEN[key]
    assert rows.get(None, 0) == accepted
    assert rows.get("Unsupported country", 0) == country
    assert rows.get("Invalid tax ID", 0) == tax_id
    assert sum(rows.values()) == total
    assert unique == customers


@pytest.mark.parametrize("key", GOLDEN_PARITY, ids="-".join)
def test_golden_counts_parity(spark, sf_dir, key):
    sf, source_system = key
    source = extract(spark, sf_dir.replace("sf0.001", f"sf{sf}"), source_system)
    classified = classify(source, provider_for(source_system), DF_PARITY)
    verdicts = dict(classified.groupBy("is_valid").count().collect())
    unique = any_per_customer(identify(processed(classified), DF_PARITY)).count()
    assert (verdicts[True], verdicts[False], verdicts.get(None, 0), unique) == GOLDEN_PARITY[key]


def test_customers_of_unknown_countries_stay_apart(spark):
    rules = replace(STRICT, on_unsupported_country="pass")
    rows = [("1", "a", "X1", "Italy", None), ("2", "b", "X2", "Italy", None), ("3", "c", "X1", None, None)]
    good, _ = process(source_b(spark, *rows), B, rules)
    ids = {r.external_id: r.customer_id for r in identify(first_per_customer(good), rules).collect()}
    assert ids.keys() == {"1", "2"} and None not in ids.values() and ids["1"] != ids["2"]


# --- identity and first-wins -------------------------------------------------


def test_identity_depends_on_country_and_tax_id_only(spark):
    rows = [("1", "a", "B12345678", "ES", "x"), ("2", "b", "B12345678", "ES", None), ("3", "a", "B12345678", "FR", "x")]
    ids = {r.external_id: r.customer_id for r in identify(spark.createDataFrame(rows, CANONICAL)).collect()}
    assert ids["1"] == ids["2"] == "25013cb5-a708-5c14-a1f1-f2ddbe8e9d35"
    assert ids["3"] != ids["1"]


def test_first_wins_by_external_id_by_default(spark):
    rows = [
        ("C002", "ACME Sociedad Limitada", "B12345678", "ES", None),
        ("C001", "ACME S.L.", "B12345678", "ES", "e"),
        ("C003", "Other", "B12345678", "FR", None),
    ]
    frame = spark.createDataFrame(rows, CANONICAL).repartition(3)
    assert {r.external_id for r in first_per_customer(frame).collect()} == {"C001", "C003"}
    latest = first_per_customer(frame, order_by=[F.col("external_id").desc()])
    assert {r.external_id for r in latest.collect()} == {"C002", "C003"}


def test_any_per_customer(spark):
    rows = [("1", "a", "B12345678", "ES", None), ("2", "b", "B12345678", "ES", None)]
    identified = identify(spark.createDataFrame(rows, CANONICAL))
    assert any_per_customer(identified).count() == 1


def test_first_wins_prunes_before_its_only_shuffle(spark, sf_dir):
    good = processed(classify(extract(spark, sf_dir, "ERP_B"), B))
    lines = plan_text(first_per_customer(good)).splitlines()
    tree = [line.strip(" +-*:(0123456789)") for line in lines[: lines.index("")]]
    operators = [name for name in tree if name.startswith(("Exchange", "WindowGroupLimit", "Scan"))]
    assert operators == ["WindowGroupLimit", "Exchange", "WindowGroupLimit", "Scan parquet"]


def test_identity_adds_no_python_and_no_shuffle(spark, sf_dir):
    text = plan_text(identify(processed(classify(extract(spark, sf_dir, "ERP_B"), B))))
    assert "Python" not in text
    assert "Exchange" not in text


def test_filters_on_source_columns_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "extract")
    extract(spark, sf_dir, "ERP_B").write.parquet(path)
    good, _ = process(spark.read.parquet(path), B, evaluate_once=False)
    text = plan_text(good.where("external_id = 'O000000001'"))
    assert "EqualTo(client_code,O000000001)" in text


def test_prepare_must_pass_on_what_rows_carry(spark):
    rows = spark.createDataFrame([("1", "a", " b12345678 ", "ES", "x")], "client_code string, legal_name string, vat_number string, country string, contact_email string")
    narrow = Provider("ERP_B", B.mapping, prepare=lambda df: df.select(*B.mapping.values()))
    with pytest.raises(ValueError, match="prepare step of ERP_B must pass on __raw_record"):
        classify(rows, narrow)
    trimming = Provider(
        "ERP_B",
        B.mapping,
        prepare=lambda df: df.withColumn("vat_number", F.lit("B1")).select(*B.mapping.values(), *carried_columns(df)),
    )
    (row,) = rejected(classify(rows, trimming)).collect()
    assert (row.tax_id, row.raw_record.vat_number) == ("B1", " b12345678 ")
