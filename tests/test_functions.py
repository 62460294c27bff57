"""Column functions against worked examples and against Python's own string and UUID functions."""

import random
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from customer_canon.functions import clean_tax_id, country_code, customer_id, identity_key, tax_id_is_valid, uuid5
from customer_canon.functions.identity import CUSTOMER_NAMESPACE
from customer_canon.rules import DF_PARITY, STRICT, UNICODE_SPACE, Rules


def evaluate(spark, rows, schema, column):
    """The column's value for each row, in row order."""
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in frame.select("i", column.alias("v")).orderBy("i").collect()]


def test_country_code(spark):
    spellings = ["Spain", "ES", "France", "FR", "Germany", "DE", "Italy", "spain", " ES", "", None]
    codes = evaluate(spark, [(s,) for s in spellings], "c string", country_code(F.col("c")))
    assert codes == ["ES", "ES", "FR", "FR", "DE", "DE", None, None, None, None, None]


@pytest.mark.parametrize(
    ("tax_id", "country", "expected"),
    [
        (" es-b12 345-678 ", "ES", "B12345678"),
        ("ESB12345678", "ES", "B12345678"),
        ("B12345678", "ES", "B12345678"),
        ("B-12345678", "ES", "B12345678"),
        ("b12345678", "ES", "B12345678"),
        ("B 12345678", "ES", "B12345678"),
        ("fr 12-34 56", "FR", "123456"),
        ("E-SB12345678", "ES", "B12345678"),
        ("ESES12345", "ES", "ES12345"),
        ("ESB12345678", "FR", "ESB12345678"),
        ("ESB12345678", None, "ESB12345678"),
        ("\t \u0085 b1　", "ES", "B1"),
        ("b\t1", "ES", "B\t1"),
        ("straße", "DE", "STRASSE"),
        (" - ", "ES", ""),
        ("ES", "ES", ""),
        ("", "ES", ""),
        (None, "ES", None),
    ],
)
def test_clean_tax_id(spark, tax_id, country, expected):
    column = clean_tax_id(F.col("t"), F.col("c"))
    assert evaluate(spark, [(tax_id, country)], "t string, c string", column) == [expected]


def test_trim_set_is_pythons_white_space():
    assert set(UNICODE_SPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


def test_clean_tax_id_agrees_with_python_on_random_text(spark):
    generator = random.Random(7)
    alphabet = "ESFRDEesfr B-19ñß" + UNICODE_SPACE
    rows = [
        ("".join(generator.choices(alphabet, k=generator.randint(0, 12))), generator.choice(["ES", "FR", "DE"]))
        for _ in range(3000)
    ]
    expected = [t.strip().upper().replace("-", "").replace(" ", "").removeprefix(c) for t, c in rows]
    column = clean_tax_id(F.col("t"), F.col("c"))
    assert evaluate(spark, rows, "t string, c string", column) == expected


def test_parity_trims_blanks_only(spark):
    column = clean_tax_id(F.col("t"), F.col("c"), DF_PARITY.trim)
    assert evaluate(spark, [(" \tb1 ", "ES")], "t string, c string", column) == ["\tB1"]


def test_tax_id_is_valid(spark):
    rows = [("B12345678", "ES"), ("B1234", "ES"), (None, "ES"), ("", "ES"), ("1", "FR"), (None, "FR"), ("1", None)]
    column = tax_id_is_valid(F.col("t"), F.col("c"))
    assert evaluate(spark, rows, "t string, c string", column) == [True, False, None, False, True, True, True]


def test_golden_customer_id(spark):
    column = customer_id(F.col("c"), F.col("t"))
    ids = evaluate(spark, [("B12345678", "ES")], "t string, c string", column)
    assert ids == ["25013cb5-a708-5c14-a1f1-f2ddbe8e9d35"]


def test_uuid5_agrees_with_python(spark):
    generator = random.Random(11)
    names = ["", "ES:", ":", "ES:B12345678", "x" * 500, "ñ€\U0001f600"]
    names += ["".join(map(chr, generator.choices(range(32, 0x2FF), k=generator.randint(0, 40)))) for _ in range(5000)]
    got = evaluate(spark, [(n,) for n in names], "n string", uuid5(CUSTOMER_NAMESPACE, F.col("n")))
    assert got == [str(uuid.uuid5(CUSTOMER_NAMESPACE, n)) for n in names]


def test_identity_key_nulls(spark):
    rows = [("ES", "B1"), (None, "B1"), ("FR", None), ("FR", "")]
    key = identity_key(F.col("c"), F.col("t"))
    named = identity_key(F.col("c"), F.col("t"), null_text="None")
    assert evaluate(spark, rows, "c string, t string", key) == ["ES:B1", None, None, "FR:"]
    assert evaluate(spark, rows, "c string, t string", named) == ["ES:B1", "None:B1", "FR:None", "FR:"]


def test_rules_refuse_unknown_routing():
    with pytest.raises(ValueError, match="on_unsupported_country"):
        Rules(on_unsupported_country="ignore")
    assert STRICT.total and not DF_PARITY.total
