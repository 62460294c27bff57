"""Every registered query against its SQL, row for row."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ("customer", "orders", "supplier", "lineitem")


@pytest.fixture(scope="module")
def duck(query_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{query_dir}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, query_dir, duck, name):
    frame = driver.queries()[name](spark, query_dir)
    columns = sorted(frame.columns)
    expected = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    got = Counter(tuple(row) for row in frame.select(*columns).collect())
    assert want, "the SQL returns no rows"
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 126


def test_entry_without_a_library_of_the_corpus_operators():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    root = Path(driver.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == sorted(QUERIES)
