"""The registered queries of the corpus operators against their SQL, whole."""

from collections import Counter

import duckdb
import pytest

from customer_canon.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, query_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{query_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, query_dir)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(frame.columns)
    want = Counter(expected.fetchall())
    assert want and Counter(map(tuple, frame.select(*names).collect())) == want


NATIVE = [name for name in QUERIES if name.split("_")[0] in ("op1", "op3", "op5", "op9")]


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, query_dir, name, capsys):
    QUERIES[name](spark, query_dir).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
