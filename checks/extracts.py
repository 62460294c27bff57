"""Customer extracts derived from the test tables, in the layouts of the three source systems.

The tables hold neither tax IDs nor country names, so both are computed from a
customer key ``k`` and a row key ``r``: several spellings per value, some rows
without a value, some with an unknown country, some with a tax ID that is too short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from customer_canon.sources.providers import provider_for

_BODY = "concat('B', if(k % 10 = 7, lpad(k % 10000, 4, '0'), lpad(k, 8, '0')))"
_CODE = "elt(k % 8 + 1, 'ES', 'ES', 'FR', 'FR', 'DE', 'DE', 'ES', 'IT')"

_FIELDS = {
    "external_id": "external_id",
    "name": "name",
    "tax_id": """
        if(k % 101 = 100, NULL, elt(r % 5 + 1,
          body,
          concat(' ', lower(code), '-', left(body, 3), ' ', substr(body, 4), ' '),
          concat(code, body),
          concat('b-', lower(substr(body, 2))),
          concat('\\t', body)))""",
    "country": """
        if(k % 97 = 96, NULL,
          elt(k % 8 + 1, 'Spain', 'ES', 'France', 'FR', 'Germany', 'DE', 'Spain', 'Italy'))""",
    "email": "if(r % 4 = 0, NULL, concat('u', r, '@example.com'))",
}


def _extract(table: DataFrame, source_system: str, k: str, r: str, external_id: str, name: str) -> DataFrame:
    mapping = provider_for(source_system).mapping
    keyed = table.selectExpr(f"{k} AS k", f"{r} AS r", f"{name} AS name")
    return keyed.selectExpr("*", f"{external_id} AS external_id", f"{_BODY} AS body", f"{_CODE} AS code").selectExpr(
        *[f"{value} AS {mapping[field]}" for field, value in _FIELDS.items()]
    )


def extract(spark: SparkSession, sf_dir: str, source_system: str) -> DataFrame:
    """ERP_A: one row per customer; ERP_B: one per order; ERP_C: one per supplier."""
    table, k, r, external_id, name = {
        "ERP_A": ("customer", "c_custkey", "c_custkey", "concat('C', lpad(k, 9, '0'))", "c_name"),
        "ERP_B": (
            "orders",
            "o_custkey",
            "o_orderkey",
            "concat('O', lpad(r, 9, '0'))",
            "concat('Buyer ', o_custkey, ' ', o_orderpriority)",
        ),
        "ERP_C": ("supplier", "s_suppkey", "s_suppkey", "concat('S', lpad(k, 9, '0'))", "s_name"),
    }[source_system]
    return _extract(spark.read.parquet(f"{sf_dir}/{table}.parquet"), source_system, k, r, external_id, name)


def skewed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERP_A layout, one row per order line, a third of which belong to customer 1000."""
    return _extract(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        "ERP_A",
        "if(l_orderkey % 3 = 0, 1000, l_orderkey)",
        "l_orderkey * 8 + l_linenumber",
        "concat('L', lpad(r, 10, '0'))",
        "concat('Part ', l_partkey)",
    )


def write_csv(
    extract: DataFrame, path: str, ordered_by: Sequence[str | Column] = (), separator: str = ","
) -> None:
    """Writes an extract as CSV with cells kept exactly as they are.

    With ``ordered_by`` the files, in path order, hold the rows in that order.
    """
    if ordered_by:
        extract = extract.repartitionByRange(*ordered_by).sortWithinPartitions(*ordered_by)
    (
        extract.write.option("header", True)
        .option("escape", '"')
        .option("sep", separator)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
