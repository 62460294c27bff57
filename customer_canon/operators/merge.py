"""One row per customer, put together field by field from all rows of that customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.operators.dedup import IDENTITY_COLUMNS, input_order, source_rank

#: What a later row may fill in; tax ID and country are the same in all rows of a customer.
MERGED_FIELDS = ("name", "email")


def merge_per_customer(
    canonical: DataFrame,
    priority: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    fields: Sequence[str] = MERGED_FIELDS,
) -> DataFrame:
    """Each field's first non-null value per (country, tax_id), and the ``external_id`` that it comes from.

    ``external_id`` (and ``source_system``, if ``priority`` names sources) are those of the first row, ``<field>_from``
    (and ``<field>_source``) those of the row that gave the field. A field that is null in every row stays null, with a
    null origin. Rows are in the order of ``first_per_customer``, or ``first_by_source`` with a ``priority``;
    ``order_by`` takes ascending columns only. Rows alike in all of them are told by nothing, but by the values themselves.

    It is one aggregate of smallest structs: every task sends one row per customer, however many rows a customer has,
    through one exchange, and nothing is held in memory per customer. A null tax ID or country is a key like any other.
    """
    order = list(order_by) if order_by is not None else input_order(canonical)
    origin = ["external_id"]
    if priority:
        order = [source_rank(priority), F.col("source_system"), *order]
        origin.append("source_system")
    # numbered names: an order column may be called like a field
    place = [(F.col(c) if isinstance(c, str) else c).alias(f"place{n}") for n, c in enumerate(order)]
    carried = [F.col(c).alias(f"of_{c}") for c in origin]
    first = F.min(F.struct(*place, *carried)).alias("first")
    best = [
        F.min(F.when(F.col(field).isNotNull(), F.struct(*place, F.col(field).alias("value"), *carried))).alias(f"best{n}")
        for n, field in enumerate(fields)
    ]
    merged = canonical.groupBy(*IDENTITY_COLUMNS).agg(first, *best)
    values = [F.col(f"best{n}.value").alias(field) for n, field in enumerate(fields)]
    froms = [
        F.col(f"best{n}.of_{c}").alias(f"{field}_{'from' if c == 'external_id' else 'source'}")
        for n, field in enumerate(fields)
        for c in origin
    ]
    return merged.select(*[F.col(f"first.of_{c}").alias(c) for c in origin], *IDENTITY_COLUMNS, *values, *froms)
