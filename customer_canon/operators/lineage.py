"""Which source row became which customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer_canon.operators.dedup import first_by_source, first_per_customer
from customer_canon.operators.identify import identify
from customer_canon.rules import STRICT, Rules

LINEAGE_FIELDS = ("customer_id", "source_system", "external_id", "survivor_system", "survivor_id")


def lineage(
    accepted: DataFrame,
    priority: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    rules: Rules = STRICT,
) -> DataFrame:
    """One row for each accepted row: its customer, itself, and the row that survives for that customer.

    ``accepted`` must hold a ``source_system``. Survivors are those of ``first_by_source`` if a ``priority`` of sources
    is given, else of ``first_per_customer``. Ids are computed row by row; only ids and source references are joined to the
    survivors, names and emails stay behind.
    """
    survivors = first_by_source(accepted, priority, order_by) if priority else first_per_customer(accepted, order_by)
    kept = identify(survivors, rules).select(
        "customer_id", F.col("source_system").alias("survivor_system"), F.col("external_id").alias("survivor_id")
    )
    rows = identify(accepted, rules).select("customer_id", "source_system", "external_id")
    return rows.join(kept, "customer_id", "left").select(*LINEAGE_FIELDS)
