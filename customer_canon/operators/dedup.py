"""One row per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from customer_canon.sources.csv_scan import INPUT_POSITION

# The pair that determines customer_id, the more selective column first: rows are
# sorted by it, and a sort is fastest when its first column tells rows apart.
IDENTITY_COLUMNS = ("tax_id", "country")

_RANK = "__rank"


def input_order(canonical: DataFrame) -> list[Column]:
    """Input position where known, else external_id; remaining columns break ties."""
    if INPUT_POSITION in canonical.columns:
        return [F.col(INPUT_POSITION)]
    return [F.col(c) for c in ("external_id", "name", "email")]


def first_per_customer(canonical: DataFrame, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Keeps the first row per (country, tax_id) in ``order_by``, by default the input order.

    Spark prunes to one row per key inside every task before the shuffle
    (WindowGroupLimit), so a key that holds a third of the input sends one row
    per task, not its whole group. The identity is determined by the key, which
    is why it can be computed afterwards, on the survivors only.
    """
    order = list(order_by) if order_by is not None else input_order(canonical)
    by_customer = Window.partitionBy(*IDENTITY_COLUMNS).orderBy(*order)
    return canonical.withColumn(_RANK, F.row_number().over(by_customer)).filter(F.col(_RANK) == 1).drop(_RANK)


def source_rank(priority: Sequence[str]) -> Column:
    """Place of ``source_system`` in ``priority``; those not named share the place behind the last."""
    named = F.array_position(F.array(*[F.lit(source) for source in priority]), F.col("source_system"))
    return F.when(named > 0, named).otherwise(len(priority) + 1)


def first_by_source(
    canonical: DataFrame, priority: Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Keeps per (country, tax_id) the first row of the source that comes first in ``priority``.

    Sources are told by ``source_system``; those not named come last, in the order of their names. Within a source
    the order is ``order_by``, by default the input order. It is the same single pruned window.
    """
    order = list(order_by) if order_by is not None else input_order(canonical)
    return first_per_customer(canonical, [source_rank(priority), F.col("source_system"), *order])


def any_per_customer(identified: DataFrame) -> DataFrame:
    """Keeps one row per ``customer_id``, no matter which."""
    return identified.dropDuplicates(["customer_id"])
