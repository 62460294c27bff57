"""What has changed between two sets of customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEW, CHANGED, GONE, UNCHANGED = "new", "changed", "gone", "unchanged"

DIGEST = "row_digest"
KEY = "customer_id"


def row_digest(fields: Sequence[str]) -> Column:
    """SHA-256 of the fields, in which a null differs from every text and no two rows run together."""
    return F.unhex(F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def with_digest(customers: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Adds ``row_digest`` of the given fields, by default all but ``customer_id``; stored, it spares reading the fields."""
    fields = list(fields) if fields is not None else [c for c in customers.columns if c not in (KEY, DIGEST)]
    return customers.withColumn(DIGEST, row_digest(fields))


def change_set(
    before: DataFrame, after: DataFrame, fields: Sequence[str] | None = None, keep_unchanged: bool = False
) -> DataFrame:
    """The customers of ``after`` that are new or changed, and the ids of those that are gone, told by ``change``.

    Both hold one row per ``customer_id``. The rows of ``after`` travel whole, those of ``before`` as id and digest: a
    column ``row_digest`` is taken as it is if ``before`` has one (and no ``fields`` are given), else computed over ``fields``,
    by default all columns of ``after``. Rows of customers that are gone are null but for the id. Rows without an id
    match nothing: they are gone or new. An empty side makes all rows of the other new, or gone.
    """
    columns = [c for c in after.columns if c != DIGEST]
    compared = list(fields) if fields is not None else [c for c in columns if c != KEY]
    if fields is None and DIGEST in before.columns:
        earlier = before.select(F.col(KEY).alias("__key"), F.col(DIGEST).alias("__old"))
    else:
        earlier = before.select(F.col(KEY).alias("__key"), row_digest(compared).alias("__old"))
    later = after.select(*columns, row_digest(compared).alias("__new"))
    change = (
        F.when(F.col("__old").isNull(), NEW)
        .when(F.col("__new").isNull(), GONE)
        .when(F.col("__old") != F.col("__new"), CHANGED)
        .otherwise(UNCHANGED)
    )
    both = later.join(earlier, later[KEY] == earlier["__key"], "full_outer")
    rows = both.select(
        F.coalesce(KEY, "__key").alias(KEY), *[c for c in columns if c != KEY], change.alias("change")
    )
    return rows if keep_unchanged else rows.where(F.col("change") != UNCHANGED)
