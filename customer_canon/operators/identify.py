"""Attaching the customer identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer_canon.functions import customer_id
from customer_canon.rules import STRICT, Rules


def identify(canonical: DataFrame, rules: Rules = STRICT) -> DataFrame:
    """Adds ``customer_id``; only country and tax ID matter, not name or email."""
    return canonical.withColumn("customer_id", customer_id(F.col("country"), F.col("tax_id"), rules.null_text))
