"""Cleaning and checking of tax IDs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from customer_canon.rules import UNICODE_SPACE

# Fixed values of the one business rule: Spanish tax IDs have nine characters.
FIXED_LENGTH_COUNTRY = "ES"
FIXED_LENGTH = 9


def clean_tax_id(tax_id: Column, country: Column, trim: str = UNICODE_SPACE) -> Column:
    """Trim, upper-case, drop ``-`` and blanks, then drop one leading country code.

    ``country`` must already be a two-letter code; a null country keeps the value.
    """
    trimmed = F.upper(F.btrim(tax_id, F.lit(trim)))
    compact = F.replace(F.replace(trimmed, F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    return F.when(F.startswith(compact, country), F.substr(compact, F.lit(3))).otherwise(compact)


def tax_id_is_valid(tax_id: Column, country: Column, elsewhere: Column | bool = True) -> Column:
    """The length rule in three-valued logic: null for a null Spanish tax ID.

    ``elsewhere`` is the verdict for all countries that have no length rule.
    """
    return F.when(country == FIXED_LENGTH_COUNTRY, F.length(tax_id) == FIXED_LENGTH).otherwise(elsewhere)
