"""Country spellings to ISO 3166-1 alpha-2 codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The country names that are understood, case-sensitive and untrimmed.
COUNTRY_NAMES = {"Spain": "ES", "France": "FR", "Germany": "DE"}


def country_code(country: Column, names: dict[str, str] = COUNTRY_NAMES) -> Column:
    """The code for a known name or known code; null for everything else.

    The lookup is a constant map inside the expression, so it costs neither a
    join nor a broadcast however many rows there are.
    """
    spellings = names | {code: code for code in names.values()}
    lookup = F.create_map(*map(F.lit, chain.from_iterable(spellings.items())))
    return F.try_element_at(lookup, country)
