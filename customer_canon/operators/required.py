"""The check that an extract has the columns it needs. Metadata only: no Spark job."""

from __future__ import annotations

from collections.abc import Iterable

from customer_canon.errors import IngestionError
from customer_canon.schema import REQUIRED_FIELDS
from customer_canon.sources.providers import Provider


def required_source_fields(provider: Provider) -> set[str]:
    """Source columns behind the required canonical fields; KeyError on an incomplete mapping."""
    return {provider.mapping[field] for field in REQUIRED_FIELDS}


def check_required_fields(available: Iterable[str], required: Iterable[str]) -> None:
    """Raises IngestionError naming the absent columns, sorted. Names must match exactly."""
    missing = set(required).difference(available)
    if missing:
        raise IngestionError("Missing required fields: " + ", ".join(sorted(missing)))
