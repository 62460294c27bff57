"""The source systems and the columns they use for the canonical fields."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Provider:
    """A source system: its name and where each canonical field comes from.

    ``prepare`` is an optional DataFrame step applied before the mapping, for
    source quirks the declarative mapping cannot express.
    """

    source_system: str
    mapping: Mapping[str, str]
    prepare: Callable[[DataFrame], DataFrame] | None = None


# System names and column layouts (canonical field -> source column).
PROVIDERS = {
    provider.source_system: provider
    for provider in (
        Provider(
            "ERP_A",
            {
                "external_id": "customer_id",
                "name": "name",
                "tax_id": "tax_id",
                "country": "country",
                "email": "email",
            },
        ),
        Provider(
            "ERP_B",
            {
                "external_id": "client_code",
                "name": "legal_name",
                "tax_id": "vat_number",
                "country": "country",
                "email": "contact_email",
            },
        ),
        Provider(
            "ERP_C",
            {
                "external_id": "customer_code",
                "name": "customer_name",
                "tax_id": "fiscal_id",
                "country": "country_code",
                "email": "email_address",
            },
        ),
    )
}


def provider_for(source_system: str) -> Provider:
    provider = PROVIDERS.get(source_system)
    if provider is None:
        raise ValueError(f"Unsupported source system: {source_system}")
    return provider
