"""Deterministic customer identity as a native expression (no Python worker)."""

from __future__ import annotations

from uuid import UUID

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value and fixed key format (``country:tax_id``): a persistent contract,
# changing either changes every stored customer_id.
CUSTOMER_NAMESPACE = UUID("57da2380-82c6-40a6-8e94-a77ee513bdfd")


def identity_key(country: Column, tax_id: Column, null_text: str | None = None) -> Column:
    """``country:tax_id``. Null if a part is null, unless ``null_text`` stands in for it."""
    if null_text is not None:
        country, tax_id = (F.coalesce(part, F.lit(null_text)) for part in (country, tax_id))
    return F.concat(country, F.lit(":"), tax_id)


def uuid5(namespace: UUID, name: Column) -> Column:
    """RFC 4122 version 5 UUID text of ``name``; null for a null name.

    SHA-1 over namespace and UTF-8 name, first 16 bytes, with the version digit
    set to 5 and the top two bits of the variant digit set to binary 10.
    """
    digest = F.sha1(F.concat(F.lit(namespace.bytes), name.cast("binary")))

    def hex_digits(first: int, last: int) -> Column:
        return F.substring(digest, first, last - first + 1)

    variant = F.translate(hex_digits(17, 17), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        hex_digits(1, 8),
        F.lit("-"),
        hex_digits(9, 12),
        F.lit("-5"),
        hex_digits(14, 16),
        F.lit("-"),
        variant,
        hex_digits(18, 20),
        F.lit("-"),
        hex_digits(21, 32),
    )


def customer_id(country: Column, tax_id: Column, null_text: str | None = None) -> Column:
    return uuid5(CUSTOMER_NAMESPACE, identity_key(country, tax_id, null_text))
