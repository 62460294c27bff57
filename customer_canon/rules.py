"""The switches that decide how a row is cleaned and routed."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

# Every character Python's str.strip() treats as white space.
UNICODE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


@dataclass(frozen=True)
class Rules:
    """How unsupported countries, missing tax IDs and edge white space are treated.

    on_unsupported_country
        ``reject`` routes the row to the rejects, ``pass`` accepts it with a null
        country, ``fail`` aborts the Spark job at the first such row.
    total
        True: every row is either processed or rejected, and a row without tax ID
        is rejected. False: the tax-ID rule is applied with SQL's three-valued
        logic, so a row for which it is unknown lands in neither output.
    trim
        characters removed from both ends of a tax ID.
    """

    on_unsupported_country: Literal["reject", "pass", "fail"] = "reject"
    total: bool = True
    trim: str = UNICODE_SPACE

    def __post_init__(self) -> None:
        if self.on_unsupported_country not in ("reject", "pass", "fail"):
            raise ValueError(
                f"on_unsupported_country must be reject, pass or fail, not {self.on_unsupported_country!r}"
            )

    @property
    def null_text(self) -> str | None:
        """What stands for a null inside an identity key, where rules let nulls get that far."""
        return "None" if self.on_unsupported_country == "pass" or not self.total else None


STRICT = Rules()

# The looser routing of a plain DataFrame implementation; loses rows, see README.
DF_PARITY = Rules(on_unsupported_country="pass", total=False, trim=" ")
