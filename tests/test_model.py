"""Whole runs on random dirty CSV against a row-at-a-time model in plain Python."""

import csv
import json
import random
import uuid
from pathlib import Path

import pytest

from customer_canon import DF_PARITY, STRICT, provider_for, run

NAMESPACE = uuid.UUID("57da2380-82c6-40a6-8e94-a77ee513bdfd")
CODES = {"Spain": "ES", "France": "FR", "Germany": "DE", "ES": "ES", "FR": "FR", "DE": "DE"}
COLUMNS = ["client_code", "legal_name", "vat_number", "country", "contact_email", "unmapped"]


def dirty_rows(seed, count):
    generator = random.Random(seed)

    def cell(alphabet, longest):
        return "".join(generator.choices(alphabet, k=generator.randint(0, longest)))

    def tax_id():
        digits = f"B{generator.randint(0, 40):08d}" if generator.random() < 0.8 else cell("B12-　 \t", 10)
        prefix = generator.choice(["", "", "ES", "es-", "FR ", "E-S", "ESES"])
        edge = generator.choice(["", " ", "\t", " ", " \u0085 "])
        return edge + prefix + digits + edge

    for number in range(count):
        yield {
            "client_code": f"{generator.randint(0, 999):04d}",
            "legal_name": cell('aß ",\n\\\'é;|#', 8),
            "vat_number": tax_id() if generator.random() < 0.95 else "",
            "country": generator.choice([*CODES, *CODES, "Italy", "spain", " ES", ""]),
            "contact_email": cell("x@", 3),
            "unmapped": str(number),
        }


def model(rows, strict):
    """(customers, rejects, accepted count) of a run, one row after the other."""
    customers, rejects, accepted = {}, [], 0
    for row in rows:
        row = {key: value or None for key, value in row.items()}
        country, tax_id = CODES.get(row["country"]), row["vat_number"]
        if tax_id is not None:
            tax_id = (tax_id.strip() if strict else tax_id.strip(" ")).upper().replace("-", "").replace(" ", "")
            tax_id = tax_id.removeprefix(country or "")
        if strict and country is None:
            reason = "Unsupported country"
        elif strict and not tax_id:
            reason = "Invalid tax ID"
        elif country == "ES" and tax_id is None:
            continue
        else:
            reason = "Invalid tax ID" if country == "ES" and len(tax_id) != 9 else None
        canonical = (row["client_code"], row["legal_name"], tax_id, country, row["contact_email"])
        if reason:
            rejects.append((*canonical, reason, row))
        else:
            accepted += 1
            customer_id = str(uuid.uuid5(NAMESPACE, f"{country}:{tax_id}"))
            customers.setdefault(customer_id, (*canonical, customer_id))
    return sorted(map(repr, customers.values())), sorted(map(repr, rejects)), accepted


@pytest.mark.parametrize("rules", [STRICT, DF_PARITY], ids=["strict", "parity"])
@pytest.mark.parametrize("seed", range(3))
def test_run_equals_model(spark, tmp_path, seed, rules):
    source, processed, rejected = (tmp_path / name for name in ("in.csv", "processed", "rejected"))
    rows = list(dirty_rows(seed, 1500))
    with source.open("w", encoding="utf-8", newline="") as file:
        writer = csv.DictWriter(file, COLUMNS, lineterminator="\n")
        writer.writeheader()
        writer.writerows(rows)

    report = run(
        spark, str(source), str(processed), str(rejected), provider_for("ERP_B"), rules=rules, multi_line=True
    )

    customers, rejects, accepted = model(rows, strict=rules is STRICT)
    assert sorted(repr(tuple(r)) for r in spark.read.parquet(str(processed)).collect()) == customers
    written = [json.loads(line) for f in Path(rejected).glob("*.json") for line in f.open(encoding="utf-8")]
    fields = ("external_id", "name", "tax_id", "country", "email", "reason", "raw_record")
    assert sorted(repr(tuple(r[f] for f in fields)) for r in written) == rejects
    assert (report.processed_count, report.rejected_count, report.unique_count) == (
        accepted,
        len(rejects),
        len(customers),
    )
    if rules is STRICT:
        assert report.processed_count + report.rejected_count == len(rows)
