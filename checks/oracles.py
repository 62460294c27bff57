"""The registered queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations

# Code points of white space that is trimmed, spelled out anew.
_SPACES = " || ".join(
    f"chr({point})"
    for point in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def _extract(source_system: str, table: str, k: str, r: str, external_id: str, name: str) -> str:
    """SELECT of an extract under canonical names, cells untouched."""
    return f"""
      SELECT '{source_system}' AS source_system, {external_id} AS external_id, {name} AS name,
        CASE WHEN k % 101 = 100 THEN NULL
             WHEN r % 5 = 0 THEN body
             WHEN r % 5 = 1 THEN ' ' || lower(code) || '-' || substr(body, 1, 3) || ' ' || substr(body, 4) || ' '
             WHEN r % 5 = 2 THEN code || body
             WHEN r % 5 = 3 THEN lower('B-' || substr(body, 2))
             ELSE chr(9) || body END AS tax_id,
        CASE WHEN k % 97 = 96 THEN NULL
             WHEN k % 8 IN (0, 6) THEN 'Spain' WHEN k % 8 = 1 THEN 'ES'
             WHEN k % 8 = 2 THEN 'France' WHEN k % 8 = 3 THEN 'FR'
             WHEN k % 8 = 4 THEN 'Germany' WHEN k % 8 = 5 THEN 'DE' ELSE 'Italy' END AS country,
        CASE WHEN r % 4 <> 0 THEN 'u' || CAST(r AS VARCHAR) || '@example.com' END AS email
      FROM (
        SELECT *,
          CASE WHEN k % 10 = 7 THEN 'B' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0')
               ELSE 'B' || lpad(CAST(k AS VARCHAR), 8, '0') END AS body,
          CASE WHEN k % 8 IN (0, 1, 6) THEN 'ES' WHEN k % 8 IN (2, 3) THEN 'FR'
               WHEN k % 8 IN (4, 5) THEN 'DE' ELSE 'IT' END AS code
        FROM (SELECT *, {k} AS k, {r} AS r FROM {table}))"""


_EXTRACTS = {
    "ERP_A": _extract(
        "ERP_A", "customer", "c_custkey", "c_custkey", "'C' || lpad(CAST(k AS VARCHAR), 9, '0')", "c_name"
    ),
    "ERP_B": _extract(
        "ERP_B",
        "orders",
        "o_custkey",
        "o_orderkey",
        "'O' || lpad(CAST(r AS VARCHAR), 9, '0')",
        "'Buyer ' || CAST(k AS VARCHAR) || ' ' || o_orderpriority",
    ),
    "ERP_C": _extract(
        "ERP_C", "supplier", "s_suppkey", "s_suppkey", "'S' || lpad(CAST(k AS VARCHAR), 9, '0')", "s_name"
    ),
}

_SKEWED = _extract(
    "ERP_A",
    "lineitem",
    "CASE WHEN l_orderkey % 3 = 0 THEN 1000 ELSE l_orderkey END",
    "l_orderkey * 8 + l_linenumber",
    "'L' || lpad(CAST(r AS VARCHAR), 10, '0')",
    "'Part ' || CAST(l_partkey AS VARCHAR)",
)


def _with(extract: str, trim: str, accept: str, part: str) -> str:
    """CTEs: extract -> coded -> cleaned -> judged (is_valid, reason) -> identified."""
    return f"""
    WITH extract AS ({extract}),
    coded AS (
      SELECT * RENAME (country AS source_country, tax_id AS source_tax_id),
        CASE WHEN country IN ('ES', 'FR', 'DE') THEN country WHEN country = 'Spain' THEN 'ES'
             WHEN country = 'France' THEN 'FR' WHEN country = 'Germany' THEN 'DE' END AS country,
        replace(replace(upper(trim(tax_id, {trim})), '-', ''), ' ', '') AS compact
      FROM extract),
    cleaned AS (
      SELECT * EXCLUDE (compact),
        CASE WHEN substr(compact, 1, 2) = country THEN substr(compact, 3) ELSE compact END AS tax_id
      FROM coded),
    judged AS (SELECT *, {accept} AS is_valid FROM cleaned),
    keyed AS (SELECT *, {part.format("country")} || ':' || {part.format("tax_id")} AS identity_key FROM judged),
    hashed AS (
      SELECT *, sha1(unhex('57da238082c640a68e94a77ee513bdfd') || encode(identity_key)) AS h FROM keyed),
    identified AS (
      SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
        || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
        || '-' || substr(h, 21, 12) AS customer_id
      FROM hashed),
    ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY source_system, country, tax_id
        ORDER BY external_id, name NULLS FIRST, email NULLS FIRST) AS place,
        row_number() OVER (PARTITION BY source_system, country, tax_id ORDER BY external_id DESC) AS place_from_last
      FROM identified WHERE is_valid)"""


_STRICT_ACCEPT = """country IS NOT NULL AND coalesce(tax_id <> '', FALSE)
      AND (country <> 'ES' OR length(tax_id) = 9)"""
_ANY_COUNTRY_ACCEPT = """coalesce(tax_id <> '', FALSE)
      AND (country IS DISTINCT FROM 'ES' OR length(tax_id) = 9)"""
_PARITY_ACCEPT = "CASE WHEN country = 'ES' THEN length(tax_id) = 9 ELSE TRUE END"


def _strict(extract: str) -> str:
    return _with(extract, _SPACES, _STRICT_ACCEPT, "{}")


_ALL = " UNION ALL ".join(_EXTRACTS.values())
_STRICT_ALL = _strict(_ALL)
_PARITY_ALL = _with(_ALL, "' '", _PARITY_ACCEPT, "coalesce({}, 'None')")

_CANONICAL = "external_id, name, tax_id, country, email"
_REASON = "CASE WHEN country IS NULL THEN 'Unsupported country' ELSE 'Invalid tax ID' END AS reason"
_DETAIL = """CASE WHEN country IS NULL THEN 'Unsupported country: ' || coalesce(source_country, '(missing)')
    ELSE 'Invalid tax ID for country ' || country END AS reason_detail"""
_MAPPED = "SELECT external_id, name, tax_id, country, email FROM ({})"

_LEDGER_ERROR = "Missing required fields: vat_number"


def _required_fields() -> str:
    columns = {
        "ERP_A": ("customer_id", "name", "tax_id", "country", "email"),
        "ERP_B": ("client_code", "legal_name", "vat_number", "country", "contact_email"),
        "ERP_C": ("customer_code", "customer_name", "fiscal_id", "country_code", "email_address"),
    }
    fields = ("external_id", "name", "tax_id", "country", "email")
    return " UNION ALL ".join(
        f"""SELECT '{source}' AS source_system, '{column}' AS source_column, {int(field != "email")} AS required,
          count(*) AS row_count, count({field}) AS filled_count FROM ({_EXTRACTS[source]})"""
        for source, names in columns.items()
        for field, column in zip(fields, names)
    )


# rows of a customer over all sources: suppliers, then customers, then orders
_RANKED = f"""{_STRICT_ALL}, best AS (
  SELECT *, row_number() OVER (
    PARTITION BY country, tax_id
    ORDER BY CASE source_system WHEN 'ERP_C' THEN 1 WHEN 'ERP_A' THEN 2 ELSE 3 END,
      external_id, name NULLS FIRST, email NULLS FIRST) AS place
  FROM identified WHERE is_valid)"""

ORACLES: dict[str, str] = {
    "map_source_a": _MAPPED.format(_EXTRACTS["ERP_A"]),
    "map_source_b": _MAPPED.format(_EXTRACTS["ERP_B"]),
    "map_source_c": _MAPPED.format(_EXTRACTS["ERP_C"]),
    "map_missing_email": f"""SELECT external_id, name, tax_id, country, CAST(NULL AS VARCHAR) AS email
      FROM ({_EXTRACTS["ERP_B"]})""",
    "provenance": f"{_STRICT_ALL} SELECT source_system, {_CANONICAL} FROM judged WHERE is_valid",
    "normalize_country": f"{_STRICT_ALL} SELECT source_system, external_id, source_country, country FROM coded",
    "normalize_tax_id": f"{_STRICT_ALL} SELECT source_system, external_id, source_tax_id, tax_id FROM cleaned",
    "transform": f"{_STRICT_ALL} SELECT source_system, {_CANONICAL} FROM cleaned",
    "validate_tax_id": f"""{_STRICT_ALL}
      SELECT source_system, external_id, tax_id, country,
        CASE WHEN country = 'ES' AND tax_id IS NULL THEN 'unknown'
             WHEN country = 'ES' AND length(tax_id) <> 9 THEN 'invalid' ELSE 'valid' END AS verdict
      FROM cleaned""",
    "processed": f"{_STRICT_ALL} SELECT source_system, {_CANONICAL} FROM judged WHERE is_valid",
    "rejected": f"""{_STRICT_ALL}
      SELECT source_system, {_CANONICAL}, {_REASON}, {_DETAIL} FROM judged WHERE NOT is_valid""",
    "rejected_raw": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT external_id AS client_code, name AS legal_name, source_tax_id AS vat_number, source_country AS country,
        email AS contact_email, reason_detail AS reason,
        CAST(json_object('client_code', external_id, 'legal_name', name, 'vat_number', source_tax_id,
          'country', source_country, 'contact_email', email) AS VARCHAR) AS raw_json
      FROM (SELECT *, {_DETAIL} FROM judged WHERE NOT is_valid)""",
    "processed_df_parity": f"""{_PARITY_ALL}
      SELECT source_system, {_CANONICAL}, customer_id FROM identified WHERE is_valid""",
    "rejected_df_parity": f"""{_PARITY_ALL}
      SELECT source_system, {_CANONICAL}, 'Invalid tax ID' AS reason FROM judged WHERE NOT is_valid""",
    "outcome_counts": f"""{_STRICT_ALL}
      SELECT source_system, outcome, count(*) AS row_count
      FROM (SELECT source_system, CASE WHEN is_valid THEN 'processed' ELSE reason END AS outcome
            FROM (SELECT *, {_REASON} FROM judged))
      GROUP BY source_system, outcome""",
    "required_fields": _required_fields(),
    "identity_key": f"{_STRICT_ALL} SELECT source_system, external_id, identity_key FROM keyed WHERE is_valid",
    "customer_id": f"{_STRICT_ALL} SELECT source_system, external_id, customer_id FROM identified WHERE is_valid",
    "dedup_count": f"""{_STRICT_ALL}
      SELECT source_system, count(DISTINCT customer_id) AS customer_count FROM identified WHERE is_valid
      GROUP BY source_system""",
    "dedup_first_wins": f"{_STRICT_ALL} SELECT source_system, {_CANONICAL}, customer_id FROM ranked WHERE place = 1",
    "first_wins_skewed": f"{_strict(_SKEWED)} SELECT {_CANONICAL}, customer_id FROM ranked WHERE place = 1",
    "canonical_projection": f"""{_STRICT_ALL}
      SELECT source_system, customer_id, name, tax_id, country, email FROM ranked WHERE place = 1""",
    "scan_csv": f"""SELECT external_id AS client_code, name AS legal_name, tax_id AS vat_number, country,
      email AS contact_email FROM ({_EXTRACTS["ERP_B"]})""",
    "csv_to_processed": f"{_strict(_EXTRACTS['ERP_C'])} SELECT {_CANONICAL} FROM judged WHERE is_valid",
    "sink_parquet_roundtrip": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT {_CANONICAL}, customer_id FROM ranked WHERE place = 1""",
    "sink_json_roundtrip": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT {_CANONICAL}, {_REASON}, {_DETAIL}, external_id AS raw_client_code, name AS raw_legal_name,
        source_tax_id AS raw_vat_number, source_country AS raw_country, email AS raw_contact_email
      FROM judged WHERE NOT is_valid""",
    "run_ledger": f"""{_STRICT_ALL}
      SELECT source_system, 'COMPLETED' AS status, CAST(NULL AS VARCHAR) AS error,
        count(*) FILTER (is_valid) AS processed_count, count(*) FILTER (NOT is_valid) AS rejected_count,
        count(DISTINCT customer_id) FILTER (is_valid) AS unique_count,
        count(*) FILTER (is_valid AND name IS NULL) AS unnamed_count
      FROM identified GROUP BY source_system
      UNION ALL SELECT 'ERP_B', 'FAILED', '{_LEDGER_ERROR}', NULL, NULL, NULL, NULL""",
    "job_end_to_end": f"""{_STRICT_ALL}
      SELECT 'processed' AS outcome, source_system, {_CANONICAL}, customer_id, CAST(NULL AS VARCHAR) AS reason,
        CAST(NULL AS VARCHAR) AS reason_detail FROM ranked WHERE place_from_last = 1
      UNION ALL
      SELECT 'rejected', source_system, {_CANONICAL}, NULL, {_REASON}, {_DETAIL} FROM judged WHERE NOT is_valid""",
    "job_source_layout": f"""{_strict(_EXTRACTS["ERP_A"])}
      SELECT customer_id, name, tax_id, country, email, CAST(NULL AS VARCHAR) AS reason,
        CAST(NULL AS VARCHAR) AS external_id FROM ranked WHERE place_from_last = 1
      UNION ALL
      SELECT NULL, NULL, source_tax_id, NULL, NULL, reason_detail, external_id
      FROM (SELECT *, {_DETAIL} FROM judged WHERE NOT is_valid)""",
    "processed_any_country": f"""{_with(_ALL, _SPACES, _ANY_COUNTRY_ACCEPT, "{}")}
      SELECT source_system, {_CANONICAL} FROM judged WHERE is_valid""",
    "scan_csv_multi_line": f"""SELECT external_id AS customer_code, '"' || name || '", a' || chr(10) || 'b,"",' AS customer_name,
      tax_id AS fiscal_id, country AS country_code, email AS email_address FROM ({_EXTRACTS["ERP_C"]})""",
    "provider_prepare": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT external_id, upper(name) AS name, tax_id, country, email, customer_id, CAST(NULL AS VARCHAR) AS reason,
        CAST(NULL AS VARCHAR) AS raw_name, CAST(NULL AS VARCHAR) AS vat_number FROM ranked WHERE place_from_last = 1
      UNION ALL
      SELECT external_id, upper(name), tax_id, country, email, NULL, {_REASON}, name, source_tax_id
      FROM judged WHERE NOT is_valid""",
    "rejected_malformed": f"""{_strict(_EXTRACTS["ERP_B"])},
      lines AS (
        SELECT *, CAST(substr(external_id, 2) AS BIGINT) % 7 AS turn,
          external_id || ',' || name || ',' || coalesce(source_tax_id, '') AS three,
          ',' || coalesce(source_country, '') || ',' || coalesce(email, '') AS two FROM judged)
      SELECT external_id, CASE WHEN turn < 2 THEN 'Malformed record' ELSE {_REASON.removesuffix(" AS reason")} END AS reason,
        CASE turn WHEN 0 THEN three || two || ',extra' WHEN 1 THEN three END AS raw_line
      FROM lines WHERE turn < 2 OR NOT is_valid""",
    "survivors_by_source": f"{_RANKED} SELECT source_system, {_CANONICAL}, customer_id FROM best WHERE place = 1",
    "lineage": f"""{_RANKED}
      SELECT b.customer_id, b.source_system, b.external_id,
        s.source_system AS survivor_system, s.external_id AS survivor_id
      FROM best b JOIN best s ON s.customer_id = b.customer_id AND s.place = 1""",
    "new_customers": f"""{_STRICT_ALL}
      SELECT DISTINCT customer_id, tax_id, country FROM identified n
      WHERE is_valid AND source_system = 'ERP_B' AND NOT EXISTS (
        SELECT 1 FROM identified o WHERE o.is_valid AND o.source_system = 'ERP_C' AND o.customer_id = n.customer_id)""",
    "sources_run": f"""{_RANKED}
      SELECT b.customer_id, b.source_system, b.external_id, s.source_system AS survivor_system
      FROM best b JOIN best s ON s.customer_id = b.customer_id AND s.place = 1""",
    "merged_fields": f"""{_RANKED}
      SELECT arg_min(external_id, place) AS external_id, arg_min(source_system, place) AS source_system, tax_id, country,
        arg_min(name, place) AS name, arg_min(external_id, place) FILTER (name IS NOT NULL) AS name_from,
        arg_min(source_system, place) FILTER (name IS NOT NULL) AS name_source,
        arg_min(email, place) AS email, arg_min(external_id, place) FILTER (email IS NOT NULL) AS email_from,
        arg_min(source_system, place) FILTER (email IS NOT NULL) AS email_source
      FROM best GROUP BY tax_id, country""",
    "change_set": f"""{_STRICT_ALL},
      accepted AS (SELECT {_CANONICAL}, customer_id, source_system FROM identified WHERE is_valid AND source_system <> 'ERP_B'),
      old AS (
        SELECT * FROM accepted WHERE source_system = 'ERP_A' AND name NOT LIKE '%7'
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY external_id, name NULLS FIRST, email NULLS FIRST) = 1),
      young AS (
        SELECT * FROM accepted WHERE source_system = 'ERP_C' OR email IS NOT NULL
        QUALIFY row_number() OVER (
          PARTITION BY customer_id ORDER BY source_system DESC, external_id, name NULLS FIRST, email NULLS FIRST) = 1)
      SELECT y.external_id, y.name, y.tax_id, y.country, y.email, coalesce(y.customer_id, o.customer_id) AS customer_id,
        CASE WHEN o.customer_id IS NULL THEN 'new' WHEN y.customer_id IS NULL THEN 'gone' ELSE 'changed' END AS change
      FROM old o FULL JOIN young y ON o.customer_id = y.customer_id
      WHERE o.customer_id IS NULL OR y.customer_id IS NULL OR o.external_id IS DISTINCT FROM y.external_id
        OR o.name IS DISTINCT FROM y.name OR o.email IS DISTINCT FROM y.email""",
    "published_run": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT {_CANONICAL}, customer_id, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS reason_detail, 2 AS version
      FROM ranked WHERE place_from_last = 1
      UNION ALL
      SELECT {_CANONICAL}, NULL, {_REASON}, {_DETAIL}, 2 FROM judged WHERE NOT is_valid""",
    "arriving_files": f"""{_strict(_EXTRACTS["ERP_B"])}
      SELECT DISTINCT customer_id, tax_id, country FROM identified WHERE is_valid""",
}
