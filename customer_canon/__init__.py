"""Customer master data from several business systems in one canonical form, as Spark jobs.

The package is layered from small to large:

* ``functions``  Column -> Column: country code, tax ID, identity
* ``operators``  DataFrame -> DataFrame: mapping, classification, first-wins
* ``sources``    column layouts of the source systems, CSV scan
* ``sinks``      Parquet and JSON outputs with fixed layouts
* ``plans``      whole runs with counts and ledger; the job entry point
"""

from customer_canon.errors import IngestionError
from customer_canon.operators.classify import classify, process, processed, rejected
from customer_canon.operators.dedup import first_per_customer
from customer_canon.operators.identify import identify
from customer_canon.plans.run import process_csv, run
from customer_canon.rules import DF_PARITY, STRICT, Rules
from customer_canon.sources.providers import Provider, provider_for

__all__ = [
    "DF_PARITY",
    "STRICT",
    "IngestionError",
    "Provider",
    "Rules",
    "classify",
    "first_per_customer",
    "identify",
    "process",
    "process_csv",
    "processed",
    "provider_for",
    "rejected",
    "run",
]
