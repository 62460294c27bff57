from customer_canon.plans.arriving import run_arriving
from customer_canon.plans.known import KnownCustomers, NewCustomersReport, run_new_customers
from customer_canon.plans.published import PublishedReport, Version, latest, read_published, run_published, versions
from customer_canon.plans.run import RunReport, process_csv, run
from customer_canon.plans.several import SourcesReport, run_sources

__all__ = [
    "KnownCustomers",
    "NewCustomersReport",
    "PublishedReport",
    "RunReport",
    "SourcesReport",
    "Version",
    "latest",
    "process_csv",
    "read_published",
    "run",
    "run_arriving",
    "run_new_customers",
    "run_published",
    "run_sources",
    "versions",
]
