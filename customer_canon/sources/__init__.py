from customer_canon.sources.csv_scan import scan_csv, with_input_position
from customer_canon.sources.providers import PROVIDERS, Provider, provider_for

__all__ = ["PROVIDERS", "Provider", "provider_for", "scan_csv", "with_input_position"]
