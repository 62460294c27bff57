from customer_canon.sinks.files import (
    canonical_projection,
    raw_rejects,
    read_processed,
    read_rejected,
    write_processed,
    write_rejected,
)

__all__ = [
    "canonical_projection",
    "raw_rejects",
    "read_processed",
    "read_rejected",
    "write_processed",
    "write_rejected",
]
