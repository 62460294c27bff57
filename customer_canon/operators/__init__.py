from customer_canon.operators.changes import change_set, with_digest
from customer_canon.operators.classify import classify, process, processed, rejected
from customer_canon.operators.dedup import any_per_customer, first_by_source, first_per_customer
from customer_canon.operators.identify import identify
from customer_canon.operators.lineage import lineage
from customer_canon.operators.mapping import carried_columns, map_columns, transform, with_provenance
from customer_canon.operators.merge import merge_per_customer
from customer_canon.operators.required import check_required_fields, required_source_fields

__all__ = [
    "any_per_customer",
    "carried_columns",
    "change_set",
    "check_required_fields",
    "classify",
    "first_by_source",
    "first_per_customer",
    "identify",
    "lineage",
    "map_columns",
    "merge_per_customer",
    "process",
    "processed",
    "rejected",
    "required_source_fields",
    "transform",
    "with_digest",
    "with_provenance",
]
