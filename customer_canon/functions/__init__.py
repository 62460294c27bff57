from customer_canon.functions.country import country_code
from customer_canon.functions.identity import customer_id, identity_key, uuid5
from customer_canon.functions.tax_id import clean_tax_id, tax_id_is_valid

__all__ = ["clean_tax_id", "country_code", "customer_id", "identity_key", "tax_id_is_valid", "uuid5"]
