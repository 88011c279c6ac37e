from strataflow.functions.columns import bucketize, drop_columns, regex_clean, upper_columns
from strataflow.functions.keys import bucket_of, key_hash, payload_order, search_steps, upper_bound

__all__ = [
    "bucketize", "drop_columns", "regex_clean", "upper_columns",
    "bucket_of", "key_hash", "payload_order", "search_steps", "upper_bound",
]
