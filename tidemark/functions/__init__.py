from tidemark.functions.dates import date_key, day_of_week
from tidemark.functions.decode import decode_field, decimal_from_base64, iso_timestamp, micro_timestamp

__all__ = ["date_key", "day_of_week", "decimal_from_base64", "decode_field", "iso_timestamp", "micro_timestamp"]
