"""Column expressions."""

from txrisk.functions.calendar import day_of_week, hour_of_day, is_weekend, parse_timestamp
from txrisk.functions.hashing import md5_bucket
from txrisk.functions.payload import decode_record, encode_record
from txrisk.functions.quality import all_present, p_positive

__all__ = [
    "all_present",
    "day_of_week",
    "decode_record",
    "encode_record",
    "hour_of_day",
    "is_weekend",
    "md5_bucket",
    "p_positive",
    "parse_timestamp",
]
