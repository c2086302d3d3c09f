from urbanstats.functions.scalars import (
    day_part,
    day_part_of_hhmm,
    hour_of_hhmm,
    int_or_zero,
    key_present,
    parse_currency,
    parse_timestamp,
    safe_ratio,
)
from urbanstats.functions.udfs import day_part_udf

__all__ = [
    "day_part",
    "day_part_of_hhmm",
    "day_part_udf",
    "hour_of_hhmm",
    "int_or_zero",
    "key_present",
    "parse_currency",
    "parse_timestamp",
    "safe_ratio",
]
