"""Scalar column functions (all built-in Spark expressions, no UDFs)."""
from tabclass.functions.calendar import day_of_week, hour_of_day, parse_timestamp, year_diff
from tabclass.functions.casts import safe_double, safe_int, safe_long, trimmed_string
from tabclass.functions.geo import EARTH_RADIUS_KM, haversine_km

__all__ = [
    "EARTH_RADIUS_KM",
    "day_of_week",
    "haversine_km",
    "hour_of_day",
    "parse_timestamp",
    "safe_double",
    "safe_int",
    "safe_long",
    "trimmed_string",
    "year_diff",
]
