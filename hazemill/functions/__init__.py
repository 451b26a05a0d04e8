"""Column builders. Every one stays inside Catalyst: no Python UDF anywhere."""

from hazemill.functions.air import aqi, aqi_category
from hazemill.functions.checks import reason_message, spec_columns, validate_code
from hazemill.functions.hashing import fnv1a_32, fnv1a_64, rendezvous_owner, station_slug
from hazemill.functions.numeric import exact_mean, exact_sum, round_half_up, round_window
from hazemill.functions.sql import register_sql_functions
from hazemill.functions.times import micros, parse_ts

__all__ = [
    "aqi",
    "aqi_category",
    "exact_mean",
    "exact_sum",
    "fnv1a_32",
    "fnv1a_64",
    "micros",
    "parse_ts",
    "reason_message",
    "register_sql_functions",
    "rendezvous_owner",
    "round_half_up",
    "round_window",
    "spec_columns",
    "station_slug",
    "validate_code",
]
