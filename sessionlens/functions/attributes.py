"""Column helpers over the telemetry attribute maps.

All attribute values are text. Malformed numbers and timestamps become NULL
instead of failing the job, whatever the session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SESSION_KEY = "session.id"


def attr(key: str, column: str = "attributes") -> Column:
    """Text value stored under `key`, NULL when the key is missing."""
    return F.col(column).getItem(key)


def attr_long(key: str, column: str = "attributes") -> Column:
    """Whole-number value; text with a fraction is cut towards zero."""
    return attr(key, column).try_cast("decimal(38,6)").try_cast("bigint")


def attr_double(key: str, column: str = "attributes") -> Column:
    return attr(key, column).try_cast("double")


def first_event_attr(key: str) -> Column:
    """Attribute of the first span event; NULL for spans without events."""
    return F.get(F.col("events"), F.lit(0))["attributes"].getItem(key)


def nanos_to_timestamp(column: str) -> Column:
    """Exact microsecond timestamp of an epoch-nanosecond column."""
    return F.expr(f"timestamp_micros(`{column}` div 1000)")
