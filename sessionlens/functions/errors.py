"""Classification of error log records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlens import vocabulary as v


def error_type() -> str:
    """Event type of an error record, as SQL; the first rule that holds decides."""
    return (
        f"CASE WHEN body = '{v.LOG_INTERNAL_ERROR}' THEN '{v.INTERNAL_ERROR}' "
        f"WHEN attributes['query_source'] = '{v.QUERY_SOURCE_BACKGROUND}' "
        f"THEN '{v.BACKGROUND_ABORTED}' "
        f"WHEN attributes['error'] = '{v.ERROR_USER_ABORT}' THEN '{v.USER_ABORTED}' "
        f"ELSE '{v.ERROR}' END"
    )


def error_category() -> Column:
    """Whether the person at the keyboard saw the error; NULL for other events."""
    invisible = (v.INTERNAL_ERROR, v.BACKGROUND_ABORTED, v.USER_ABORTED)
    return F.when(F.col("event_type").isin(*invisible), v.INVISIBLE).when(
        F.col("event_type") == v.ERROR, v.USER_VISIBLE
    )
