"""Changes of a table by key, as frames: what the table holds afterwards.

These forms need no row-level DML from the storage format. Columns that only one
side has are NULL on the rows of the other, so a table gains columns as the data
does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known; a NULL key would match nothing, ever."""
    return frame.dropna(subset=keys)


def repeated_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, and how often."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(frame: DataFrame, keys: list[str]) -> None:
    """Fail if a key occurs twice: an upsert with such a source has no one result."""
    if not repeated_keys(frame, keys).isEmpty():
        raise ValueError(f"source of the upsert holds several rows for one of {keys}")


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """`target` without the rows whose keys occur in `gone`."""
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Both sets of rows, with the columns of either."""
    return target.unionByName(rows, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """`source` replaces the rows of `target` with its keys and adds new ones."""
    source = with_keys(source, keys)
    return append(delete_keys(target, source, keys), source)


def replace_by_key(
    target: DataFrame, source: DataFrame, keys: list[str], touched: DataFrame | None = None
) -> DataFrame:
    """All rows of the touched keys give way to the rows of `source`.

    `touched` defaults to the keys of `source`. Given separately, it also clears
    keys for which no row came back.
    """
    source = with_keys(source, keys)
    return append(delete_keys(target, source if touched is None else touched, keys), source)
