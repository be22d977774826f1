"""Metric points of cumulative counters as increases, so that they may be added up.

A cumulative point holds the total since the start of its counter; only its increase since the
previous point of the same series counts. A series is a metric name with its attributes and
those of its resource. A counter that starts anew, or a monotonic one that falls, has begun
again from zero, and its whole value counts.

The previous point of a point is found inside a time bucket of its series; only the first and
last points of buckets are ordered by series, so a series is never ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How exporters name the temporality of running totals.
CUMULATIVE = ("AGGREGATION_TEMPORALITY_CUMULATIVE", "CUMULATIVE", "2")
BUCKET_S = 3600
_SERIES = ["name", "attributes", "resource"]


def _entries(column: str) -> Column:
    """A map as an array that can be compared."""
    return F.sort_array(F.map_entries(column))


def is_cumulative() -> Column:
    named = F.upper(F.trim(F.col("sum.aggregation_temporality"))).isin(*CUMULATIVE)
    return F.coalesce(named, F.lit(False))


def _cumulative_points(metrics: DataFrame) -> DataFrame:
    """Distinct cumulative points; a copy of one says nothing new."""
    rows = metrics.filter(is_cumulative() & F.col("sum.attributes").isNotNull())
    return rows.select(
        "name",
        _entries("sum.attributes").alias("attributes"),
        F.coalesce(_entries("resource.attributes"), F.array()).alias("resource"),
        F.coalesce("sum.start_time_unix_nano", F.lit(0)).alias("start"),
        F.coalesce("sum.time_unix_nano", F.lit(0)).alias("t"),
        F.col("sum.value").alias("value"),
        F.coalesce("sum.is_monotonic", F.lit(True)).alias("monotonic"),
    ).filter(F.col("value").isNotNull() & F.col("name").isNotNull()).distinct()


def increases(metrics: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """(name, attributes, t, value): the increase at each cumulative point."""
    bucket = F.expr(f"t div {bucket_s * 10**9}")
    # The hash decides nearly all comparisons of a sort.
    points = _cumulative_points(metrics).withColumns({"b": bucket, "h": F.xxhash64(*_SERIES)})
    point = F.struct("t", "value", "start")
    in_bucket = Window.partitionBy("h", *_SERIES, "b").orderBy("t", "value", "start")
    placed = points.withColumns(
        {
            "earlier": F.lag(point).over(in_bucket),
            "is_last": F.lead("t").over(in_bucket).isNull(),
        }
    )
    is_first = F.col("earlier").isNull()
    # First and last points of all buckets meet in their series; others stay in their bucket.
    inside = F.when(~is_first & ~F.col("is_last"), F.col("b"))
    of_series = Window.partitionBy("h", *_SERIES, inside).orderBy("b", ~is_first)
    previous = F.coalesce("earlier", F.lag(point).over(of_series))
    again = (
        F.col("previous").isNull()
        | (F.col("previous.start") != F.col("start"))
        | (F.col("monotonic") & (F.col("value") < F.col("previous.value")))
    )
    rise = F.when(again, F.col("value")).otherwise(F.col("value") - F.col("previous.value"))
    attributes = F.map_from_entries("attributes").alias("attributes")
    risen = placed.withColumn("previous", previous)
    return risen.select("name", attributes, "t", rise.alias("value"))


def as_deltas(metrics: DataFrame, bucket_s: int = BUCKET_S) -> DataFrame:
    """Metric points (name and sum) that may be added up, whatever their temporality.

    Points of delta counters, and of an unnamed temporality, stay as they are, copies
    included. Cumulative points without attributes belong to no session and are left out.
    """
    point = F.struct(F.col("sum.value").alias("value"), F.col("sum.attributes").alias("attributes"))
    plain = metrics.filter(~is_cumulative()).select("name", point.alias("sum"))
    risen = increases(metrics, bucket_s).select("name", F.struct("value", "attributes").alias("sum"))
    return plain.unionByName(risen)
