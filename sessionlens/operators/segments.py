"""Cut a session wherever it lies idle for longer than a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.operators.ordering import BUCKET_S, NO_TIME, located


def idle_segments(events: DataFrame, gap_s: int = 7200) -> DataFrame:
    """Segments of each session: number, bounds and events.

    No two events of a time bucket lie further apart than the bucket is wide, and
    that is at most the gap. So a bucket is never cut, and only one row per
    bucket has to be ordered. Events without a timestamp belong to no segment.
    """
    timed = located(events.select("session_id", "event_ts"), min(BUCKET_S, gap_s)).filter(
        F.col("t") > NO_TIME
    )
    buckets = timed.groupBy("session_id", "b").agg(
        F.min("t").alias("start_t"), F.max("t").alias("end_t"), F.count(F.lit(1)).alias("events")
    )
    in_time = Window.partitionBy("session_id").orderBy("b")
    idle = F.col("start_t") - F.lag("end_t").over(in_time) > gap_s * 1_000_000
    return (
        buckets.withColumn("cut", F.coalesce(idle, F.lit(False)).cast("long"))
        .withColumn("segment", F.sum("cut").over(in_time))
        .groupBy("session_id", "segment")
        .agg(
            F.timestamp_micros(F.min("start_t")).alias("segment_start"),
            F.timestamp_micros(F.max("end_t")).alias("segment_end"),
            F.sum("events").alias("num_events"),
        )
    )
