"""The timeline as a stream: same projections, watermark and exactly-once sink."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlens import vocabulary as v
from sessionlens.functions.arithmetic import count_when
from sessionlens.operators import timeline
from sessionlens.plans.silver import merge_events, revise_segments
from sessionlens.sources import schemas
from sessionlens.sources.bronze import Bronze


SEGMENT_GAP_S = 7200


def stream_bronze(spark: SparkSession, directory: str, files_per_trigger: int = 1000) -> Bronze:
    """Streams over the files that arrive in `<directory>/<table>`."""

    def load(table, schema):
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(f"{directory}/{table}")

    return Bronze(
        traces=load(v.BRONZE_TRACES, schemas.TRACES),
        logs=load(v.BRONZE_LOGS, schemas.LOGS),
        metrics=load(v.BRONZE_METRICS, schemas.METRICS),
    )


def stream_events(raw: Bronze) -> DataFrame:
    """Timeline rows as they arrive, repeated deliveries included."""
    return timeline.session_events(raw.traces, raw.logs)


def write_timeline(
    events: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = False,
    segments_table: str | None = None,
    gap_s: int = SEGMENT_GAP_S,
) -> StreamingQuery:
    """Keep `table` as the batch job would write it from all rows that have arrived.

    Each batch is a delivery, named after the checkpoint and its number: no row is too late,
    copies stay copies, and a batch that runs again after a failure counts once. With
    `segments_table`, the segments of the sessions in a batch are cut anew behind it, so
    they too are those of all rows that have arrived.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            merge_events(batch, table, f"{stream}-{number}")
            if segments_table is not None:
                revise_segments(spark, table, segments_table, batch, gap_s)
        finally:
            batch.unpersist()

    writer = (
        events.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _identity(events: DataFrame) -> Column:
    """A digest of the whole row: deliveries that differ anywhere are different events."""
    return F.sha2(F.to_json(F.struct(*events.columns)), 256)


def unrepeated(events: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Rows without repeated deliveries, with a watermark for stateful operators.

    Rows later than `lateness` are left out here; they are in the table that
    `write_timeline` keeps, from which the batch operators take them.
    """
    named = events.withColumn("identity", _identity(events))
    marked = named.withWatermark("event_ts", lateness)
    return marked.dropDuplicatesWithinWatermark(["identity"]).drop("identity")


def stream_segments(events: DataFrame, gap: str = "2 hours") -> DataFrame:
    """Activity of a session between idle gaps, emitted once the gap has passed.

    `events` carries a watermark, as `unrepeated` sets it; rows behind it are left out. For
    segments that later rows revise, see `write_timeline`.
    """
    return (
        events.groupBy("session_id", F.session_window("event_ts", gap).alias("window"))
        .agg(
            F.min("event_ts").alias("segment_start"),
            F.max("event_ts").alias("segment_end"),
            F.count(F.lit(1)).alias("num_events"),
            count_when(F.col("event_type") == v.USER_PROMPT).alias("num_prompts"),
            count_when(F.col("event_type") == v.USER_ABORTED).alias("num_user_aborts"),
        )
        .drop("window")
    )


def write_stream(
    frame: DataFrame, table: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append to `table`; the checkpoint makes each row count once over restarts."""
    writer = frame.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table, format="parquet")
