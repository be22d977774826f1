"""Bronze -> silver: session metrics, session summary, session timeline."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.operators import metrics as metric_operators
from sessionlens.operators import summary as summary_operators
from sessionlens.operators import segments, temporality, timeline, worksets
from sessionlens.plans import timeline_days
from sessionlens.plans.timeline_days import BASE, DELIVERY, EVENT_DAY
from sessionlens.sinks import tables
from sessionlens.sinks.partitions import schema_of
from sessionlens.sources import bronze, ledger, schemas

_KEY = ["session_id"]
#: Partition columns of the timeline table.
LAYOUT = [EVENT_DAY, DELIVERY]
#: Partition column of a table of segments.
SEGMENT_DAY = "segment_day"
#: Table of the bronze files that updates have processed.
LEDGER = "bronze_ledger"


def silver_etl(spark: SparkSession, bronze_schema: str, silver_schema: str) -> None:
    """Build the silver tables of `silver_schema` from the bronze tables.

    Sessions found in bronze replace their silver rows, others keep theirs. The
    metrics come first, as the summary takes cost and active time from them.
    """
    _write_silver(spark, bronze.from_catalog(spark, bronze_schema), silver_schema)


def silver_update(
    spark: SparkSession, bronze_schema: str, silver_schema: str, margin: str = ledger.MARGIN
) -> int:
    """Bring what has come into the bronze tables since the last update; returns the number of
    sessions it touched.

    Reads the new files, and those older ones that hold rows of the same sessions. The tables
    are then as `silver_etl` would write them from all rows.
    """
    tables.ensure_schema(spark, silver_schema)
    raw = bronze.from_catalog(spark, bronze_schema)
    with tables.Staging(spark, silver_schema) as staging:
        update = ledger.Update(raw, f"{silver_schema}.{LEDGER}", staging, margin)
        if update.is_empty():
            return 0
        _write_silver(spark, update.raw, silver_schema)
        update.finish()
        return update.touched.count()


def _write_silver(spark: SparkSession, raw: bronze.Bronze, silver_schema: str) -> None:
    tables.ensure_schema(spark, silver_schema)
    metrics_table = f"{silver_schema}.{v.SILVER_METRICS}"
    summary_table = f"{silver_schema}.{v.SILVER_SUMMARY}"
    tables.ensure_table(spark, metrics_table, schemas.SESSION_METRICS)
    tables.ensure_table(spark, summary_table, schemas.SESSION_SUMMARY)
    with tables.Staging(spark, silver_schema) as staging:
        points = temporality.as_deltas(raw.metrics)
        by_session = staging.keep(metric_operators.session_metrics(points))
        tables.upsert(by_session, metrics_table, _KEY)
        summary = staging.keep(summary_operators.session_summary(raw.traces, by_session))
        tables.upsert(summary, summary_table, _KEY)

    write_timeline(raw, f"{silver_schema}.{v.SILVER_EVENTS}")


def by_day(events: DataFrame, delivery: str = BASE) -> DataFrame:
    """Timeline rows with their day and delivery, laid out for a table partitioned by them.

    Rows of a day and session lie together, so a file holds few sessions and a change
    of some sessions rewrites only the days in which they have events.
    """
    dated = events.withColumns(
        {EVENT_DAY: F.to_date("event_ts"), DELIVERY: F.lit(delivery)}
    )
    return dated.repartitionByRange(EVENT_DAY, "session_id").sortWithinPartitions(
        EVENT_DAY, "session_id", "event_ts"
    )


def write_timeline(raw: bronze.Bronze, events_table: str) -> None:
    """Replace the timeline of every session found in the logs or traces.

    The first timeline becomes the table itself, partitioned by day; later ones
    read and rewrite the days that their sessions touch, whatever brought the rows there.
    """
    spark = raw.logs.sparkSession

    def within(rows: DataFrame) -> Column:
        timeline_days.note(rows, events_table)
        return timeline_days.days_of(events_table, rows)

    with tables.Staging(spark, schema_of(events_table)) as staging:
        # Cutting the ranges of days and sessions reads all rows once more, for a sample.
        events = staging.keep(timeline.session_events(raw.traces, raw.logs))
        _write(spark, by_day(events), events_table, _KEY, within)


def merge_events(arrived: DataFrame, events_table: str, delivery: str) -> None:
    """Bring the rows of a delivery into the table, copies and late rows included.

    A delivery has partitions of its own, so nothing that is stored is read or written
    again. One that comes a second time, after a failure, takes the place of its first
    coming: each counts once. `delivery` names it: letters, digits, `_` and `-`.
    """
    spark = arrived.sparkSession

    def within(rows: DataFrame) -> Column:
        timeline_days.note(rows, events_table)
        return F.col(DELIVERY) == delivery

    _write(spark, by_day(arrived, delivery), events_table, [DELIVERY], within)


def _write(spark: SparkSession, events: DataFrame, events_table: str, keys, within) -> None:
    tables.recover(spark, events_table)
    if not tables.exists(spark, events_table):
        tables.publish(events, events_table, partition_by=LAYOUT)
        timeline_days.build(spark, events_table)
    elif DELIVERY in tables.partition_columns(spark, events_table):
        tables.replace(events, events_table, keys, within=within)
    else:
        # A table of another layout has no such partition filter.
        tables.evolve(events, events_table)
        tables.replace(events, events_table, keys)


def gather_deliveries(spark: SparkSession, events_table: str) -> int:
    """Turn the deliveries of every day that has some into base rows; returns the days.

    Streams leave a partition per day and batch; this joins them, in one change per call.
    """
    tables.recover(spark, events_table)
    shown = {
        tuple(pair.partition("=")[2] for pair in row[0].split("/"))
        for row in spark.sql(f"SHOW PARTITIONS {events_table}").collect()
    }
    days = sorted({day for day, delivery in shown if delivery != BASE})
    if not days:
        return 0
    dated = [date.fromisoformat(day) for day in days if not day.startswith("__HIVE")]
    inside = F.col(EVENT_DAY).isin(dated)
    if len(dated) < len(days):
        inside = inside | F.col(EVENT_DAY).isNull()
    events = spark.table(events_table).filter(inside)
    gathered = events.withColumn(DELIVERY, F.lit(BASE))
    tables.exchange_partitions(gathered, events.select(*LAYOUT).distinct(), events_table)
    return len(days)


def revise_segments(
    spark: SparkSession, events_table: str, segments_table: str, sessions: DataFrame, gap_s: int
) -> None:
    """Cut the activity of `sessions` anew from the stored timeline.

    An event may lengthen, join or add segments, however late it comes: all segments of its
    session give way to the new ones. Only days of these sessions are read and changed.
    """
    with tables.Staging(spark, schema_of(segments_table)) as staging:
        touched = staging.keep(sessions.select("session_id").distinct())
        events = worksets.events_of(timeline_days.timeline_of(events_table, touched), touched)
        found = staging.keep(
            segments.idle_segments(events, gap_s).withColumn(
                SEGMENT_DAY, F.to_date("segment_start")
            )
        )
        tables.ensure_table_like(segments_table, found, partition_by=[SEGMENT_DAY])

        def within(_: DataFrame) -> Column:
            return timeline_days.days_of(events_table, touched, SEGMENT_DAY)

        bounded = timeline_days.is_indexed(spark, events_table)
        tables.replace(found, segments_table, _KEY, touched, within if bounded else None)
