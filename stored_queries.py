"""Registered queries that change stored tables and return what these hold afterwards.

Each call works in a schema of its own, in the warehouse of the session. What the frame forms
of `query_catalogue` compute is here done by the jobs and the sinks, on tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import testdata_adapter as adapter
from sessionlens import vocabulary as v
from sessionlens.operators import judge, worksets
from sessionlens.plans import silver, timeline_days
from sessionlens.plans.scoring import score_sessions
from sessionlens.sinks import tables
from sessionlens.sources import bronze
from sessionlens.streaming import timeline as streaming


def _schema(i) -> str:
    name = f"sessionlens_{uuid.uuid4().hex[:12]}"
    tables.ensure_schema(i.spark, name)
    return name


def kept(i, frame: DataFrame, *partition_by: str) -> DataFrame:
    """`frame` computed once, as a table."""
    name = f"{_schema(i)}.kept"
    frame.write.partitionBy(*partition_by).saveAsTable(name)
    return i.spark.table(name)


def stored_bronze(i) -> str:
    """The bronze tables in a schema, with metric points of both temporalities."""
    schema = _schema(i)
    frames = {
        v.BRONZE_TRACES: i.traces,
        v.BRONZE_LOGS: i.logs,
        v.BRONZE_METRICS: adapter.mixed_metrics(i.spark, i.sf_dir),
    }
    for table, frame in frames.items():
        frame.write.saveAsTable(f"{schema}.{table}")
    return schema


def silver_summary(i) -> DataFrame:
    """Two runs of the silver job over the same tables; the second one changes nothing."""
    raw, schema = stored_bronze(i), _schema(i)
    for _ in range(2):
        silver.silver_etl(i.spark, raw, schema)
    return i.spark.table(f"{schema}.{v.SILVER_SUMMARY}")


def silver_metrics(i) -> DataFrame:
    raw, schema = stored_bronze(i), _schema(i)
    silver.silver_etl(i.spark, raw, schema)
    return i.spark.table(f"{schema}.{v.SILVER_METRICS}")


def stored_scores(i, as_of: Column, idle: str) -> DataFrame:
    """Two runs of the scoring job with kept answers; the second one finds nothing to score."""
    schema = _schema(i)
    i.summary.write.saveAsTable(f"{schema}.{v.SILVER_SUMMARY}")
    raw = bronze.Bronze(i.traces, i.logs, i.points)
    silver.write_timeline(raw, f"{schema}.{v.SILVER_EVENTS}")
    for _ in range(2):
        score_sessions(
            i.spark, schema, schema, judge.rule_judge, as_of=as_of, idle=idle, answers="answers"
        )
    return i.spark.table(f"{schema}.{v.GOLD_SCORES}")


def upserted(i, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    name = f"{_schema(i)}.t"
    tables.ensure_table_like(name, old)
    tables.append(old, name)
    with tables.Staging(i.spark, name.partition(".")[0]) as staging:
        tables.upsert(staging.keep(new), name, keys)
    return i.spark.table(name)


def replaced(i, old: DataFrame, new: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    name = f"{_schema(i)}.t"
    tables.publish(old, name)
    tables.replace(new, name, ["session_id"], touched)
    return i.spark.table(name)


def appended(i, old: DataFrame, new: DataFrame) -> DataFrame:
    name = f"{_schema(i)}.t"
    tables.publish(old, name)
    tables.append(new, name)
    return i.spark.table(name)


def replaced_timeline(i, old: DataFrame, new: DataFrame) -> DataFrame:
    """Whole sessions replaced in a timeline that is partitioned by day."""
    name = f"{_schema(i)}.{v.SILVER_EVENTS}"
    tables.publish(silver.by_day(old), name, partition_by=silver.LAYOUT)
    timeline_days.build(i.spark, name)

    def within(rows: DataFrame) -> Column:
        timeline_days.note(rows, name)
        return timeline_days.days_of(name, rows)

    tables.replace(silver.by_day(new), name, ["session_id"], within=within)
    return i.spark.table(name).drop(*silver.LAYOUT)


def delivered_timeline(i) -> DataFrame:
    """The timeline in three deliveries, the last one twice, then gathered by day."""
    name = f"{_schema(i)}.{v.SILVER_EVENTS}"
    number = F.pmod(F.xxhash64("session_id", "event_ts", "event_type"), F.lit(3))
    # As deliveries come: computed once, each apart from the others.
    arrived = kept(i, i.events.withColumn("_number", number), "_number")
    for delivery in (0, 1, 2, 2):
        events = arrived.filter(F.col("_number") == delivery).drop("_number")
        silver.merge_events(events, name, f"d-{delivery}")
    silver.gather_deliveries(i.spark, name)
    return i.spark.table(name).drop(*silver.LAYOUT)


def streamed_timeline(i) -> DataFrame:
    """Bronze files read as a stream in two goes, the second one with new files."""
    schema = _schema(i)
    folder = i.spark.sql(f"DESCRIBE SCHEMA {schema}").filter("info_name = 'Location'").first()[1]
    name, files = f"{schema}.{v.SILVER_EVENTS}", f"{folder}/_arrived"
    raw = bronze.Bronze(i.traces, i.logs, i.points)
    for part in (0, 1):
        for table, frame in ((v.BRONZE_TRACES, raw.traces), (v.BRONZE_LOGS, raw.logs)):
            session = F.pmod(F.xxhash64(F.element_at("attributes", "session.id")), F.lit(2))
            frame.filter(session == part).write.mode("append").parquet(f"{files}/{table}")
        i.points.limit(0).write.mode("append").parquet(f"{files}/{v.BRONZE_METRICS}")
        events = streaming.stream_events(streaming.stream_bronze(i.spark, files))
        query = streaming.write_timeline(events, name, f"{folder}/_checkpoint", available_now=True)
        query.awaitTermination()
        i.spark.catalog.refreshTable(name)
    return i.spark.table(name).drop(*silver.LAYOUT)


def work_set_events(i, sessions: DataFrame) -> DataFrame:
    """Events of a work set, read from the days that the index names."""
    name = f"{_schema(i)}.{v.SILVER_EVENTS}"
    silver.write_timeline(bronze.Bronze(i.traces, i.logs, i.points), name)
    with tables.Staging(i.spark, name.partition(".")[0]) as staging:
        due = staging.keep(sessions)
        events = worksets.events_of(timeline_days.timeline_of(name, due), due)
        tables.publish(events, f"{name}_due")
    return i.spark.table(f"{name}_due")
