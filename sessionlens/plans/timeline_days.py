"""Which days of the timeline hold a session: a small table beside it.

Every writer of the timeline adds a row (session, first day, last day, undated, noted at) per
session and change before it changes the timeline, so the rows of a session cover its days at any
time; they may cover more. A work set is looked up there, and the days found are a partition
filter on the timeline, known when the scan is planned. The newest row of a session tells when
it last changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.sinks import tables

#: Partition columns of the timeline: day of the event, and what brought the row.
EVENT_DAY, DELIVERY = "event_day", "delivery"
#: Rows that the batch job writes, or that have been gathered from deliveries.
BASE = "base"
#: More days than this become one range of days.
LISTED_DAYS = 1000


def index_name(events_table: str) -> str:
    return f"{events_table}__days"


def _ranges(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min(EVENT_DAY).alias("first_day"),
            F.max(EVENT_DAY).alias("last_day"),
            F.max(F.col(EVENT_DAY).isNull()).alias("undated"),
            F.max(F.current_timestamp()).alias("noted_at"),
        )
    )


def is_indexed(spark: SparkSession, events_table: str) -> bool:
    return tables.exists(spark, index_name(events_table))


def build(spark: SparkSession, events_table: str) -> None:
    """The index of a timeline that has none; also gathers its rows to one per session."""
    tables.publish(_ranges(spark.table(events_table)), index_name(events_table))


def note(events: DataFrame, events_table: str) -> None:
    """Tell the index of rows that are about to come into the timeline."""
    spark = events.sparkSession
    if not is_indexed(spark, events_table):
        build(spark, events_table)
    tables.append(_ranges(events), index_name(events_table))


def changed_since(events_table: str, sessions: DataFrame, computed: DataFrame) -> DataFrame:
    """Those of `sessions` that are not in `computed` (session_id, computed_at), or whose
    timeline has changed since."""
    spark = sessions.sparkSession
    last = spark.table(index_name(events_table)).groupBy("session_id").agg(
        F.max("noted_at").alias("_noted_at")
    )
    computed = computed.groupBy("session_id").agg(F.max("computed_at").alias("_computed_at"))
    rows = sessions.join(computed, "session_id", "left").join(last, "session_id", "left")
    new = F.col("_computed_at").isNull() | (F.col("_noted_at") >= F.col("_computed_at"))
    return rows.filter(new).drop("_computed_at", "_noted_at")


def days_of(events_table: str, sessions: DataFrame, day: str = EVENT_DAY) -> Column:
    """A condition on the day column that holds for all rows of `sessions`."""
    spark = sessions.sparkSession
    known = spark.table(index_name(events_table)).join(
        sessions.select("session_id").distinct(), "session_id", "left_semi"
    )
    bounds = known.agg(
        F.min("first_day").alias("low"), F.max("last_day").alias("high"),
        F.max("undated").alias("undated"),
    ).first()
    day = F.col(day)
    found = F.lit(False)
    if bounds["low"] is not None:
        if (bounds["high"] - bounds["low"]).days < LISTED_DAYS:
            # At most LISTED_DAYS rows.
            days = known.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
            found = day.isin([row["day"] for row in days.distinct().orderBy("day").collect()])
        else:
            found = day.between(F.lit(bounds["low"]), F.lit(bounds["high"]))
    return found | day.isNull() if bounds["undated"] else found


def timeline_of(events_table: str, sessions: DataFrame) -> DataFrame:
    """The timeline, restricted to days on which one of `sessions` has events.

    A timeline without days or without an index is returned as it is.
    """
    spark = sessions.sparkSession
    events = spark.table(events_table)
    if EVENT_DAY in events.columns and is_indexed(spark, events_table):
        events = events.filter(days_of(events_table, sessions))
    return events
