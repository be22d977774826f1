"""Silver -> gold: friction signals per session and per tool, recomputed each run."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from sessionlens import vocabulary as v
from sessionlens.operators import signals, worksets
from sessionlens.plans import timeline_days
from sessionlens.sinks import tables
from sessionlens.sources import schemas

logger = logging.getLogger(__name__)


def score_human_signals(
    spark: SparkSession,
    silver_schema: str,
    gold_schema: str,
    as_of=None,
    idle: str = v.IDLE_COMPLETION,
    window_s: int = v.CORRECTION_WINDOW_S,
    only_changed: bool = False,
) -> int:
    """Recompute the signals of all completed sessions; returns their number.

    The timeline is combined to one row per session, or per session and tool,
    before it meets the completed sessions. With `only_changed`, sessions whose timeline has not
    changed since their signals were computed keep them, and only days of the others are
    read; this needs the day index that the writers of the timeline keep.
    """
    summary = spark.table(f"{silver_schema}.{v.SILVER_SUMMARY}")
    sessions = signals.completed_sessions(summary, as_of, idle)
    if sessions.isEmpty():
        logger.info("no completed sessions")
        return 0
    events_table = f"{silver_schema}.{v.SILVER_EVENTS}"
    events = spark.table(events_table)
    metrics = spark.table(f"{silver_schema}.{v.SILVER_METRICS}")

    tables.ensure_schema(spark, gold_schema)
    session_table = f"{gold_schema}.{v.GOLD_SIGNALS}"
    tool_table = f"{gold_schema}.{v.GOLD_SIGNALS_BY_TOOL}"
    tables.ensure_table(spark, session_table, schemas.SESSION_HUMAN_SIGNALS)
    tables.ensure_table(spark, tool_table, schemas.SESSION_HUMAN_SIGNALS_BY_TOOL)
    with tables.Staging(spark, gold_schema) as staging:
        if only_changed:
            computed = spark.table(session_table)
            sessions = staging.keep(
                timeline_days.changed_since(events_table, sessions, computed)
            )
            if sessions.isEmpty():
                logger.info("no changed sessions")
                return 0
            events = worksets.events_of(
                timeline_days.timeline_of(events_table, sessions), sessions
            )
        counts = signals.signal_counts(events, window_s)
        by_session = staging.keep(
            signals.session_human_signals(sessions, counts, metrics, as_of)
        )
        by_tool = staging.keep(signals.signals_by_tool(events, by_session, metrics, as_of))
        tables.upsert(by_session, session_table, ["session_id"])
        # A tool that a session no longer uses must lose its row, so all rows of the
        # recomputed sessions are exchanged, not only those that came back.
        changed = by_session.select("session_id")
        tables.replace(by_tool, tool_table, ["session_id"], touched=changed)
        count = by_session.count()
    logger.info("wrote signals of %d sessions", count)
    return count
