"""Which sessions a run has to work on, and the events that belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def unscored_sessions(completed: DataFrame, scored: DataFrame) -> DataFrame:
    """Completed sessions without a score: a score is written once and stays."""
    return completed.join(scored.select("session_id"), "session_id", "left_anti")


def due_sessions(completed: DataFrame, scored: DataFrame, grace: str) -> DataFrame:
    """Unscored sessions, and those that went on after what was scored of them.

    A session may be scored again while its end lies within `grace` after its first
    score, and only if it ends later than the `scored_session_end` of its last score;
    so an event that arrives late counts even if it happened before the score.
    Returned with `first_scored_at`, NULL for a session without a score.
    """
    times = scored.groupBy("session_id").agg(
        F.min("first_scored_at").alias("first_scored_at"),
        F.max("scored_session_end").alias("scored_session_end"),
    )
    resumed = (F.col("session_end") > F.col("scored_session_end")) & (
        F.col("session_end") <= F.col("first_scored_at") + F.expr(grace)
    )
    return (
        completed.join(times, "session_id", "left")
        .filter(F.col("first_scored_at").isNull() | resumed)
        .drop("scored_session_end")
    )


def events_of(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events whose session is in `sessions`.

    Spark chooses how to join from the sizes it measures, and splits the partition of a
    session with very many events, as the other side has one row per session.
    """
    return events.join(sessions.select("session_id").distinct(), "session_id", "left_semi")
