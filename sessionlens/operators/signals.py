"""Friction signals of a session: rejected tools, aborts, quick corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.arithmetic import capped, count_when, floored, ratio
from sessionlens.operators.ordering import BUCKET_S, NO_TIME, located, whole_second
from sessionlens.sources.schemas import SESSION_HUMAN_SIGNALS, SESSION_HUMAN_SIGNALS_BY_TOOL

_COUNTS = (
    "num_tool_decisions",
    "num_tool_rejects",
    "num_tool_accepts",
    "num_user_aborts",
    "num_corrections",
)


def as_column(moment) -> Column:
    """`moment` as a timestamp column; the current time when it is None."""
    if moment is None:
        return F.current_timestamp()
    return moment if isinstance(moment, Column) else F.lit(moment)


def completed_sessions(
    summary: DataFrame, as_of=None, idle: str = v.IDLE_COMPLETION
) -> DataFrame:
    """Sessions whose last interaction ended longer than `idle` before `as_of`."""
    return summary.filter(F.col("session_end") < as_column(as_of) - F.expr(idle))


def _is_decision(*outcomes: str) -> Column:
    return (F.col("event_type") == v.TOOL_DECISION) & F.col("detail_name").isin(*outcomes)


def _decision_counts() -> list[Column]:
    return [
        count_when(_is_decision("accept", "reject")).alias("num_tool_decisions"),
        count_when(_is_decision("reject")).alias("num_tool_rejects"),
        count_when(_is_decision("accept")).alias("num_tool_accepts"),
    ]


def _abort_count() -> Column:
    return count_when(F.col("event_type") == v.USER_ABORTED).alias("num_user_aborts")


def decision_counts(events: DataFrame) -> DataFrame:
    """Accepted and rejected tools per session; other decisions do not count."""
    return (
        events.filter(_is_decision("accept", "reject"))
        .groupBy("session_id")
        .agg(*_decision_counts())
    )


def abort_counts(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("event_type") == v.USER_ABORTED)
        .groupBy("session_id")
        .agg(_abort_count())
    )


def signal_counts(
    events: DataFrame,
    window_s: int = v.CORRECTION_WINDOW_S,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """All five counts per session in one pass over the timeline.

    A correction is a prompt whose previous event in (time, type) order is a tool
    result at most `window_s` whole seconds older. Events of one type at one
    instant are combined before the shuffle: of these only the first prompt can
    follow a result, so the count does not depend on how ties are broken. What
    remains of a bucket is bounded by the number of microseconds in it.
    """
    same_instant = (
        located(events.select("session_id", "event_ts", "event_type", "detail_name"), bucket_s)
        .groupBy("session_id", "b", "t", "event_type")
        .agg(*_decision_counts(), _abort_count())
    )
    ordered = Window.partitionBy("session_id", "b").orderBy("t", "event_type")
    prompt = (F.col("event_type") == v.USER_PROMPT) & (F.col("t") > NO_TIME)
    neighbours = same_instant.withColumns(
        {
            "second": whole_second("t"),
            "previous_type": F.lag("event_type").over(ordered),
            "previous_t": F.lag("t").over(ordered),
            "next_t": F.lead("t").over(ordered),
        }
    ).withColumn("previous_second", whole_second("previous_t"))
    inside = (
        prompt
        & (F.col("previous_type") == v.TOOL_RESULT)
        & (F.col("second") - F.col("previous_second") <= window_s)
    )
    opening_prompt = prompt & F.col("previous_t").isNull()
    closing_result = (F.col("event_type") == v.TOOL_RESULT) & F.col("next_t").isNull()
    buckets = neighbours.groupBy("session_id", "b").agg(
        *[F.sum(name).alias(name) for name in _COUNTS[:-1]],
        count_when(inside).alias("inside"),
        F.max(F.when(opening_prompt, F.col("second"))).alias("opening_prompt_s"),
        F.max(F.when(closing_result, F.col("second"))).alias("closing_result_s"),
    )
    previous_result = F.lag("closing_result_s").over(
        Window.partitionBy("session_id").orderBy("b")
    )
    across = F.col("opening_prompt_s") - previous_result <= window_s
    return (
        buckets.withColumn("across", F.coalesce(across, F.lit(False)).cast("long"))
        .groupBy("session_id")
        .agg(
            *[F.sum(name).alias(name) for name in _COUNTS[:-1]],
            F.sum(F.col("inside") + F.col("across")).alias("num_corrections"),
        )
    )


def correction_counts(
    events: DataFrame,
    window_s: int = v.CORRECTION_WINDOW_S,
    bucket_s: int = BUCKET_S,
) -> DataFrame:
    """Sessions with corrections, and how many."""
    return (
        signal_counts(events, window_s, bucket_s)
        .select("session_id", "num_corrections")
        .filter(F.col("num_corrections") > 0)
    )


def friction_score(
    reject_rate: Column,
    abort_rate: Column,
    correction_intensity: Column,
    signal_strength: Column,
    weights: dict[str, float] | None = None,
) -> Column:
    """Weighted rates on a scale of 0 to 100; NULL, never 0, without any signal."""
    rates = {"reject": reject_rate, "abort": abort_rate, "correction": correction_intensity}
    raw = F.lit(0.0)
    for name, weight in (weights or v.FRICTION_WEIGHTS).items():
        raw += F.lit(weight) * F.coalesce(rates[name], F.lit(0.0))
    return F.when(signal_strength, capped(floored(F.lit(100.0) * raw), 100.0))


def session_human_signals(
    sessions: DataFrame,
    counts: DataFrame,
    metrics_by_session: DataFrame,
    as_of=None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """One row of signals, rates and friction score per session of `sessions`.

    All inputs hold one row per session, so no join here can be skewed.
    """
    interactions = F.col("num_interactions")
    counted = (
        sessions.select("session_id", "user_id", "session_start", "num_interactions")
        .join(counts, "session_id", "left")
        .join(metrics_by_session.select("session_id", "primary_model"), "session_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in _COUNTS})
    )
    rated = counted.withColumns(
        {
            "reject_rate": ratio(F.col("num_tool_rejects"), F.col("num_tool_decisions")),
            "abort_rate": ratio(F.col("num_user_aborts"), interactions),
            "correction_intensity": ratio(F.col("num_corrections"), interactions),
            "signal_strength": (F.col("num_tool_decisions") >= 1)
            | (F.col("num_user_aborts") >= 1)
            | (F.col("num_corrections") >= 1),
        }
    )
    score = friction_score(
        F.col("reject_rate"),
        F.col("abort_rate"),
        F.col("correction_intensity"),
        F.col("signal_strength"),
        weights,
    )
    made = rated.withColumns({"human_friction_score": score, "computed_at": as_column(as_of)})
    return made.select(*SESSION_HUMAN_SIGNALS.fieldNames())


def signals_by_tool(
    events: DataFrame, sessions: DataFrame, metrics_by_session: DataFrame, as_of=None
) -> DataFrame:
    """Decisions per (session, tool) for the sessions of `sessions`.

    The events are combined to one row per pair before they meet the sessions.
    """
    by_tool = (
        events.filter(_is_decision("accept", "reject") & F.col("tool_name").isNotNull())
        .groupBy("session_id", "tool_name")
        .agg(*_decision_counts())
    )
    return (
        by_tool.join(sessions.select("session_id", "user_id"), "session_id")
        .join(metrics_by_session.select("session_id", "primary_model"), "session_id", "left")
        .withColumns(
            {
                "reject_rate": ratio(F.col("num_tool_rejects"), F.col("num_tool_decisions")),
                "computed_at": as_column(as_of),
            }
        )
        .select(*SESSION_HUMAN_SIGNALS_BY_TOOL.fieldNames())
    )
