"""The registered queries: each operator of the library over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import stored_queries as stored
import testdata_adapter as adapter
from sessionlens.functions.attributes import SESSION_KEY, attr, first_event_attr
from sessionlens.operators import (
    changes,
    judge,
    metrics,
    replay,
    rollups,
    scores,
    segments,
    signals,
    summary,
    temporality,
    timeline,
    worksets,
)
from sessionlens.plans.scoring import prompted_sessions

AS_OF = "2024-01-31 00:00:00"
FIRST_RUN = "2024-01-20 00:00:00"
IDLE = "INTERVAL 2 DAYS"
WINDOW_S = 21_600
CUT = "2024-01-17 00:00:00"
GAP_S = 86_400
#: A replay size that most sessions exceed.
SHORT_REPLAY = 400


def _at(text: str):
    return F.lit(text).cast("timestamp")


class Inputs:
    """Frames of one scale directory; nothing is computed before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def traces(self) -> DataFrame:
        return adapter.traces(self.spark, self.sf_dir)

    @cached_property
    def logs(self) -> DataFrame:
        return adapter.logs(self.spark, self.sf_dir)

    @cached_property
    def points(self) -> DataFrame:
        return adapter.metrics(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return timeline.session_events(self.traces, self.logs)

    @cached_property
    def stored_events(self) -> DataFrame:
        """The replay columns of the timeline as a table, for operators that read it often."""
        return stored.kept(self, self.events.select(*replay.COLUMNS))

    @cached_property
    def metrics(self) -> DataFrame:
        return metrics.session_metrics(self.points)

    @cached_property
    def summary(self) -> DataFrame:
        return summary.session_summary(self.traces, self.metrics)

    @cached_property
    def completed(self) -> DataFrame:
        return signals.completed_sessions(self.summary, _at(AS_OF), IDLE)

    @cached_property
    def human_signals(self) -> DataFrame:
        return signals.session_human_signals(
            signals.completed_sessions(summary.span_summary(self.traces), _at(AS_OF), IDLE),
            signals.signal_counts(self.events, WINDOW_S),
            metrics.primary_model(self.points),
            _at(AS_OF),
        )

    @cached_property
    def rule_scores(self) -> DataFrame:
        return scores.rule_scores(self.completed, scores.visible_error_counts(self.events))

    @cached_property
    def prompted(self) -> DataFrame:
        """Prompts of the completed sessions; their events are stored first, as the job does."""
        due = stored.kept(self, self.completed)
        events = worksets.events_of(self.events.select(*replay.COLUMNS), due)
        return prompted_sessions(due, stored.kept(self, events))


def _traces_scan(i: Inputs) -> DataFrame:
    return i.traces.select(
        "name",
        attr(SESSION_KEY).alias("session_id"),
        "start_time_unix_nano",
        "end_time_unix_nano",
        attr("user_prompt_length").alias("user_prompt_length"),
        attr("input_tokens").alias("input_tokens"),
        attr("ttft_ms").alias("ttft_ms"),
        attr("tool_name").alias("tool_name"),
        attr("success").alias("success"),
        attr("decision").alias("decision"),
        attr("service.version", "resource.attributes").alias("service_version"),
        first_event_attr("output").alias("output"),
        first_event_attr("content").alias("content"),
    )


def _logs_scan(i: Inputs) -> DataFrame:
    keys = {
        "session_id": SESSION_KEY,
        "event_timestamp": "event.timestamp",
        "prompt_id": "prompt.id",
        "model": "model",
        "cost_usd": "cost_usd",
        "duration_ms": "duration_ms",
        "tool_name": "tool_name",
        "decision": "decision",
        "error": "error",
    }
    return i.logs.select("body", *[attr(key).alias(name) for name, key in keys.items()])


def _metrics_scan(i: Inputs) -> DataFrame:
    point = "sum.attributes"
    return i.points.select(
        "name",
        attr(SESSION_KEY, point).alias("session_id"),
        F.col("sum.value").alias("value"),
        attr("type", point).alias("type"),
        attr("model", point).alias("model"),
        attr("effort", point).alias("effort"),
    )


def _conversation_replay(i: Inputs) -> DataFrame:
    return replay.session_replay(adapter.conversation_events(i.spark, i.sf_dir), keep=1)


def _scores(i: Inputs) -> DataFrame:
    return judge.session_scores(judge.rule_judge(i.prompted), _at(AS_OF))


# Changes of a table: an earlier run saw the events before CUT, the next one the
# whole sessions of the events since then.
def _by_session(events: DataFrame) -> DataFrame:
    return events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("event_ts").alias("last_ts")
    )


def _by_tool(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("tool_name").isNotNull())
        .groupBy("session_id", "tool_name")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def _old(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_ts") < _at(CUT))


def _new(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_ts") >= _at(CUT))


def _upsert_merge(i: Inputs) -> DataFrame:
    return changes.upsert(_by_session(_old(i.events)), _by_session(_new(i.events)), ["session_id"])


def _upsert_composite(i: Inputs) -> DataFrame:
    keys = ["session_id", "tool_name"]
    return changes.upsert(_by_tool(_old(i.events)), _by_tool(_new(i.events)), keys)


def _delete_keys(i: Inputs) -> DataFrame:
    failed = scores.visible_error_counts(i.events)
    return changes.delete_keys(_by_tool(i.events), failed, ["session_id"])


_EVENT_KEYS = ["session_id", "event_ts", "event_type", "detail_name"]


def _replace_by_session(i: Inputs) -> DataFrame:
    events = i.events.select(*_EVENT_KEYS)
    return changes.replace_by_key(_old(events), _new(events), ["session_id"])


def _replace_tools(i: Inputs) -> DataFrame:
    """Tools of recomputed sessions; a tool without new events loses its row."""
    touched = _new(i.events).select("session_id")
    return changes.replace_by_key(
        _by_tool(_old(i.events)), _by_tool(_new(i.events)), ["session_id"], touched
    )


def _append_evolve(i: Inputs) -> DataFrame:
    events = i.events.select(*_EVENT_KEYS, "error_category", "decision_source")
    return changes.append(_old(events).select(*_EVENT_KEYS), _new(events))


def _earlier_scores(i: Inputs) -> DataFrame:
    first = signals.completed_sessions(summary.span_summary(i.traces), _at(FIRST_RUN), IDLE)
    return first.select(
        "session_id",
        # Of some sessions the last hour had not arrived when they were scored.
        F.when(F.col("num_interactions") % 3 == 0, F.col("session_end") - F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("session_end"))
        .alias("scored_session_end"),
        _at(FIRST_RUN).alias("first_scored_at"),
    )


def _write_once(i: Inputs) -> DataFrame:
    due = worksets.unscored_sessions(i.completed, _earlier_scores(i))
    return due.select("session_id", "session_end", "num_interactions")


def _due_sessions(i: Inputs) -> DataFrame:
    due = worksets.due_sessions(i.completed, _earlier_scores(i), "INTERVAL 7 DAYS")
    return due.select("session_id", "session_end", "num_interactions")


def _judge_parse_mixed(i: Inputs) -> DataFrame:
    """Answers of five kinds: bare, wrapped, malformed, mistyped, without the grade."""
    judged, answer = judge.rule_judge(i.prompted), F.col("ai_response")
    grade = '"overall_score":[0-9]+'
    kinds = (
        answer,
        F.concat(F.lit('{"judgment": '), answer, F.lit("}")),
        F.concat(F.lit("{"), answer),
        F.regexp_replace(answer, grade, '"overall_score":"high"'),
        F.regexp_replace(answer, grade, '"another_score":1'),
    )
    mixed = kinds[0]
    for number, kind in enumerate(kinds[1:], start=1):
        mixed = F.when(F.col("num_interactions") % len(kinds) == number, kind).otherwise(mixed)
    return judge.session_scores(judged.withColumn("ai_response", mixed), _at(AS_OF))


def _events_of_work_set(i: Inputs) -> DataFrame:
    return worksets.events_of(i.events.select(*_EVENT_KEYS), _due_sessions(i))


def _conversation_replay_short(i: Inputs) -> DataFrame:
    turns = adapter.conversation_events(i.spark, i.sf_dir)
    return replay.session_replay(turns, keep=1, budget=SHORT_REPLAY)


def _replay_lines(i: Inputs) -> DataFrame:
    return replay.replay_lines(i.stored_events).select("session_id", "part", "line")


def _interaction_index(i: Inputs) -> DataFrame:
    return replay.with_interaction_index(i.stored_events).select(
        "session_id", "event_ts", "event_type", "detail_name", "duration_ms", "interaction_index"
    )


def _timeline(build: Callable, source: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: build(getattr(i, source))


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "bronze_traces_scan": _traces_scan,
    "bronze_logs_scan": _logs_scan,
    "bronze_metrics_scan": _metrics_scan,
    "interaction_rollup": lambda i: summary.interaction_rollup(i.traces),
    "llm_rollup": lambda i: summary.llm_rollup(i.traces),
    "tool_rollup": lambda i: summary.tool_rollup(i.traces),
    "tool_exec_rollup": lambda i: summary.tool_execution_rollup(i.traces),
    "approval_rollup": lambda i: summary.approval_rollup(i.traces),
    "session_summary": lambda i: i.summary,
    "cost_by_session": lambda i: metrics.cost_by_session(i.points),
    "token_pivot": lambda i: metrics.token_pivot(i.points),
    "active_time_pivot": lambda i: metrics.active_time_pivot(i.points),
    "cost_by_model": lambda i: metrics.cost_by_model(i.points),
    "primary_model": lambda i: metrics.primary_model(i.points),
    "session_metrics": lambda i: i.metrics,
    "metrics_by_temporality": lambda i: metrics.session_metrics(
        temporality.as_deltas(adapter.mixed_metrics(i.spark, i.sf_dir))
    ),
    "timeline_prompts": _timeline(timeline.prompt_events, "logs"),
    "timeline_llm": _timeline(timeline.llm_events, "logs"),
    "timeline_tool_calls": _timeline(timeline.tool_call_events, "traces"),
    "timeline_decisions": _timeline(timeline.tool_decision_events, "logs"),
    "timeline_results": _timeline(timeline.tool_result_events, "logs"),
    "timeline_errors": _timeline(timeline.error_events, "logs"),
    "session_events": lambda i: i.events,
    "distinct_sessions": lambda i: timeline.distinct_sessions(i.events),
    "completed_sessions": lambda i: i.completed,
    "decision_counts": lambda i: signals.decision_counts(i.events),
    "abort_counts": lambda i: signals.abort_counts(i.events),
    "correction_counts": lambda i: signals.correction_counts(i.events, WINDOW_S),
    "session_human_signals": lambda i: i.human_signals,
    "signals_by_tool": lambda i: signals.signals_by_tool(
        i.events, i.completed, metrics.primary_model(i.points), _at(AS_OF)
    ),
    "visible_error_counts": lambda i: scores.visible_error_counts(i.events),
    "rule_scores": lambda i: i.rule_scores,
    "interaction_index": _interaction_index,
    "interaction_compressed": lambda i: replay.compressed_interactions(i.stored_events),
    "replay_lines": _replay_lines,
    "session_replay": lambda i: replay.session_replay(i.stored_events),
    "session_replay_short": lambda i: replay.session_replay(i.stored_events, budget=SHORT_REPLAY),
    "conversation_replay_short": _conversation_replay_short,
    "conversation_replay": _conversation_replay,
    "judge_prompt": lambda i: i.prompted.select("session_id", "full_prompt"),
    "judge_parse": _scores,
    "judge_parse_mixed": _judge_parse_mixed,
    "events_of_work_set": _events_of_work_set,
    "upsert_merge": _upsert_merge,
    "upsert_composite": _upsert_composite,
    "delete_keys": _delete_keys,
    "replace_by_session": _replace_by_session,
    "replace_tools": _replace_tools,
    "append_evolve": _append_evolve,
    "write_once_scores": _write_once,
    "due_sessions": _due_sessions,
    "stored_silver_summary": stored.silver_summary,
    "stored_silver_metrics": stored.silver_metrics,
    "stored_scores": lambda i: stored.stored_scores(i, _at(AS_OF), IDLE),
    "stored_upsert": lambda i: stored.upserted(
        i, _by_session(_old(i.events)), _by_session(_new(i.events)), ["session_id"]
    ),
    "stored_replace_by_session": lambda i: stored.replaced_timeline(
        i, _old(i.events), _new(i.events)
    ).select(*_EVENT_KEYS),
    "stored_replace_tools": lambda i: stored.replaced(
        i, _by_tool(_old(i.events)), _by_tool(_new(i.events)), _new(i.events).select("session_id")
    ),
    "stored_append_evolve": lambda i: stored.appended(
        i,
        _old(i.events).select(*_EVENT_KEYS),
        _new(i.events).select(*_EVENT_KEYS, "error_category", "decision_source"),
    ),
    "stored_deliveries": stored.delivered_timeline,
    "stored_work_set": lambda i: stored.work_set_events(i, _due_sessions(i)).select(*_EVENT_KEYS),
    "streamed_timeline": stored.streamed_timeline,
    "idle_segments": lambda i: segments.idle_segments(i.events, GAP_S),
    "gold_rollup": lambda i: rollups.signal_rollup(i.human_signals),
    "daily_scores": lambda i: rollups.daily_scores(i.rule_scores),
}


def _comparable(frame: DataFrame) -> DataFrame:
    """Results in a form another engine can match.

    Sums of doubles depend on the order of the rows, so doubles are rounded to
    nine decimals; timestamps lose their zone, which is UTC in all queries.
    """
    columns = []
    for field in frame.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 9)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: _comparable(build(Inputs(spark, sf_dir)))

    return {name: bind(build) for name, build in _QUERIES.items()}
