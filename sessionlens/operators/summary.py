"""Spans -> one summary row per session.

The counts and sums of all five span classes are conditional aggregates over one scan
and one exchange by session, combined in hash maps on the map side, so a session with
most of the spans costs no more at the reducer than any other. The attributes of the
first interaction come from a second, much smaller aggregation over interactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.arithmetic import count_or_null, count_when, ratio
from sessionlens.functions.attributes import (
    SESSION_KEY,
    attr,
    attr_double,
    attr_long,
    nanos_to_timestamp,
)
from sessionlens.sources.schemas import SESSION_SUMMARY

_FIRST_FIELDS = ("user_id", "service_version", "os_type", "terminal_type")

# Values each span class contributes, NULL on the spans of other classes.
_MEASURES = {
    "prompt_length": (v.SPAN_INTERACTION, lambda: attr_long("user_prompt_length")),
    "input_tokens": (v.SPAN_LLM_REQUEST, lambda: attr_long("input_tokens")),
    "output_tokens": (v.SPAN_LLM_REQUEST, lambda: attr_long("output_tokens")),
    "cache_read": (v.SPAN_LLM_REQUEST, lambda: attr_long("cache_read_tokens")),
    "cache_creation": (v.SPAN_LLM_REQUEST, lambda: attr_long("cache_creation_tokens")),
    "ttft_ms": (v.SPAN_LLM_REQUEST, lambda: attr_double("ttft_ms")),
    "llm_duration_ms": (v.SPAN_LLM_REQUEST, lambda: attr_double("duration_ms")),
}


def _is(span: str) -> Column:
    return F.col("name") == span


def _first_span() -> Column:
    """Descriptive attributes of an interaction, ordered by its start."""
    return F.struct(
        F.coalesce("start_time_unix_nano", F.lit(2**63 - 1)).alias("start"),
        F.col("end_time_unix_nano").alias("end"),
        attr("user.id").alias("user_id"),
        attr("service.version", "resource.attributes").alias("service_version"),
        attr("os.type", "resource.attributes").alias("os_type"),
        attr("terminal.type").alias("terminal_type"),
    )


def _spans(traces: DataFrame, *names: str) -> DataFrame:
    """Narrow rows of the named span classes that belong to a session."""
    interaction = _is(v.SPAN_INTERACTION)
    return (
        traces.filter(F.col("name").isin(*names))
        .select(
            attr(SESSION_KEY).alias("session_id"),
            "name",
            F.when(interaction, nanos_to_timestamp("start_time_unix_nano")).alias("start_ts"),
            F.when(interaction, nanos_to_timestamp("end_time_unix_nano")).alias("end_ts"),
            F.when(interaction, _first_span()).alias("first_span"),
            *[
                F.when(_is(span), value()).alias(measure)
                for measure, (span, value) in _MEASURES.items()
            ],
            attr("tool_name").alias("tool_name"),
            (attr("success") == "true").alias("succeeded"),
            (attr("decision") == "accept").alias("accepted"),
        )
        .filter(F.col("session_id").isNotNull())
    )


def _interaction_aggregates() -> list[Column]:
    return [
        count_when(_is(v.SPAN_INTERACTION)).alias("num_interactions"),
        F.min("start_ts").alias("session_start"),
        F.max("end_ts").alias("session_end"),
        F.avg("prompt_length").alias("avg_prompt_length"),
    ]


def _llm_aggregates() -> list[Column]:
    return [
        count_or_null(_is(v.SPAN_LLM_REQUEST)).alias("num_llm_requests"),
        F.sum("input_tokens").alias("total_input_tokens"),
        F.sum("output_tokens").alias("total_output_tokens"),
        F.sum("cache_read").alias("total_cache_read"),
        F.sum("cache_creation").alias("total_cache_creation"),
        F.avg("ttft_ms").alias("avg_ttft_ms"),
        F.avg("llm_duration_ms").alias("avg_llm_duration_ms"),
    ]


def _tool_aggregates() -> list[Column]:
    return [count_or_null(_is(v.SPAN_TOOL)).alias("num_tool_calls")]


def _execution_aggregates() -> list[Column]:
    execution = _is(v.SPAN_TOOL_EXECUTION)
    return [
        count_or_null(execution).alias("num_tool_executions"),
        count_when(execution & F.col("succeeded")).alias("tool_successes"),
    ]


def _approval_aggregates() -> list[Column]:
    blocked = _is(v.SPAN_TOOL_BLOCKED)
    return [
        count_or_null(blocked).alias("num_blocked_on_user"),
        count_when(blocked & F.col("accepted")).alias("auto_accepted"),
    ]


def _roll_up(traces: DataFrame, span: str, aggregates: list[Column]) -> DataFrame:
    return _spans(traces, span).groupBy("session_id").agg(*aggregates)


def _with_first_attributes(rolled: DataFrame, traces: DataFrame) -> DataFrame:
    """`rolled` with the attributes of each session's earliest interaction.

    The least of structs with texts needs sorted input, so it is taken from the
    interaction spans alone; all other aggregates then combine in hash maps.
    """
    firsts = _roll_up(traces, v.SPAN_INTERACTION, [F.min("first_span").alias("first_span")])
    fields = [F.col("first_span").getField(field).alias(field) for field in _FIRST_FIELDS]
    return rolled.join(firsts.select("session_id", *fields), "session_id", "left")


def interaction_rollup(traces: DataFrame) -> DataFrame:
    """Count, time bounds and descriptive attributes of the interaction spans."""
    rolled = _roll_up(traces, v.SPAN_INTERACTION, _interaction_aggregates())
    return _with_first_attributes(rolled, traces)


def llm_rollup(traces: DataFrame) -> DataFrame:
    return _roll_up(traces, v.SPAN_LLM_REQUEST, _llm_aggregates())


def tool_rollup(traces: DataFrame) -> DataFrame:
    """Tool calls and distinct tools per session."""
    distinct = F.count_distinct("tool_name").alias("distinct_tools")
    return _roll_up(traces, v.SPAN_TOOL, [*_tool_aggregates(), distinct])


def tool_execution_rollup(traces: DataFrame) -> DataFrame:
    return _roll_up(traces, v.SPAN_TOOL_EXECUTION, _execution_aggregates())


def approval_rollup(traces: DataFrame) -> DataFrame:
    return _roll_up(traces, v.SPAN_TOOL_BLOCKED, _approval_aggregates())


def with_session_rates(rolled: DataFrame) -> DataFrame:
    """Duration and ratios derived from the rolled-up counts."""
    read = F.coalesce("total_cache_read", F.lit(0))
    creation = F.coalesce("total_cache_creation", F.lit(0))
    # A NULL token total leaves the divisor at 1, as `greatest` skips NULL.
    tokens = F.greatest(
        F.col("total_input_tokens") + F.col("total_output_tokens") + read + creation, F.lit(1)
    )
    interactions = F.col("num_interactions")
    return rolled.withColumns(
        {
            "session_duration_s": F.unix_timestamp("session_end")
            - F.unix_timestamp("session_start"),
            "cache_hit_rate": read.cast("double") / tokens.cast("double"),
            "tool_success_rate": ratio(F.col("tool_successes"), F.col("num_tool_executions")),
            "auto_accept_rate": ratio(F.col("auto_accepted"), F.col("num_blocked_on_user")),
            "tools_per_interaction": ratio(F.col("num_tool_calls"), interactions),
            "llm_calls_per_interaction": ratio(F.col("num_llm_requests"), interactions),
        }
    )


#: Columns of the summary that the spans do not tell.
_FROM_METRICS = ("total_cost_usd", "total_active_time_s")


def span_summary(traces: DataFrame) -> DataFrame:
    """Summary columns that come from spans; sessions without interaction are left out."""
    spans = _spans(
        traces,
        v.SPAN_INTERACTION,
        v.SPAN_LLM_REQUEST,
        v.SPAN_TOOL,
        v.SPAN_TOOL_EXECUTION,
        v.SPAN_TOOL_BLOCKED,
    )
    rolled = (
        spans.groupBy("session_id")
        .agg(
            *_interaction_aggregates(),
            *_llm_aggregates(),
            *_tool_aggregates(),
            *_execution_aggregates(),
            *_approval_aggregates(),
        )
        .filter(F.col("num_interactions") > 0)
    )
    rated = with_session_rates(_with_first_attributes(rolled, traces))
    return rated.select(*[f for f in SESSION_SUMMARY.fieldNames() if f not in _FROM_METRICS])


def session_summary(traces: DataFrame, metrics_by_session: DataFrame) -> DataFrame:
    """Span summary with cost and active time taken from the session metrics."""
    cost_and_time = metrics_by_session.select(
        "session_id",
        "total_cost_usd",
        (F.col("active_time_cli_s") + F.col("active_time_user_s")).alias("total_active_time_s"),
    )
    return span_summary(traces).join(cost_and_time, "session_id", "left")
