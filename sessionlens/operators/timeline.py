"""Log records and tool spans -> the typed event timeline of each session.

Each source is read once: one projection classifies every log record and fills
the columns its type defines, a second one does the same for tool spans.

Fused with its neighbours, the log projection would become one generated method
of more than 8,000 bytes, which the JVM interprets instead of compiling it (three
times slower here). Bodies that fill a column the same way therefore share one
branch, and concatenations are lambdas: Spark then compiles the projection on its
own and splits it into small methods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens import vocabulary as v
from sessionlens.functions.attributes import (
    SESSION_KEY,
    attr,
    attr_double,
    first_event_attr,
    nanos_to_timestamp,
)
from sessionlens.functions.errors import error_category, error_type
from sessionlens.sources.schemas import SESSION_EVENTS

COLUMNS = SESSION_EVENTS.fieldNames()
ERROR_BODIES = (v.LOG_INTERNAL_ERROR, v.LOG_API_ERROR)
BODIES = (
    v.LOG_USER_PROMPT,
    v.LOG_API_REQUEST,
    v.LOG_TOOL_DECISION,
    v.LOG_TOOL_RESULT,
    *ERROR_BODIES,
)


def _a(key: str) -> str:
    return f"attributes['{key}']"


def _preview(text: str) -> str:
    return f"substring({text}, 1, {v.PREVIEW_CHARS})"


def _concat(*parts: str) -> str:
    """Concatenation of texts and `a[...]` attributes, as a lambda."""
    return f"transform(array(attributes), a -> concat({', '.join(parts)}))[0]"


def _double(key: str) -> str:
    return f"try_cast({_a(key)} AS DOUBLE)"


def _long(key: str) -> str:
    return f"try_cast(try_cast({_a(key)} AS DECIMAL(38,6)) AS BIGINT)"


# What each log body puts into the columns, as SQL; columns it leaves out are NULL.
_PROJECTIONS = {
    v.LOG_USER_PROMPT: {
        "event_type": f"'{v.USER_PROMPT}'",
        "detail_name": f"coalesce({_a('command_name')}, '')",
        "content_preview": _preview(_a("prompt")),
        "full_content": _a("prompt"),
    },
    v.LOG_API_REQUEST: {
        "event_type": f"'{v.LLM_CALL}'",
        "detail_name": _a("query_source"),
        "duration_ms": _double("duration_ms"),
        "input_tokens": _long("input_tokens"),
        "output_tokens": _long("output_tokens"),
        "cost_usd": _double("cost_usd"),
        "content_preview": _concat(
            "a['model']",
            "' | in:'",
            "a['input_tokens']",
            "' out:'",
            "a['output_tokens']",
            "' cache_read:'",
            "a['cache_read_tokens']",
        ),
        "model": _a("model"),
    },
    v.LOG_TOOL_DECISION: {
        "event_type": f"'{v.TOOL_DECISION}'",
        "detail_name": _a("decision"),
        "content_preview": _concat(
            "a['tool_name']",
            "' → '",
            "a['decision']",
            "' (source: '",
            "coalesce(a['source'], 'unknown')",
            "')'",
        ),
        "tool_name": _a("tool_name"),
        "tool_use_id": _a("tool_use_id"),
        "decision_source": _a("source"),
    },
    v.LOG_TOOL_RESULT: {
        "event_type": f"'{v.TOOL_RESULT}'",
        "detail_name": _concat(
            "a['tool_name']",
            "' | in:'",
            "coalesce(a['tool_input_size_bytes'], '0')",
            "'B out:'",
            "coalesce(a['tool_result_size_bytes'], '0')",
            "'B'",
        ),
        "duration_ms": _double("duration_ms"),
        "success": _a("success"),
        "content_preview": _preview(_a("tool_input")),
        "full_content": _a("tool_input"),
        "tool_name": _a("tool_name"),
        "tool_use_id": _a("tool_use_id"),
    },
    **{
        body: {
            "event_type": error_type(),
            "detail_name": f"coalesce({_a('error')}, {_a('error_name')}, 'unknown')",
            "duration_ms": _double("duration_ms"),
            "content_preview": f"coalesce({_a('error')}, "
            f"concat('error_name=', {_a('error_name')}))",
            "model": _a("model"),
        }
        for body in ERROR_BODIES
    },
}


def _by_body(column: str, bodies: tuple[str, ...]) -> str:
    """CASE over the bodies that fill `column`; NULL for the others."""
    branches: dict[str, list[str]] = {}
    for body in bodies:
        if column in _PROJECTIONS[body]:
            branches.setdefault(_PROJECTIONS[body][column], []).append(f"'{body}'")
    if not branches:
        return "NULL"
    cases = " ".join(
        f"WHEN body IN ({', '.join(of)}) THEN {value}" for value, of in branches.items()
    )
    return f"CASE {cases} END"


def log_events(logs: DataFrame, *bodies: str) -> DataFrame:
    """Timeline rows of the log records, of all known bodies unless some are named."""
    bodies = bodies or BODIES
    common = {
        "session_id": _a(SESSION_KEY),
        "event_ts": f"try_to_timestamp({_a('event.timestamp')})",
        "event_source": "'log'",
        "prompt_id": _a("prompt.id"),
    }
    typed = {
        f.name: f"CAST({common.get(f.name) or _by_body(f.name, bodies)} "
        f"AS {f.dataType.simpleString()}) AS {f.name}"
        for f in SESSION_EVENTS
    }
    del typed["error_category"]
    return (
        logs.filter(F.col("body").isin(*bodies) & attr(SESSION_KEY).isNotNull())
        .selectExpr(*typed.values())
        .withColumn("error_category", error_category())
        .select(*COLUMNS)
    )


def prompt_events(logs: DataFrame) -> DataFrame:
    return log_events(logs, v.LOG_USER_PROMPT)


def llm_events(logs: DataFrame) -> DataFrame:
    return log_events(logs, v.LOG_API_REQUEST)


def tool_decision_events(logs: DataFrame) -> DataFrame:
    return log_events(logs, v.LOG_TOOL_DECISION)


def tool_result_events(logs: DataFrame) -> DataFrame:
    return log_events(logs, v.LOG_TOOL_RESULT)


def error_events(logs: DataFrame) -> DataFrame:
    return log_events(logs, *ERROR_BODIES)


def tool_call_events(traces: DataFrame) -> DataFrame:
    """Timeline rows of the tool spans; they carry no prompt id."""
    output = F.coalesce(first_event_attr("output"), first_event_attr("content"))
    columns = {
        "session_id": attr(SESSION_KEY),
        "event_ts": nanos_to_timestamp("start_time_unix_nano"),
        "event_type": F.lit(v.TOOL_CALL),
        "detail_name": F.coalesce(attr("full_command"), attr("file_path"), F.lit("")),
        "duration_ms": attr_double("duration_ms"),
        "content_preview": F.substring(output, 1, v.PREVIEW_CHARS),
        "full_content": output,
        "event_source": F.lit("trace"),
        "tool_name": attr("tool_name"),
        "tool_use_id": attr("tool_use_id"),
    }
    calls = traces.filter((F.col("name") == v.SPAN_TOOL) & attr(SESSION_KEY).isNotNull())
    return calls.select(
        *[
            columns.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in SESSION_EVENTS
        ]
    )


def session_events(traces: DataFrame, logs: DataFrame) -> DataFrame:
    """The whole timeline: one row per event, 18 columns."""
    return log_events(logs).unionByName(tool_call_events(traces))


def distinct_sessions(events: DataFrame) -> DataFrame:
    return events.select("session_id").distinct()
