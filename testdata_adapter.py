"""Maps the driver's test tables to bronze-shaped frames (see FIXTURES.md, part 3).

Only the queries in `__spark_entry__.py`, the bench and the tests use this; the
library itself reads bronze tables. One scan per frame, dealt out by the event: each event
row expands into the spans, the log record or the metric points its type stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlens import vocabulary as v
from sessionlens.sources.bronze import Bronze

_EVENT_COLUMNS = (
    "event_id",
    "event_type",
    "user_id",
    "concat('u', user_id, '-w', date_format(date_trunc('week', ts), 'yyyyMMdd')) AS session_id",
    "unix_micros(CAST(ts AS TIMESTAMP)) AS micros",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS iso_ts",
    "CAST(round(value * 100) AS BIGINT) AS cents",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
)
_TOKENS = {
    "input_tokens": "cents div 10",
    "output_tokens": "k * 5",
    "cache_read_tokens": "k * 3",
    "cache_creation_tokens": "k",
}
_DECISION = (
    "CASE WHEN k % 10 = 9 THEN 'modify' WHEN k % 4 = 0 THEN 'reject' ELSE 'accept' END"
)
_SUCCESS = "CASE WHEN k % 10 <> 0 THEN 'true' ELSE 'false' END"
_NO_ATTRIBUTES = "CAST(map() AS MAP<STRING, STRING>)"
_DAY_NANOS = 86_400 * 10**9
_NO_EVENTS = "CAST(array() AS ARRAY<STRUCT<attributes: MAP<STRING, STRING>>>)"


def _scaled(value: str, unit: str) -> str:
    """Exact decimal text of `value` units."""
    return f"CAST({value} AS DECIMAL(18,0)) * {unit}"


def _attributes(**values: str) -> str:
    """Attribute map; `__` stands for the dot in a key, the session is always there."""
    pairs = ["'session.id', session_id"]
    for key, value in values.items():
        pairs.append(f"'{key.replace('__', '.')}', CAST({value} AS STRING)")
    return f"map({', '.join(pairs)})"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event rows, dealt evenly to the tasks.

    A task reads whole row groups, and the file may have very few; a row is narrow here and
    dear in what is made of it.
    """
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.repartition("event_id", "ts", "user_id")


def _expand(spark: SparkSession, sf_dir: str, rows_of: dict[str, list[str]]) -> DataFrame:
    """Rows of the structs listed for the type of each event."""
    cases = " ".join(
        f"WHEN '{kind}' THEN array({', '.join(rows)})" for kind, rows in rows_of.items()
    )
    events = _events(spark, sf_dir).selectExpr(*_EVENT_COLUMNS)
    return events.selectExpr(f"inline(CASE event_type {cases} END)")


def _span(name, attributes, end="micros * 1000", events=_NO_EVENTS, resource=_NO_ATTRIBUTES):
    return (
        f"named_struct('name', '{name}', 'attributes', {attributes}, "
        f"'start_time_unix_nano', micros * 1000, 'end_time_unix_nano', {end}, "
        f"'events', {events}, 'resource', named_struct('attributes', {resource}))"
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    interaction = _span(
        v.SPAN_INTERACTION,
        _attributes(
            user__id="user_id", user_prompt_length="k", terminal__type="concat('t', k % 2)"
        ),
        end="micros * 1000 + (cents div 100) * 1000000000",
        resource="map('service.version', concat('v', k % 3), 'os.type', concat('os', k % 2))",
    )
    request = _span(
        v.SPAN_LLM_REQUEST,
        _attributes(
            **_TOKENS, ttft_ms=_scaled("cents", "0.01"), duration_ms=_scaled("cents", "0.1")
        ),
    )
    blocked = _span(v.SPAN_TOOL_BLOCKED, _attributes(decision=_DECISION))
    output = "map(CASE WHEN k % 3 = 0 THEN 'content' ELSE 'output' END, concat('out', event_id))"
    tool = _span(
        v.SPAN_TOOL,
        _attributes(
            tool_name="concat('tool', k % 5)",
            full_command="CASE WHEN k % 2 = 0 THEN concat('run ', k) END",
            file_path="CASE WHEN k % 5 <> 0 THEN concat('/src/', k) END",
            duration_ms=_scaled("cents", "0.01"),
            tool_use_id="concat('tu', event_id)",
        ),
        events=f"CASE WHEN k % 7 <> 0 THEN array(named_struct('attributes', {output})) "
        f"ELSE {_NO_EVENTS} END",
    )
    execution = _span(v.SPAN_TOOL_EXECUTION, _attributes(success=_SUCCESS))
    return _expand(
        spark,
        sf_dir,
        {
            "signup": [interaction],
            "view": [request],
            "click": [blocked],
            "purchase": [tool, execution],
        },
    )


def _record(body: str, **attributes: str) -> str:
    common = {"event__timestamp": "iso_ts", "prompt__id": "concat('p', event_id div 10)"}
    return f"named_struct('body', {body}, 'attributes', {_attributes(**common, **attributes)})"


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = _record(
        f"'{v.LOG_USER_PROMPT}'",
        command_name="CASE WHEN k % 4 = 0 THEN concat('/cmd', k % 3) END",
        prompt="concat('p', event_id)",
    )
    request = _record(
        f"'{v.LOG_API_REQUEST}'",
        **_TOKENS,
        query_source="CASE WHEN k % 8 <> 0 THEN 'main' END",
        duration_ms=_scaled("cents", "0.1"),
        cost_usd=_scaled("cents", "0.00001"),
        model="concat('m', k % 3)",
    )
    decision = _record(
        f"'{v.LOG_TOOL_DECISION}'",
        tool_name="CASE WHEN k <> 97 THEN concat('tool', k % 5) END",
        decision=_DECISION,
        source="CASE WHEN k % 6 = 0 THEN NULL WHEN k % 2 = 0 THEN 'config' ELSE 'user' END",
        tool_use_id="concat('tu', event_id)",
    )
    result = _record(
        f"'{v.LOG_TOOL_RESULT}'",
        tool_name="concat('tool', k % 5)",
        tool_input_size_bytes="CASE WHEN k % 9 <> 0 THEN k * 2 END",
        tool_result_size_bytes="cents",
        duration_ms=_scaled("cents", "0.01"),
        success=_SUCCESS,
        tool_input="concat('{in ', k, '}')",
        tool_use_id="concat('tu', event_id)",
    )
    error = _record(
        f"CASE WHEN k < 20 THEN '{v.LOG_INTERNAL_ERROR}' ELSE '{v.LOG_API_ERROR}' END",
        error_name="CASE WHEN k % 3 <> 0 THEN concat('E', k) END",
        query_source=f"CASE WHEN k >= 20 AND k < 40 THEN '{v.QUERY_SOURCE_BACKGROUND}' END",
        error=f"CASE WHEN k >= 60 THEN 'boom' WHEN k >= 40 THEN '{v.ERROR_USER_ABORT}' END",
        duration_ms=_scaled("cents", "0.01"),
        model="concat('m', k % 3)",
    )
    return _expand(
        spark,
        sf_dir,
        {
            "signup": [prompt],
            "view": [request],
            "click": [decision],
            "purchase": [result],
            "error": [error],
        },
    )


def _point(name: str, value: str, **attributes: str) -> str:
    return (
        f"named_struct('name', '{name}', 'sum', named_struct("
        f"'value', CAST({value} AS DOUBLE), 'attributes', {_attributes(**attributes)}))"
    )


def _point_rows() -> dict[str, list[str]]:
    model = {
        "model": "concat('m', k % 3)",
        "effort": "CASE WHEN k % 2 = 0 THEN 'high' ELSE 'low' END",
    }
    cost = _point(v.METRIC_COST, "cents / 100000D", **model)
    usage = [
        _point(v.METRIC_TOKENS, amount, type=f"'{kind}'")
        for kind, amount in zip(v.TOKEN_TYPES, _TOKENS.values())
    ]
    active = _point(
        v.METRIC_ACTIVE_TIME,
        "cents / 100D",
        type="CASE WHEN k % 2 = 1 THEN 'cli' ELSE 'user' END",
    )
    return {"view": [cost, *usage], "click": [active]}


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expand(spark, sf_dir, _point_rows())


def _as_running_totals(points: DataFrame) -> DataFrame:
    """The points of every other user as running totals, in counters that start daily."""
    day = f"(time div {_DAY_NANOS}) * {_DAY_NANOS}"
    located = points.selectExpr(
        "name", "sum.value AS value", "sum.attributes AS attributes", "time",
        f"{day} AS start", "user_id % 2 = 0 AS running",
        "to_json(sum.attributes) AS series",
    )
    total = (
        "CASE WHEN running THEN sum(value) OVER "
        "(PARTITION BY name, series, start, running ORDER BY time) ELSE value END"
    )
    return located.selectExpr(
        "name",
        f"named_struct('start_time_unix_nano', start, 'time_unix_nano', time, 'value', {total}, "
        "'attributes', attributes, 'aggregation_temporality', "
        "CASE WHEN running THEN 'AGGREGATION_TEMPORALITY_CUMULATIVE' "
        "ELSE 'AGGREGATION_TEMPORALITY_DELTA' END, 'is_monotonic', true) AS sum",
        f"named_struct('attributes', {_NO_ATTRIBUTES}) AS resource",
    )


def mixed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of `metrics`, half of the users' with cumulative temporality."""
    timed = {
        kind: [row[:-1] + ", 'time', micros * 1000, 'user_id', user_id)" for row in rows]
        for kind, rows in _point_rows().items()
    }
    return _as_running_totals(_expand(spark, sf_dir, timed))


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(traces(spark, sf_dir), logs(spark, sf_dir), metrics(spark, sf_dir))


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline rows of the chat turns; a turn is one second after the previous one."""
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr(
        "CAST(conv_id AS STRING) AS session_id",
        "timestamp_seconds(turn) AS event_ts",
        f"CASE role WHEN 'user' THEN '{v.USER_PROMPT}' WHEN 'assistant' THEN '{v.LLM_CALL}' "
        "ELSE 'SYSTEM' END AS event_type",
        "role AS detail_name",
        "CAST(NULL AS DOUBLE) AS duration_ms",
        "CAST(length(text) AS BIGINT) AS input_tokens",
        "CAST(NULL AS BIGINT) AS output_tokens",
        "CAST(NULL AS DOUBLE) AS cost_usd",
        "text AS content_preview",
        "CAST(NULL AS STRING) AS model",
        "CAST(NULL AS STRING) AS error_category",
    )
