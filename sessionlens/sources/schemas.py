"""Explicit schemas of the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOLEAN, TIMESTAMP = T.DoubleType(), T.BooleanType(), T.TimestampType()
ATTRIBUTES = T.MapType(STRING, STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# ---- bronze: the OpenTelemetry v1 layout the collector writes -----------------

_RESOURCE = _struct(attributes=ATTRIBUTES, dropped_attributes_count=INT)
_SCOPE = _struct(name=STRING, version=STRING, attributes=ATTRIBUTES, dropped_attributes_count=INT)
_POINT_TIMES = {"start_time_unix_nano": LONG, "time_unix_nano": LONG}
_EXEMPLARS = T.ArrayType(
    _struct(
        time_unix_nano=LONG,
        value=DOUBLE,
        span_id=STRING,
        trace_id=STRING,
        filtered_attributes=ATTRIBUTES,
    )
)
_BUCKETS = _struct(offset=INT, bucket_counts=T.ArrayType(LONG))
_NUMBER_POINT = {
    **_POINT_TIMES,
    "value": DOUBLE,
    "exemplars": _EXEMPLARS,
    "attributes": ATTRIBUTES,
    "flags": INT,
}

METRICS = _struct(
    name=STRING,
    description=STRING,
    unit=STRING,
    metric_type=STRING,
    gauge=_struct(**_NUMBER_POINT),
    sum=_struct(**_NUMBER_POINT, aggregation_temporality=STRING, is_monotonic=BOOLEAN),
    histogram=_struct(
        **_POINT_TIMES,
        count=LONG,
        sum=DOUBLE,
        bucket_counts=T.ArrayType(LONG),
        explicit_bounds=T.ArrayType(DOUBLE),
        exemplars=_EXEMPLARS,
        attributes=ATTRIBUTES,
        flags=INT,
        min=DOUBLE,
        max=DOUBLE,
        aggregation_temporality=STRING,
    ),
    exponential_histogram=_struct(
        attributes=ATTRIBUTES,
        **_POINT_TIMES,
        count=LONG,
        sum=DOUBLE,
        scale=INT,
        zero_count=LONG,
        positive_bucket=_BUCKETS,
        negative_bucket=_BUCKETS,
        flags=INT,
        exemplars=_EXEMPLARS,
        min=DOUBLE,
        max=DOUBLE,
        zero_threshold=DOUBLE,
        aggregation_temporality=STRING,
    ),
    summary=_struct(
        **_POINT_TIMES,
        count=LONG,
        sum=DOUBLE,
        quantile_values=T.ArrayType(_struct(quantile=DOUBLE, value=DOUBLE)),
        attributes=ATTRIBUTES,
        flags=INT,
    ),
    metadata=ATTRIBUTES,
    resource=_RESOURCE,
    resource_schema_url=STRING,
    instrumentation_scope=_SCOPE,
    metric_schema_url=STRING,
)

LOGS = _struct(
    event_name=STRING,
    trace_id=STRING,
    span_id=STRING,
    time_unix_nano=LONG,
    observed_time_unix_nano=LONG,
    severity_number=STRING,
    severity_text=STRING,
    body=STRING,
    attributes=ATTRIBUTES,
    dropped_attributes_count=INT,
    flags=INT,
    resource=_RESOURCE,
    resource_schema_url=STRING,
    instrumentation_scope=_SCOPE,
    log_schema_url=STRING,
)

TRACES = _struct(
    trace_id=STRING,
    span_id=STRING,
    parent_span_id=STRING,
    trace_state=STRING,
    name=STRING,
    kind=STRING,
    start_time_unix_nano=LONG,
    end_time_unix_nano=LONG,
    attributes=ATTRIBUTES,
    dropped_attributes_count=INT,
    events=T.ArrayType(
        _struct(
            time_unix_nano=LONG, name=STRING, attributes=ATTRIBUTES, dropped_attributes_count=INT
        )
    ),
    dropped_events_count=INT,
    links=T.ArrayType(
        _struct(
            trace_id=STRING,
            span_id=STRING,
            trace_state=STRING,
            attributes=ATTRIBUTES,
            dropped_attributes_count=INT,
            flags=INT,
        )
    ),
    dropped_links_count=INT,
    status=_struct(message=STRING, code=STRING),
    flags=INT,
    resource=_RESOURCE,
    resource_schema_url=STRING,
    instrumentation_scope=_SCOPE,
    scope_schema_url=STRING,
    span_schema_url=STRING,
)

# ---- silver -------------------------------------------------------------------

SESSION_METRICS = _struct(
    session_id=STRING,
    total_cost_usd=DOUBLE,
    input_tokens=DOUBLE,
    output_tokens=DOUBLE,
    cache_read_tokens=DOUBLE,
    cache_creation_tokens=DOUBLE,
    active_time_cli_s=DOUBLE,
    active_time_user_s=DOUBLE,
    primary_model=STRING,
    effort_level=STRING,
)

SESSION_SUMMARY = _struct(
    session_id=STRING,
    user_id=STRING,
    session_start=TIMESTAMP,
    session_end=TIMESTAMP,
    session_duration_s=LONG,
    num_interactions=LONG,
    num_llm_requests=LONG,
    num_tool_calls=LONG,
    total_input_tokens=LONG,
    total_output_tokens=LONG,
    total_cache_read=LONG,
    total_cache_creation=LONG,
    cache_hit_rate=DOUBLE,
    avg_ttft_ms=DOUBLE,
    avg_llm_duration_ms=DOUBLE,
    tool_success_rate=DOUBLE,
    auto_accept_rate=DOUBLE,
    tools_per_interaction=DOUBLE,
    llm_calls_per_interaction=DOUBLE,
    avg_prompt_length=DOUBLE,
    service_version=STRING,
    os_type=STRING,
    terminal_type=STRING,
    total_cost_usd=DOUBLE,
    total_active_time_s=DOUBLE,
)

SESSION_EVENTS = _struct(
    session_id=STRING,
    event_ts=TIMESTAMP,
    event_type=STRING,
    detail_name=STRING,
    duration_ms=DOUBLE,
    input_tokens=LONG,
    output_tokens=LONG,
    cost_usd=DOUBLE,
    success=STRING,
    content_preview=STRING,
    full_content=STRING,
    event_source=STRING,
    model=STRING,
    tool_name=STRING,
    error_category=STRING,
    prompt_id=STRING,
    tool_use_id=STRING,
    decision_source=STRING,
)

# ---- gold ---------------------------------------------------------------------

JUDGMENT = _struct(
    task_clarity=INT,
    agent_effectiveness=INT,
    tool_strategy=INT,
    error_handling=INT,
    cost_efficiency=INT,
    overall_score=INT,
    summary=STRING,
    recommendations=STRING,
)

SESSION_SCORES = _struct(
    session_id=STRING,
    user_id=STRING,
    session_start=TIMESTAMP,
    num_interactions=LONG,
    total_cost_usd=DOUBLE,
    efficiency_score=DOUBLE,
    productivity_score=DOUBLE,
    quality_score=DOUBLE,
    autonomy_score=DOUBLE,
    engagement_score=DOUBLE,
    composite_score=DOUBLE,
    **{f"llm_{field.name}": field.dataType for field in JUDGMENT},
    scored_at=TIMESTAMP,
    scored_session_end=TIMESTAMP,
    first_scored_at=TIMESTAMP,
)

SESSION_HUMAN_SIGNALS = _struct(
    session_id=STRING,
    user_id=STRING,
    primary_model=STRING,
    session_start=TIMESTAMP,
    num_interactions=LONG,
    num_tool_decisions=LONG,
    num_tool_rejects=LONG,
    num_tool_accepts=LONG,
    num_user_aborts=LONG,
    num_corrections=LONG,
    reject_rate=DOUBLE,
    abort_rate=DOUBLE,
    correction_intensity=DOUBLE,
    human_friction_score=DOUBLE,
    signal_strength=BOOLEAN,
    computed_at=TIMESTAMP,
)

SESSION_HUMAN_SIGNALS_BY_TOOL = _struct(
    session_id=STRING,
    user_id=STRING,
    primary_model=STRING,
    tool_name=STRING,
    num_tool_decisions=LONG,
    num_tool_rejects=LONG,
    num_tool_accepts=LONG,
    reject_rate=DOUBLE,
    computed_at=TIMESTAMP,
)
