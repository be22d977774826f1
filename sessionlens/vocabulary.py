"""Names and settings shared by every stage.

Everything in this file is a fixed value: the telemetry emitter, the stored
tables and earlier scores define it, so none of it may be changed freely.
"""

# Span names in the traces table.
SPAN_INTERACTION = "claude_code.interaction"
SPAN_LLM_REQUEST = "claude_code.llm_request"
SPAN_TOOL = "claude_code.tool"
SPAN_TOOL_EXECUTION = "claude_code.tool.execution"
SPAN_TOOL_BLOCKED = "claude_code.tool.blocked_on_user"

# Bodies in the logs table.
LOG_USER_PROMPT = "claude_code.user_prompt"
LOG_API_REQUEST = "claude_code.api_request"
LOG_TOOL_DECISION = "claude_code.tool_decision"
LOG_TOOL_RESULT = "claude_code.tool_result"
LOG_INTERNAL_ERROR = "claude_code.internal_error"
LOG_API_ERROR = "claude_code.api_error"

# Metric names, and the `type` attribute of their points.
METRIC_COST = "claude_code.cost.usage"
METRIC_TOKENS = "claude_code.token.usage"
METRIC_ACTIVE_TIME = "claude_code.active_time.total"
TOKEN_TYPES = {
    "input": "input_tokens",
    "output": "output_tokens",
    "cacheRead": "cache_read_tokens",
    "cacheCreation": "cache_creation_tokens",
}
ACTIVE_TIME_TYPES = {"cli": "active_time_cli_s", "user": "active_time_user_s"}

# Attribute texts that classify an API error.
QUERY_SOURCE_BACKGROUND = "away_summary"
ERROR_USER_ABORT = "Request was aborted."

# Event types and error categories of the timeline.
USER_PROMPT = "USER_PROMPT"
LLM_CALL = "LLM_CALL"
TOOL_CALL = "TOOL_CALL"
TOOL_DECISION = "TOOL_DECISION"
TOOL_RESULT = "TOOL_RESULT"
INTERNAL_ERROR = "INTERNAL_ERROR"
BACKGROUND_ABORTED = "BACKGROUND_ABORTED"
USER_ABORTED = "USER_ABORTED"
ERROR = "ERROR"
INVISIBLE = "invisible"
USER_VISIBLE = "user_visible"

# Bronze, silver and gold table names inside their schemas.
BRONZE_TRACES = "claude_otel_traces"
BRONZE_LOGS = "claude_otel_logs"
BRONZE_METRICS = "claude_otel_metrics"
SILVER_SUMMARY = "session_summary"
SILVER_EVENTS = "session_events"
SILVER_METRICS = "session_metrics"
GOLD_SCORES = "session_scores"
GOLD_SIGNALS = "session_human_signals"
GOLD_SIGNALS_BY_TOOL = "session_human_signals_by_tool"

# Default settings of the scoring jobs.
IDLE_COMPLETION = "INTERVAL 2 HOURS"
CORRECTION_WINDOW_S = 30
REPLAY_CHAR_BUDGET = 30_000
KEEP_INTERACTIONS = 2
PREVIEW_CHARS = 500
REPLAY_PREVIEW_CHARS = 200
FRICTION_WEIGHTS = {"reject": 0.4, "abort": 0.3, "correction": 0.3}
COMPOSITE_WEIGHTS = {
    "efficiency_score": 0.20,
    "productivity_score": 0.25,
    "quality_score": 0.20,
    "autonomy_score": 0.15,
    "engagement_score": 0.20,
}
