import pytest

from conftest import at, metrics, point, span, traces
from sessionlens import vocabulary as v
from sessionlens.operators import metrics as points
from sessionlens.operators import summary


def _one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_session_metrics_of_all_three_metrics(spark):
    frame = metrics(
        spark,
        [
            point(v.METRIC_COST, 0.3, model="a", effort="low"),
            point(v.METRIC_COST, 0.2, model="b", effort="high"),
            point(v.METRIC_COST, 0.2, model="b", effort="high"),
            point(v.METRIC_TOKENS, 10.0, type="input", model="a"),
            point(v.METRIC_TOKENS, 7.0, type="output", model="b"),
            point(v.METRIC_TOKENS, 5.0, type="cacheRead"),
            point(v.METRIC_TOKENS, 9.0, type="unheard"),
            point(v.METRIC_ACTIVE_TIME, 4.0, type="cli"),
            point("other.metric", 99.0),
            point(v.METRIC_COST, 5.0, session=None),
        ],
    )
    row = _one(points.session_metrics(frame))
    assert row.total_cost_usd == pytest.approx(0.7)
    assert (row.primary_model, row.effort_level) == ("b", "high")
    assert (row.input_tokens, row.output_tokens) == (10.0, 7.0)
    # Types without points count 0, as the session has other points of the metric.
    assert (row.cache_read_tokens, row.cache_creation_tokens) == (5.0, 0.0)
    assert (row.active_time_cli_s, row.active_time_user_s) == (4.0, 0.0)


def test_session_with_one_metric_only(spark):
    row = _one(points.session_metrics(metrics(spark, [point(v.METRIC_TOKENS, 1.0, type="input")])))
    assert row.input_tokens == 1.0
    assert (row.total_cost_usd, row.primary_model, row.active_time_cli_s) == (None, None, None)


def test_primary_model_ties_and_missing_costs(spark):
    frame = metrics(
        spark,
        [
            point(v.METRIC_COST, 1.0, "tie", model="b", effort="x"),
            point(v.METRIC_COST, 1.0, "tie", model="a", effort="y"),
            point(v.METRIC_COST, None, "null", model="a", effort="x"),
            point(v.METRIC_COST, 0.0, "null", model="z", effort="x"),
            point(v.METRIC_COST, 2.0, "bare"),
        ],
    )
    found = {r.session_id: (r.primary_model, r.effort_level) for r in points.primary_model(frame).collect()}
    assert found == {"tie": ("a", "y"), "null": ("z", "x"), "bare": (None, None)}
    whole = points.session_metrics(frame).collect()
    assert {r.session_id: (r.primary_model, r.effort_level) for r in whole} == found


def _session_spans():
    resource = {"service.version": "1.2", "os.type": "linux"}
    return [
        span(v.SPAN_INTERACTION, start=50, end=60, user_prompt_length="20", user__id="late"),
        span(
            v.SPAN_INTERACTION,
            start=10,
            end=20.9,
            user_prompt_length="11",
            user__id="ann",
            terminal__type="tty",
            resource=resource,
        ),
        span(v.SPAN_LLM_REQUEST, start=1, end=90, input_tokens="100", output_tokens="20", ttft_ms="5"),
        span(v.SPAN_LLM_REQUEST, cache_read_tokens="60", cache_creation_tokens="20", ttft_ms="bad"),
        span(v.SPAN_TOOL, tool_name="Bash"),
        span(v.SPAN_TOOL, tool_name="Bash"),
        span(v.SPAN_TOOL, tool_name="Edit"),
        span(v.SPAN_TOOL_EXECUTION, success="true"),
        span(v.SPAN_TOOL_EXECUTION, success="TRUE"),
        span(v.SPAN_TOOL_BLOCKED, decision="accept"),
        span("unknown.span"),
    ]


def test_span_summary(spark):
    row = _one(summary.span_summary(traces(spark, _session_spans())))
    assert (row.user_id, row.service_version, row.os_type, row.terminal_type) == (
        "ann",
        "1.2",
        "linux",
        "tty",
    )
    # Only interactions set the bounds of a session.
    assert (row.session_start, row.session_end, row.session_duration_s) == (at(10), at(60), 50)
    assert (row.num_interactions, row.num_llm_requests, row.num_tool_calls) == (2, 2, 3)
    assert row.avg_prompt_length == 15.5
    assert row.cache_hit_rate == pytest.approx(60 / 200)
    assert (row.avg_ttft_ms, row.tool_success_rate, row.auto_accept_rate) == (5.0, 0.5, 1.0)
    assert (row.tools_per_interaction, row.llm_calls_per_interaction) == (1.5, 1.0)


def test_absent_span_classes_give_null_not_zero(spark):
    frame = traces(spark, [span(v.SPAN_INTERACTION), span(v.SPAN_TOOL, session="no-interaction")])
    row = _one(summary.span_summary(frame))
    assert (row.num_llm_requests, row.num_tool_calls, row.total_input_tokens) == (None,) * 3
    assert (row.tool_success_rate, row.auto_accept_rate, row.tools_per_interaction) == (None,) * 3
    assert row.cache_hit_rate == 0.0


def test_cache_hit_rate_with_unknown_tokens(spark):
    frame = traces(
        spark, [span(v.SPAN_INTERACTION), span(v.SPAN_LLM_REQUEST, cache_read_tokens="7")]
    )
    assert _one(summary.span_summary(frame)).cache_hit_rate == 7.0


def test_single_rollups_agree_with_the_summary(spark):
    frame = traces(spark, _session_spans())
    whole = _one(summary.span_summary(frame)).asDict()
    for rollup in (summary.interaction_rollup, summary.llm_rollup, summary.tool_rollup):
        for name, value in _one(rollup(frame)).asDict().items():
            if name in whole:
                assert value == whole[name], name
    assert _one(summary.tool_rollup(frame)).distinct_tools == 2
    executed = _one(summary.tool_execution_rollup(frame))
    assert (executed.num_tool_executions, executed.tool_successes) == (2, 1)
    approved = _one(summary.approval_rollup(frame))
    assert (approved.num_blocked_on_user, approved.auto_accepted) == (1, 1)


def test_summary_takes_cost_and_active_time_from_the_metrics(spark):
    spans = traces(spark, [span(v.SPAN_INTERACTION, "s1"), span(v.SPAN_INTERACTION, "s2")])
    by_session = points.session_metrics(
        metrics(
            spark,
            [
                point(v.METRIC_ACTIVE_TIME, 10.0, type="cli"),
                point(v.METRIC_ACTIVE_TIME, 25.0, type="user"),
                point(v.METRIC_COST, 0.42),
            ],
        )
    )
    frame = summary.session_summary(spans, by_session)
    assert "active_time_cli_s" not in frame.columns
    found = {r.session_id: (r.total_active_time_s, r.total_cost_usd) for r in frame.collect()}
    assert found == {"s1": (35.0, 0.42), "s2": (None, None)}
