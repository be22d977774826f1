from conftest import at, log, logs, span, traces
from sessionlens import vocabulary as v
from sessionlens.operators import timeline

ALL_LOGS = [
    log(v.LOG_USER_PROMPT, prompt__id="p-user", prompt="hi", command_name="/do"),
    log(
        v.LOG_API_REQUEST,
        prompt__id="p-llm",
        model="m",
        input_tokens="10",
        output_tokens="5",
        cache_read_tokens="0",
        cost_usd="0.25",
        duration_ms="12.5",
    ),
    log(
        v.LOG_TOOL_DECISION,
        prompt__id="p-dec",
        tool_name="Bash",
        tool_use_id="tu-dec",
        decision="accept",
        source="config",
    ),
    log(v.LOG_TOOL_RESULT, prompt__id="p-res", tool_name="Bash", tool_use_id="tu-res"),
    log(v.LOG_API_ERROR, prompt__id="p-err", error="boom"),
]
TOOL = span(
    v.SPAN_TOOL, tool_name="Bash", tool_use_id="tu-call", events=[{"output": "done"}, {"output": "2"}]
)


def _by_type(spark, trace_rows, log_rows):
    frame = timeline.session_events(traces(spark, trace_rows), logs(spark, log_rows))
    assert frame.columns == timeline.COLUMNS
    return {row.event_type: row for row in frame.collect()}


def test_every_source_gives_its_event_type(spark):
    rows = _by_type(spark, [TOOL], ALL_LOGS)
    assert {kind: row.prompt_id for kind, row in rows.items()} == {
        "USER_PROMPT": "p-user",
        "LLM_CALL": "p-llm",
        "TOOL_CALL": None,
        "TOOL_DECISION": "p-dec",
        "TOOL_RESULT": "p-res",
        "ERROR": "p-err",
    }
    assert {kind: row.tool_use_id for kind, row in rows.items() if row.tool_use_id} == {
        "TOOL_CALL": "tu-call",
        "TOOL_DECISION": "tu-dec",
        "TOOL_RESULT": "tu-res",
    }
    assert {k: r.decision_source for k, r in rows.items() if r.decision_source} == {
        "TOOL_DECISION": "config"
    }
    assert {k: r.event_source for k, r in rows.items() if r.event_source != "log"} == {
        "TOOL_CALL": "trace"
    }


def test_columns_of_each_event_type(spark):
    rows = _by_type(spark, [TOOL], ALL_LOGS)
    call = rows["LLM_CALL"]
    assert (call.input_tokens, call.output_tokens, call.cost_usd) == (10, 5, 0.25)
    assert (call.duration_ms, call.event_ts) == (12.5, at(0))
    assert call.content_preview == "m | in:10 out:5 cache_read:0"
    assert rows["USER_PROMPT"].detail_name == "/do"
    assert rows["TOOL_DECISION"].content_preview == "Bash → accept (source: config)"
    assert rows["TOOL_RESULT"].detail_name == "Bash | in:0B out:0B"
    assert rows["TOOL_CALL"].content_preview == "done"
    assert rows["ERROR"].content_preview == "boom"


def test_missing_attributes(spark):
    rows = _by_type(
        spark,
        [span(v.SPAN_TOOL)],
        [
            log(v.LOG_USER_PROMPT),
            log(v.LOG_API_REQUEST, model="m", input_tokens="1"),
            log(v.LOG_TOOL_DECISION, decision="accept"),
            log(v.LOG_TOOL_RESULT),
            log(v.LOG_API_ERROR, error_name="E"),
        ],
    )
    assert rows["USER_PROMPT"].detail_name == ""
    # A missing part leaves the whole text NULL.
    assert rows["LLM_CALL"].content_preview is None
    assert rows["TOOL_DECISION"].content_preview is None
    assert rows["TOOL_RESULT"].detail_name is None
    assert (rows["TOOL_CALL"].detail_name, rows["TOOL_CALL"].content_preview) == ("", None)
    assert (rows["ERROR"].detail_name, rows["ERROR"].content_preview) == ("E", "error_name=E")


def test_error_classes(spark):
    cases = {
        "INTERNAL_ERROR": log(v.LOG_INTERNAL_ERROR, error="Request was aborted."),
        "BACKGROUND_ABORTED": log(
            v.LOG_API_ERROR, query_source="away_summary", error="Request was aborted."
        ),
        "USER_ABORTED": log(v.LOG_API_ERROR, error="Request was aborted."),
        "ERROR": log(v.LOG_API_ERROR),
    }
    rows = _by_type(spark, [], list(cases.values()))
    assert {kind: row.error_category for kind, row in rows.items()} == {
        "INTERNAL_ERROR": "invisible",
        "BACKGROUND_ABORTED": "invisible",
        "USER_ABORTED": "invisible",
        "ERROR": "user_visible",
    }
    assert rows["ERROR"].detail_name == "unknown"


def test_malformed_values_become_null(spark):
    request = log(
        v.LOG_API_REQUEST, input_tokens="many", output_tokens="12.7", cost_usd="", duration_ms="x"
    )
    request["attributes"]["event.timestamp"] = "yesterday"
    row = _by_type(spark, [], [request])["LLM_CALL"]
    assert (row.event_ts, row.input_tokens, row.cost_usd, row.duration_ms) == (None,) * 4
    assert row.output_tokens == 12


def test_previews_are_cut_and_texts_are_whole(spark):
    rows = _by_type(
        spark,
        [span(v.SPAN_TOOL, events=[{"content": "c" * 900}])],
        [log(v.LOG_USER_PROMPT, prompt="p" * 900), log(v.LOG_TOOL_RESULT, tool_input="i" * 900)],
    )
    for kind in ("TOOL_CALL", "USER_PROMPT", "TOOL_RESULT"):
        assert len(rows[kind].content_preview) == 500
        assert len(rows[kind].full_content) == 900


def test_events_without_session_and_unknown_bodies_are_left_out(spark):
    frame = timeline.session_events(
        traces(spark, [span(v.SPAN_TOOL, session=None), span(v.SPAN_INTERACTION)]),
        logs(spark, [log(v.LOG_USER_PROMPT, session=None), log("other.body")]),
    )
    assert frame.count() == 0


def test_single_branches_agree_with_the_whole(spark):
    log_frame, trace_frame = logs(spark, ALL_LOGS), traces(spark, [TOOL])
    branches = [
        timeline.prompt_events(log_frame),
        timeline.llm_events(log_frame),
        timeline.tool_decision_events(log_frame),
        timeline.tool_result_events(log_frame),
        timeline.error_events(log_frame),
        timeline.tool_call_events(trace_frame),
    ]
    separate = sorted(str(row) for branch in branches for row in branch.collect())
    whole = timeline.session_events(trace_frame, log_frame)
    assert separate == sorted(str(row) for row in whole.collect())
    assert timeline.distinct_sessions(whole).count() == 1
