"""Physical plans: scans, pushed filters, exchanges, no Python, no nested loops."""

import re

import pytest

from sessionlens import vocabulary as v
from sessionlens.operators import judge, metrics, replay, segments, signals, summary, timeline
from sessionlens.plans.scoring import prompted_sessions
from sessionlens.sources import bronze as readers
from sessionlens.sources import schemas


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    for table, schema in (
        (v.BRONZE_TRACES, schemas.TRACES),
        (v.BRONZE_LOGS, schemas.LOGS),
        (v.BRONZE_METRICS, schemas.METRICS),
        (v.SILVER_EVENTS, schemas.SESSION_EVENTS),
        (v.SILVER_SUMMARY, schemas.SESSION_SUMMARY),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{table}")
    return folder


def _stored(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}")


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _count(plan, node):
    return len(re.findall(rf"[-+:] ?(?:\*\(\d+\) )?{node}\b", plan))


def test_session_metrics_scan_once_and_read_only_the_sum(spark, raw):
    plan = _plan(metrics.session_metrics(readers.from_files(spark, raw).metrics))
    assert (_count(plan, "FileScan"), _count(plan, "Exchange")) == (1, 2)
    assert "In(name, [" in re.search(r"PushedFilters: (.*)ReadSchema", plan).group(1)
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert schema == "struct<name:string,sum:struct<value:double,attributes:map<string,string>>>"


def test_span_summary_sorts_interactions_only(spark, raw):
    plan = _plan(summary.span_summary(readers.from_files(spark, raw).traces))
    assert (_count(plan, "FileScan"), _count(plan, "Exchange")) == (2, 2)
    for schema in re.findall(r"ReadSchema: (.*)", plan):
        assert "events" not in schema and "links" not in schema
    # Only the branch that reads interactions alone aggregates sorted rows.
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert sorted("In(name" in filters for filters in pushed) == [False, True]
    assert _count(plan, "SortAggregate") == 2 and _count(plan, "HashAggregate") == 2


def test_timeline_scans_each_source_once_without_shuffle(spark, raw):
    files = readers.from_files(spark, raw)
    plan = _plan(timeline.session_events(files.traces, files.logs))
    assert (_count(plan, "FileScan"), _count(plan, "Exchange")) == (2, 0)
    assert "In(body, [" in plan and f"EqualTo(name,{v.SPAN_TOOL})" in plan


def test_signals_read_four_columns_and_combine_before_the_shuffle(spark, raw):
    plan = _plan(signals.signal_counts(_stored(spark, raw, v.SILVER_EVENTS)))
    assert _count(plan, "FileScan") == 1
    assert (
        "ReadSchema: struct<session_id:string,event_ts:timestamp,event_type:string,"
        "detail_name:string>" in plan
    )
    first = re.search(r"Exchange hashpartitioning\((.*?)\)[^\n]*\n[^\n]*partial_count", plan)
    assert all(key in first.group(1) for key in ("session_id", "b#", "t#", "event_type"))


def test_segments_order_buckets_not_events(spark, raw):
    plan = _plan(segments.idle_segments(_stored(spark, raw, v.SILVER_EVENTS)))
    assert "ReadSchema: struct<session_id:string,event_ts:timestamp>" in plan
    window = plan.index("Window")
    assert "partial_min(t#" in plan[window:]


def test_replay_holds_sessions_back_before_their_shuffle(spark, raw):
    plan = _plan(replay.session_replay(_stored(spark, raw, v.SILVER_EVENTS)))
    assert "full_content" not in plan
    # One limit before the exchange by session, one after it.
    limits = re.findall(r"WindowGroupLimit \[session_id#\d+\], .*?, (Partial|Final)", plan)
    assert sorted(limits) == ["Final", "Partial"]


def test_no_python_and_no_nested_loops_in_any_core_plan(spark, raw):
    events = _stored(spark, raw, v.SILVER_EVENTS)
    sessions = _stored(spark, raw, v.SILVER_SUMMARY)
    frames = [
        judge.session_scores(judge.rule_judge(prompted_sessions(sessions, events))),
        prompted_sessions(sessions, events),
        replay.with_interaction_index(events),
        signals.signals_by_tool(events, sessions, sessions.selectExpr("session_id", "'m' AS primary_model")),
    ]
    for frame in frames:
        plan = _plan(frame)
        for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Coalesce 1"):
            assert node not in plan
