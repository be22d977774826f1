import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import NOW, at, event, events, frame, session, summaries
from sessionlens import vocabulary as v
from sessionlens.operators import signals
from sessionlens.sources import schemas


def _decision(outcome, tool="Bash", ts=0.0, **fields):
    return event(v.TOOL_DECISION, ts, detail_name=outcome, tool_name=tool, **fields)


def _corrections(spark, rows, window_s=30, bucket_s=60):
    counts = signals.correction_counts(events(spark, rows), window_s, bucket_s).collect()
    return {row.session_id: row.num_corrections for row in counts}


def test_correction_window_is_inclusive(spark):
    rows = []
    for start, gap in ((100, 25), (200, 30), (300, 35)):
        rows += [event(v.TOOL_RESULT, start), event(v.USER_PROMPT, start + gap)]
    assert _corrections(spark, rows) == {"s1": 2}


def test_gap_is_measured_in_whole_seconds(spark):
    rows = [
        event(v.TOOL_RESULT, 0.05, "short"),
        event(v.USER_PROMPT, 30.95, "short"),
        event(v.TOOL_RESULT, 0.95, "long"),
        event(v.USER_PROMPT, 31.05, "long"),
    ]
    assert _corrections(spark, rows) == {"short": 1}


def test_ties_are_ordered_by_type(spark):
    assert _corrections(spark, [event(v.USER_PROMPT, 50), event(v.TOOL_RESULT, 50)]) == {"s1": 1}
    between = [event(v.USER_PROMPT, 50), event(v.USER_ABORTED, 50), event(v.TOOL_RESULT, 50)]
    assert _corrections(spark, between) == {}


def test_only_the_first_of_simultaneous_prompts_corrects(spark):
    rows = [event(v.TOOL_RESULT, 49)] + [event(v.USER_PROMPT, 50)] * 3
    assert _corrections(spark, rows) == {"s1": 1}


def test_events_without_time_never_correct(spark):
    rows = [
        event(v.TOOL_RESULT, None),
        event(v.USER_PROMPT, None),
        event(v.USER_PROMPT, 0),
    ]
    assert _corrections(spark, rows) == {}


def _model(rows, window_s):
    """Previous event in (time, type) order, over all events of a session."""
    counts = Counter()
    by_session = {}
    for row in rows:
        by_session.setdefault(row["session_id"], []).append(row)
    for name, own in by_session.items():
        own.sort(key=lambda r: (r["event_ts"], r["event_type"]))
        for before, here in zip(own, own[1:]):
            gap = here["event_ts"].replace(microsecond=0) - before["event_ts"].replace(microsecond=0)
            if (
                here["event_type"] == v.USER_PROMPT
                and before["event_type"] == v.TOOL_RESULT
                and gap <= timedelta(seconds=window_s)
            ):
                counts[name] += 1
    return dict(counts)


@pytest.mark.parametrize("bucket_s", [1, 7, 60, 100_000])
def test_buckets_do_not_change_the_corrections(spark, bucket_s):
    generator = random.Random(3)
    kinds = [v.TOOL_RESULT, v.USER_PROMPT, v.LLM_CALL, v.USER_ABORTED]
    rows = [
        event(generator.choice(kinds), generator.randint(0, 400) / 2, f"s{generator.randint(0, 3)}")
        for _ in range(400)
    ]
    assert _corrections(spark, rows, 5, bucket_s) == _model(rows, 5)


def test_signal_counts_in_one_pass(spark):
    rows = [
        _decision("accept"),
        _decision("reject", ts=1),
        _decision("modify", ts=2),
        event(v.USER_ABORTED, 3),
        event(v.TOOL_RESULT, 59),
        event(v.USER_PROMPT, 61),
    ]
    row = signals.signal_counts(events(spark, rows)).first()
    assert (row.num_tool_decisions, row.num_tool_rejects, row.num_tool_accepts) == (2, 1, 1)
    assert (row.num_user_aborts, row.num_corrections) == (1, 1)
    single = signals.decision_counts(events(spark, rows)).first()
    assert (single.num_tool_decisions, single.num_tool_rejects) == (2, 1)
    assert signals.abort_counts(events(spark, rows)).first().num_user_aborts == 1


def test_completed_sessions_are_strictly_older_than_the_idle_time(spark):
    rows = [session("old", 3), session("edge", 2), session("new", 1), session("open", 3)]
    rows[3]["session_end"] = None
    done = signals.completed_sessions(summaries(spark, rows), NOW)
    assert [row.session_id for row in done.collect()] == ["old"]
    longer = signals.completed_sessions(summaries(spark, rows), F.lit(NOW), "INTERVAL 30 MINUTES")
    assert longer.count() == 3


@pytest.mark.parametrize(
    "reject, abort, correction, signal, expected",
    [
        (0.5, None, None, True, 20.0),
        (None, 0.5, None, True, 15.0),
        (0.5, 0.0, 0.2, True, 26.0),
        (1.0, 5.0, 5.0, True, 100.0),
        (0.0, 0.0, 0.0, True, 0.0),
        (0.5, 0.5, 0.5, False, None),
    ],
)
def test_friction_score(spark, reject, abort, correction, signal, expected):
    row = spark.createDataFrame(
        [(reject, abort, correction, signal)], "r double, a double, c double, s boolean"
    )
    columns = [F.col(name) for name in "racs"]
    score = row.select(signals.friction_score(*columns).alias("score")).first().score
    assert score == (None if expected is None else pytest.approx(expected))


def test_weights_add_up():
    assert sum(v.FRICTION_WEIGHTS.values()) == pytest.approx(1.0)
    assert sum(v.COMPOSITE_WEIGHTS.values()) == pytest.approx(1.0)


def test_session_rows_and_quiet_sessions(spark):
    sessions = summaries(spark, [session("busy", num_interactions=4), session("quiet")])
    rows = [
        _decision("accept", session="busy"),
        _decision("reject", ts=1, session="busy"),
        event(v.USER_ABORTED, 2, "busy"),
        event(v.LLM_CALL, 3, "quiet"),
    ]
    models = frame(
        spark, schemas.SESSION_METRICS, [{"session_id": "busy", "primary_model": "m"}]
    )
    counts = signals.signal_counts(events(spark, rows))
    found = {
        row.session_id: row
        for row in signals.session_human_signals(sessions, counts, models, NOW).collect()
    }
    busy, quiet = found["busy"], found["quiet"]
    assert (busy.reject_rate, busy.abort_rate, busy.primary_model) == (0.5, 0.25, "m")
    assert busy.human_friction_score == pytest.approx(100 * (0.4 * 0.5 + 0.3 * 0.25))
    assert (quiet.num_tool_decisions, quiet.num_corrections) == (0, 0)
    assert (quiet.signal_strength, quiet.human_friction_score) == (False, None)
    assert quiet.reject_rate is None


def test_one_row_per_session_and_tool(spark):
    sessions = summaries(spark, [session()])
    rows = [
        _decision("accept"),
        _decision("reject", ts=1),
        _decision("modify", ts=2),
        _decision("accept", "Edit", ts=3),
        _decision("accept", None, ts=4),
        _decision("accept", session="elsewhere"),
    ]
    models = frame(spark, schemas.SESSION_METRICS, [])
    found = signals.signals_by_tool(events(spark, rows), sessions, models, NOW).collect()
    assert {r.tool_name: (r.num_tool_decisions, r.reject_rate) for r in found} == {
        "Bash": (2, 0.5),
        "Edit": (1, 0.0),
    }
    assert len(found) == 2
