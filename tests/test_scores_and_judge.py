import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import NOW, event, events, session, summaries
from sessionlens import vocabulary as v
from sessionlens.operators import judge, scores
from sessionlens.plans.scoring import prompted_sessions
from sessionlens.sources import schemas


def _scores(spark, errors=0, **fields):
    rows = [event(v.ERROR, i, error_category=v.USER_VISIBLE) for i in range(errors)]
    rows += [event(v.USER_ABORTED, 99, error_category=v.INVISIBLE)]
    counted = scores.visible_error_counts(events(spark, rows))
    return scores.rule_scores(summaries(spark, [session(**fields)]), counted).first()


def test_scores_of_an_empty_session(spark):
    row = _scores(spark, num_interactions=1)
    # Nothing spent keeps the full cost share, nothing executed the full success share.
    assert (row.efficiency_score, row.quality_score) == (40.0, 100.0)
    assert (row.productivity_score, row.autonomy_score, row.engagement_score) == (10.0, 0.0, 0.0)
    assert row.visible_error_count == 0
    assert row.composite_score == pytest.approx(0.2 * 40 + 0.25 * 10 + 0.2 * 100)


@pytest.mark.parametrize(
    "column, expected, fields",
    [
        ("efficiency_score", 100.0, {"cache_hit_rate": 1.0, "total_cost_usd": 0.0}),
        ("efficiency_score", 30.0, {"cache_hit_rate": 0.5, "total_cost_usd": 0.1}),
        ("efficiency_score", 30.0, {"cache_hit_rate": 0.5, "total_cost_usd": 9.0}),
        ("efficiency_score", 50.0, {"cache_hit_rate": 0.5, "total_cost_usd": 0.05}),
        ("efficiency_score", 100.0, {"cache_hit_rate": 7.0}),
        ("productivity_score", 60.0, {"num_tool_calls": 2, "num_interactions": 1}),
        ("productivity_score", 60.0, {"num_tool_calls": 9, "num_interactions": 1}),
        ("productivity_score", 62.5, {"num_tool_calls": 4, "num_interactions": 8}),
        ("quality_score", 65.0, {"tool_success_rate": 0.5}),
        ("autonomy_score", 75.0, {"auto_accept_rate": 0.75}),
        ("engagement_score", 100.0, {"session_duration_s": 61, "avg_prompt_length": 50.5}),
        ("engagement_score", 37.0, {"session_duration_s": 30, "avg_prompt_length": 12.0}),
    ],
)
def test_saturation_of_each_score(spark, column, expected, fields):
    assert _scores(spark, **fields)[column] == pytest.approx(expected)


@pytest.mark.parametrize("errors, expected", [(1, 85.0), (2, 70.0), (3, 70.0)])
def test_only_visible_errors_cost_quality(spark, errors, expected):
    row = _scores(spark, errors)
    assert (row.visible_error_count, row.quality_score) == (errors, expected)


def test_unknown_interactions_saturate_as_least_skips_null(spark):
    assert _scores(spark, num_interactions=None).productivity_score == 50.0


def _prompted(spark, sessions, rows, **options):
    return prompted_sessions(summaries(spark, sessions), events(spark, rows), **options)


def test_prompt_text(spark):
    known = session(
        num_interactions=3,
        total_cost_usd=0.12345,
        cache_hit_rate=0.98765,
        tool_success_rate=0.5,
        auto_accept_rate=None,
    )
    rows = [event(v.USER_PROMPT, 0, content_preview="fix it"), event(v.LLM_CALL, 1, "other")]
    found = {r.session_id: r for r in _prompted(spark, [known, session("mute")], rows).collect()}
    lines = found["s1"].full_prompt.split("\n")
    assert lines[0] == "You are evaluating an AI agent session. Score each dimension 0-100."
    assert lines[2].startswith("IMPORTANT: INTERNAL_ERROR, BACKGROUND_ABORTED, and USER_ABORTED")
    assert lines[4:6] == ["Session replay:", found["s1"].replay_text]
    assert lines[7:10] == [
        "Session metrics:",
        f"- interactions: 3, cost: ${0.12345:.4f}, cache_hit_rate: {0.98765:.2%}",
        "- tool_success_rate: 0.50, auto_accept_rate: 0.00",
    ]
    assert [line.split(" ")[1] for line in lines[12:20]] == [
        "task_clarity",
        "agent_effectiveness",
        "tool_strategy",
        "error_handling",
        "cost_efficiency",
        "overall_score:",
        "summary:",
        "recommendations:",
    ]
    assert lines[-1] == "Return JSON only."
    assert found["mute"].replay_text is None
    assert "Session replay:\n(no events)\n\n" in found["mute"].full_prompt
    assert set(found) == {"s1", "mute"}


def test_replay_options_reach_the_prompt(spark):
    rows = [event(v.USER_PROMPT, i) for i in range(5)]
    one = _prompted(spark, [session()], rows, keep_interactions=1).first().replay_text
    assert one.count("compressed") == 3
    cut = _prompted(spark, [session()], rows, replay_char_budget=40).first().replay_text
    assert len(cut) == 40


GRADES = {
    "task_clarity": 1,
    "agent_effectiveness": 2,
    "tool_strategy": 3,
    "error_handling": 4,
    "cost_efficiency": 5,
    "overall_score": 6,
    "summary": "s",
    "recommendations": "r",
}


@pytest.mark.parametrize(
    "answer, overall",
    [
        (json.dumps(GRADES), 6),
        (json.dumps({"judgment": GRADES}), 6),
        (json.dumps({"overall_score": 0}), 0),
        ("not json", None),
        ("", None),
        (None, None),
        (json.dumps({**GRADES, "overall_score": "high"}), None),
        (json.dumps({"other": GRADES}), None),
    ],
)
def test_parse_judgment(spark, answer, overall):
    frame = spark.createDataFrame([(answer,)], "a string")
    parsed = frame.select(judge.parse_judgment(F.col("a")).alias("j")).first().j
    assert parsed.overall_score == overall
    if answer and "task_clarity" in answer and overall is not None:
        assert parsed.asDict() == GRADES


def test_failed_judgments_are_left_out(spark):
    prompted = _prompted(spark, [session("good"), session("bad")], [])
    answer = F.when(F.col("session_id") == "good", F.lit(json.dumps(GRADES))).otherwise("?")
    rows = judge.session_scores(prompted.withColumn("ai_response", answer), NOW)
    assert rows.columns == schemas.SESSION_SCORES.fieldNames()
    assert [(r.session_id, r.llm_overall_score) for r in rows.collect()] == [("good", 6)]


def test_vectorised_judge(spark):
    @F.pandas_udf("string")
    def ask(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda text: json.dumps({"overall_score": len(text)}))

    prompted = _prompted(spark, [session()], [])
    row = judge.session_scores(judge.column_judge(ask)(prompted), NOW).first()
    assert row.llm_overall_score == len(prompted.first().full_prompt)


def test_rule_judge_grades_every_session(spark):
    rows = judge.session_scores(judge.rule_judge(_prompted(spark, [session()], [])), NOW).collect()
    assert [row.llm_error_handling for row in rows] == [100]


def test_response_format_lists_the_judgment():
    assert judge.response_format() == (
        "STRUCT<judgment STRUCT<task_clarity INT, agent_effectiveness INT, tool_strategy INT, "
        "error_handling INT, cost_efficiency INT, overall_score INT, summary STRING, "
        "recommendations STRING>>"
    )
