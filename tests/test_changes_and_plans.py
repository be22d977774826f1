"""Table changes and the three jobs, on real tables of a scratch warehouse."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import NOW, event, events, frame, log, point, session, span, summaries
from sessionlens import vocabulary as v
from sessionlens.operators import changes, judge, rollups, segments, worksets
from sessionlens.plans.human_signals import score_human_signals
from sessionlens.plans.scoring import score_sessions
from sessionlens.plans.silver import silver_etl
from sessionlens.sinks import tables
from sessionlens.sources import bronze as readers
from sessionlens.sources import schemas


def _pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, x int")


def _set(rows_of):
    return sorted((tuple(row) for row in rows_of.collect()), key=str)


# ---- changes as frames -----------------------------------------------------------


def test_upsert_replaces_adds_and_keeps(spark):
    target = _pairs(spark, ("a", 1), ("b", 1), (None, 1))
    source = _pairs(spark, ("b", 2), ("c", 2), (None, 2))
    assert _set(changes.upsert(target, source, ["k"])) == [
        ("a", 1),
        ("b", 2),
        ("c", 2),
        (None, 1),
    ]


def test_upsert_refuses_repeated_keys(spark):
    with pytest.raises(ValueError):
        changes.require_unique(_pairs(spark, ("a", 1), ("a", 2)), ["k"])
    changes.require_unique(_pairs(spark, ("a", 1), ("b", 2)), ["k"])


def test_replace_clears_touched_keys_without_rows(spark):
    target = _pairs(spark, ("a", 1), ("a", 2), ("b", 1), ("c", 1))
    source = _pairs(spark, ("a", 9))
    assert _set(changes.replace_by_key(target, source, ["k"])) == [("a", 9), ("b", 1), ("c", 1)]
    touched = _pairs(spark, ("a", 0), ("b", 0))
    assert _set(changes.replace_by_key(target, source, ["k"], touched)) == [("a", 9), ("c", 1)]
    assert _set(changes.delete_keys(target, touched, ["k"])) == [("c", 1)]


def test_append_takes_the_columns_of_both(spark):
    wider = _pairs(spark, ("b", 2)).withColumn("y", F.lit("new"))
    joined = changes.append(_pairs(spark, ("a", 1)), wider)
    assert joined.columns == ["k", "x", "y"]
    assert _set(joined) == [("a", 1, None), ("b", 2, "new")]


# ---- publication -------------------------------------------------------------------


def test_publish_may_read_the_table_it_replaces(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    name = f"{schema_name}.t"
    tables.ensure_table_like(name, _pairs(spark, ("z", 0)))
    assert spark.table(name).count() == 0
    tables.append(_pairs(spark, ("a", 1)).select("k"), name)
    tables.upsert(_pairs(spark, ("b", 2)), name, ["k"])
    tables.upsert(_pairs(spark, ("b", 3)), name, ["k"])
    assert _set(spark.table(name)) == [("a", None), ("b", 3)]
    shown = spark.sql(f"SHOW TABLES IN {schema_name}").collect()
    assert [table.tableName for table in shown] == ["t"]
    assert not tables.has_row_level_operations(spark, name)


def test_interrupted_publication_is_undone(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    name = f"{schema_name}.t"
    tables.publish(_pairs(spark, ("a", 1)), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__previous")
    tables.recover(spark, name)
    assert _set(spark.table(name)) == [("a", 1)]


def test_changes_keep_layout_and_touch_only_their_partitions(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    name = f"{schema_name}.t"
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("b", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "k string, n int, p string"
    )
    rows.write.format("orc").partitionBy("p").saveAsTable(name)
    files = {f for f in spark.table(name).filter("p = 'z'").inputFiles()}
    new = spark.createDataFrame([("b", 9, "w", "extra")], "k string, n int, p string, q string")
    tables.replace(new, name, ["k"])
    found = {(r.k, r.n, r.p, r.q) for r in spark.table(name).collect()}
    assert found == {("a", 1, "x", None), ("b", 9, "w", "extra"), ("c", 3, "z", None)}
    assert {f for f in spark.table(name).filter("p = 'z'").inputFiles()} == files
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"p=x", "p=w", "p=z"}
    tables.upsert(rows.filter("k = 'c'").withColumn("n", F.lit(4)), name, ["k"])
    assert {r.n for r in spark.table(name).filter("k = 'c'").collect()} == {4}
    assert tables.table_format(spark, name) == "orc"
    assert tables.partition_columns(spark, name) == ["p"]


def test_publication_keeps_format_and_properties(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    name = f"{schema_name}.t"
    tables.ensure_table_like(name, _pairs(spark, ("z", 0)), file_format="orc")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'a')")
    tables.upsert(_pairs(spark, ("a", 1)), name, ["k"])
    assert tables.table_format(spark, name) == "orc"
    kept = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    assert {r.key: r.value for r in kept}["owner.team"] == "a"


def test_append_gives_the_table_new_columns(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    name = f"{schema_name}.t"
    tables.publish(_pairs(spark, ("a", 1)), name)
    tables.append(_pairs(spark, ("b", 2)).withColumn("y", F.lit("new")), name)
    assert _set(spark.table(name)) == [("a", 1, None), ("b", 2, "new")]


# ---- work sets -----------------------------------------------------------------------


def test_events_of_a_work_set(spark):
    rows = [event(v.LLM_CALL, i, f"s{i % 3}") for i in range(30)] + [event(v.LLM_CALL, None, "s1")]
    keys = summaries(spark, [session("s1"), session("s2"), session("s1")])
    found = worksets.events_of(events(spark, rows), keys)
    assert found.columns == schemas.SESSION_EVENTS.fieldNames()
    assert found.groupBy("session_id").count().orderBy("session_id").collect() == [
        ("s1", 11),
        ("s2", 10),
    ]


def test_sessions_due_for_a_score(spark):
    done = summaries(spark, [session("new", 3), session("same", 30), session("resumed", 5)])
    scored = spark.createDataFrame(
        [("same", NOW - timedelta(hours=30)), ("resumed", NOW - timedelta(hours=6))],
        "session_id string, scored_session_end timestamp",
    ).withColumn("first_scored_at", F.col("scored_session_end") + F.expr("INTERVAL 20 MINUTES"))
    assert [r.session_id for r in worksets.unscored_sessions(done, scored).collect()] == ["new"]

    def due(grace):
        return {r.session_id for r in worksets.due_sessions(done, scored, grace).collect()}

    assert due("INTERVAL 1 DAY") == {"new", "resumed"}
    assert due("INTERVAL 30 MINUTES") == {"new"}


# ---- bronze -> silver ------------------------------------------------------------------


def _run_silver(spark, raw, schema_name):
    silver_etl(spark, raw, schema_name)
    return {
        name: spark.table(f"{schema_name}.{name}")
        for name in (v.SILVER_METRICS, v.SILVER_SUMMARY, v.SILVER_EVENTS)
    }


def test_silver_tables(spark, bronze, schema_name):
    raw = bronze(
        [span(v.SPAN_INTERACTION, end=5), span(v.SPAN_TOOL), span(v.SPAN_INTERACTION, "s2")],
        [log(v.LOG_USER_PROMPT), log(v.LOG_USER_PROMPT, "s3")],
        [point(v.METRIC_COST, 0.5, model="m"), point(v.METRIC_COST, 1.0, session=None)],
    )
    silver = _run_silver(spark, raw, schema_name)
    for name, schema in (
        (v.SILVER_METRICS, schemas.SESSION_METRICS),
        (v.SILVER_SUMMARY, schemas.SESSION_SUMMARY),
        (v.SILVER_EVENTS, schemas.SESSION_EVENTS),
    ):
        stored = silver[name].drop("event_day", "delivery")
        assert stored.schema.simpleString() == schema.simpleString()
    assert [r.total_cost_usd for r in silver[v.SILVER_METRICS].collect()] == [0.5]
    costs = {r.session_id: r.total_cost_usd for r in silver[v.SILVER_SUMMARY].collect()}
    assert costs == {"s1": 0.5, "s2": None}
    assert _set(silver[v.SILVER_EVENTS].select("session_id", "event_type")) == [
        ("s1", "TOOL_CALL"),
        ("s1", "USER_PROMPT"),
        ("s3", "USER_PROMPT"),
    ]


def test_a_second_run_replaces_sessions_and_keeps_others(spark, bronze, schema_name):
    first = bronze(
        [span(v.SPAN_INTERACTION), span(v.SPAN_INTERACTION, "gone")],
        [log(v.LOG_USER_PROMPT), log(v.LOG_API_ERROR, ts=1), log(v.LOG_USER_PROMPT, "gone")],
        [point(v.METRIC_COST, 1.0), point(v.METRIC_COST, 9.0, "gone")],
    )
    _run_silver(spark, first, schema_name)
    second = bronze(
        [span(v.SPAN_INTERACTION), span(v.SPAN_INTERACTION, start=9)],
        [log(v.LOG_USER_PROMPT), log(v.LOG_USER_PROMPT, ts=2)],
        [point(v.METRIC_COST, 3.0)],
    )
    for _ in range(2):
        silver = _run_silver(spark, second, schema_name)
        metrics = silver[v.SILVER_METRICS].select("session_id", "total_cost_usd")
        assert _set(metrics) == [("gone", 9.0), ("s1", 3.0)]
        counts = silver[v.SILVER_SUMMARY].select("session_id", "num_interactions")
        assert _set(counts) == [("gone", 1), ("s1", 2)]
        assert _set(silver[v.SILVER_EVENTS].select("session_id", "event_type")) == [
            ("gone", "USER_PROMPT"),
            ("s1", "USER_PROMPT"),
            ("s1", "USER_PROMPT"),
        ]


def test_timeline_gains_columns_and_keeps_other_sessions(spark, bronze, schema_name):
    tables.ensure_schema(spark, schema_name)
    old = events(spark, [event(v.USER_PROMPT, 0, "other")]).drop("decision_source", "error_category")
    old.write.saveAsTable(f"{schema_name}.{v.SILVER_EVENTS}")
    raw = bronze([], [log(v.LOG_TOOL_DECISION, decision="accept", source="config")], [])
    timeline = _run_silver(spark, raw, schema_name)[v.SILVER_EVENTS]
    found = {r.session_id: (r.decision_source, r.error_category) for r in timeline.collect()}
    assert found == {"other": (None, None), "s1": ("config", None)}


def test_bronze_files_are_read_with_a_fixed_schema(spark, bronze, tmp_path):
    raw = readers.from_catalog(spark, bronze([span(v.SPAN_TOOL)], [log(v.LOG_USER_PROMPT)]))
    raw.traces.select("name", "attributes").write.parquet(f"{tmp_path}/{v.BRONZE_TRACES}")
    raw.logs.write.parquet(f"{tmp_path}/{v.BRONZE_LOGS}")
    raw.metrics.write.parquet(f"{tmp_path}/{v.BRONZE_METRICS}")
    files = readers.from_files(spark, str(tmp_path))
    assert files.traces.columns == schemas.TRACES.fieldNames()
    assert files.traces.first().resource is None
    assert files.logs.first().attributes["session.id"] == "s1"


# ---- silver -> gold: human signals ----------------------------------------------------


def _decision(outcome, tool="Bash", ts=0.0):
    return event(v.TOOL_DECISION, ts, detail_name=outcome, tool_name=tool)


def _signals(spark, schema_name):
    score_human_signals(spark, schema_name, schema_name, NOW)
    rows = spark.table(f"{schema_name}.{v.GOLD_SIGNALS}").collect()
    tools = spark.table(f"{schema_name}.{v.GOLD_SIGNALS_BY_TOOL}").collect()
    return {r.session_id: r for r in rows}, {(r.session_id, r.tool_name): r for r in tools}


def test_signals_are_recomputed_and_vanished_tools_go(spark, silver, schema_name):
    silver([session(), session("young", 1)], [_decision("reject"), _decision("accept", "Edit", 1)])
    rows, tools = _signals(spark, schema_name)
    assert set(rows) == {"s1"}
    assert (rows["s1"].reject_rate, rows["s1"].computed_at) == (0.5, NOW)
    assert set(tools) == {("s1", "Bash"), ("s1", "Edit")}

    silver([session()], [_decision("accept")])
    rows, tools = _signals(spark, schema_name)
    assert rows["s1"].reject_rate == 0.0
    assert set(tools) == {("s1", "Bash")}

    silver([session()], [event(v.LLM_CALL, 0)])
    rows, tools = _signals(spark, schema_name)
    assert rows["s1"].human_friction_score is None
    assert tools == {}


def test_no_completed_session_writes_nothing(spark, silver, schema_name):
    silver([session("young", 1)])
    assert score_human_signals(spark, schema_name, schema_name, NOW) == 0
    assert score_sessions(spark, schema_name, schema_name, judge.rule_judge, as_of=NOW) == 0
    for name in (v.GOLD_SIGNALS, v.GOLD_SIGNALS_BY_TOOL, v.GOLD_SCORES):
        assert not tables.exists(spark, f"{schema_name}.{name}")


# ---- silver -> gold: scores -------------------------------------------------------------


def _judge(grade, failing=()):
    def ask(prompted):
        answer = F.lit(json.dumps({"judgment": {"overall_score": grade}}))
        failed = F.col("session_id").isin(*failing) if failing else F.lit(False)
        return prompted.withColumn("ai_response", F.when(~failed, answer))

    return ask


def _grades(spark, schema_name, ask, **options):
    score_sessions(spark, schema_name, schema_name, ask, as_of=options.pop("as_of", NOW), **options)
    rows = spark.table(f"{schema_name}.{v.GOLD_SCORES}").collect()
    assert len({row.session_id for row in rows}) == len(rows)
    return {row.session_id: row.llm_overall_score for row in rows}


def test_scores_are_written_once_and_failures_retried(spark, silver, schema_name):
    silver([session("a"), session("b"), session("young", 1)], [event(v.USER_PROMPT, 0, "a")])
    assert _grades(spark, schema_name, _judge(10, failing=["b"])) == {"a": 10}
    silver([session("a", num_interactions=50), session("b"), session("c")])
    assert _grades(spark, schema_name, _judge(20)) == {"a": 10, "b": 20, "c": 20}
    assert _grades(spark, schema_name, _judge(30)) == {"a": 10, "b": 20, "c": 20}
    stored = spark.table(f"{schema_name}.{v.GOLD_SCORES}")
    assert stored.schema.simpleString() == schemas.SESSION_SCORES.simpleString()


def test_grace_allows_to_score_a_resumed_session_again(spark, silver, schema_name):
    silver([session("a", 20), session("b", 20)])
    early = NOW.replace(day=1, hour=20)
    assert _grades(spark, schema_name, _judge(10), as_of=early) == {"a": 10, "b": 10}
    silver([session("a", 4), session("b", 20)])
    assert _grades(spark, schema_name, _judge(20)) == {"a": 10, "b": 10}
    later = _grades(spark, schema_name, _judge(30), grace="INTERVAL 1 DAY")
    assert later == {"a": 30, "b": 10}


def test_the_judge_is_asked_once_per_session(spark, silver, schema_name):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def ask(prompt):
        asked.add(1)
        return json.dumps({"overall_score": 50})

    silver([session("a"), session("b")])
    assert _grades(spark, schema_name, judge.column_judge(ask)) == {"a": 50, "b": 50}
    assert asked.value == 2


def test_prompts_are_asked_once_over_all_runs(spark, silver, schema_name):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def ask(prompt):
        asked.add(1)
        return "no grade" if "interactions: 7" in prompt else json.dumps({"overall_score": 50})

    # Two sessions alike, one that fails, one of its own.
    silver([session("a"), session("b"), session("f", num_interactions=7), session("c", num_interactions=3)])
    options = {"answers": "answers"}
    assert _grades(spark, schema_name, judge.column_judge(ask), **options) == dict.fromkeys("abc", 50)
    assert asked.value == 3
    silver([session(name) for name in "abd"] + [session("f", num_interactions=7)])
    found = _grades(spark, schema_name, judge.column_judge(ask), **options)
    # The failed prompt is asked again; that of the new session has an answer.
    assert found == dict.fromkeys("abcd", 50) and asked.value == 4


def test_a_batch_judge_retries_and_isolates_failures(spark, silver, schema_name):
    def ask(prompts):
        if any("interactions: 9" in prompt for prompt in prompts):
            raise RuntimeError("broken")
        return [json.dumps({"overall_score": 40}) for _ in prompts]

    silver([session(f"s{i}", num_interactions=i) for i in range(8, 12)])
    found = _grades(spark, schema_name, judge.batch_judge(ask, batch=10, retries=1, wait_s=0))
    assert found == {"s8": 40, "s10": 40, "s11": 40}


def test_answers_of_batches():
    calls = []

    def ask(prompts):
        calls.append(list(prompts))
        if len(calls) == 1:
            raise RuntimeError("busy")
        if len(calls) == 2:
            return []
        return [p.upper() if p != "x" else None for p in prompts]

    got = judge._answers(ask, ["a", None, "x", "b"], 2, 3, 0)
    assert got == ["A", None, None, "B"]
    assert calls == [["a", "x"], ["b"], ["a", "x"], ["b"], ["x"], ["x"]]
    assert judge._answers(ask, [], 2, 3, 0) == []


# ---- segments and roll-ups ----------------------------------------------------------------


def test_segments_are_cut_at_idle_gaps(spark):
    rows = [event(v.LLM_CALL, t) for t in (0, 100, 7300, 7301, 20000)] + [event(v.LLM_CALL, None)]
    found = segments.idle_segments(events(spark, rows), 7200).orderBy("segment").collect()
    assert [(r.segment, r.num_events) for r in found] == [(0, 4), (1, 1)]
    close = segments.idle_segments(events(spark, rows), 10).orderBy("segment").collect()
    assert [r.num_events for r in close] == [1, 1, 2, 1]


def test_signal_rollup_levels(spark):
    rows = [
        {"session_id": "a", "user_id": "u", "primary_model": "m", "human_friction_score": 10.0},
        {"session_id": "b", "user_id": "w", "primary_model": "m", "human_friction_score": 20.0},
        {"session_id": "c", "user_id": "u", "primary_model": None},
    ]
    found = rollups.signal_rollup(frame(spark, schemas.SESSION_HUMAN_SIGNALS, rows)).collect()
    levels = {(r.level, r.primary_model, r.user_id): (r.sessions, r.avg_friction) for r in found}
    assert levels[(3, None, None)] == (3, 15.0)
    assert levels[(1, "m", None)] == (2, 15.0)
    assert levels[(0, None, "u")] == (1, None)
