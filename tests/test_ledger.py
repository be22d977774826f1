"""Updates from new bronze files against full runs over all of them."""

import os
from urllib.parse import unquote, urlparse

import pytest

from conftest import frame, log, point, span
from sessionlens import vocabulary as v
from sessionlens.plans import silver
from sessionlens.sinks import tables
from sessionlens.sources import bronze as readers
from sessionlens.sources import ledger, schemas

NO_MARGIN = "INTERVAL 0 SECONDS"


def _add(spark, raw, trace_rows=(), log_rows=(), metric_rows=()):
    for table, schema, rows in (
        (v.BRONZE_TRACES, schemas.TRACES, trace_rows),
        (v.BRONZE_LOGS, schemas.LOGS, log_rows),
        (v.BRONZE_METRICS, schemas.METRICS, metric_rows),
    ):
        if rows:
            frame(spark, schema, rows).coalesce(1).write.mode("append").insertInto(f"{raw}.{table}")


def _files(spark, raw, table):
    return {unquote(urlparse(f).path) for f in spark.table(f"{raw}.{table}").inputFiles()}


def _age(paths, days):
    for path in paths:
        changed = os.path.getmtime(path) - days * 86_400
        os.utime(path, (changed, changed))


def _rows(spark, schema):
    found = {}
    for table in (v.SILVER_METRICS, v.SILVER_SUMMARY, v.SILVER_EVENTS):
        rows = spark.table(f"{schema}.{table}").drop(*silver.LAYOUT)
        found[table] = sorted(str(tuple(row)) for row in rows.collect())
    return found


@pytest.fixture
def raw(spark, bronze):
    name = bronze([], [], [])
    for i, session in enumerate(("s1", "s2", "s3")):
        _add(
            spark, name,
            [span(v.SPAN_INTERACTION, session, i), span(v.SPAN_TOOL, session, i)],
            [log(v.LOG_USER_PROMPT, session, i), log(v.LOG_USER_PROMPT, None, i)],
            [point(v.METRIC_COST, 1.0 + i, session)],
        )
    return name


def test_updates_equal_a_full_run(spark, raw, schema_name):
    assert silver.silver_update(spark, raw, schema_name) == 3
    assert silver.silver_update(spark, raw, schema_name) == 0
    # More of s1, an event that is days late, a record without time, a session of its own.
    _add(
        spark, raw,
        [span(v.SPAN_INTERACTION, "s1", 100)],
        [log(v.LOG_USER_PROMPT, "s2", -500_000), log(v.LOG_USER_PROMPT, "s2", None)],
        [point(v.METRIC_COST, 5.0, "s1"), point(v.METRIC_COST, 2.0, "s4")],
    )
    assert silver.silver_update(spark, raw, schema_name) == 3
    tables.ensure_schema(spark, f"{schema_name}_full")
    silver.silver_etl(spark, raw, f"{schema_name}_full")
    assert _rows(spark, schema_name) == _rows(spark, f"{schema_name}_full")
    shown = {r.tableName for r in spark.sql(f"SHOW TABLES IN {schema_name}").collect()}
    assert not any(name.startswith("staged_") for name in shown)


def test_an_update_reads_only_files_of_its_sessions(spark, raw, schema_name):
    silver.silver_update(spark, raw, schema_name)
    known = spark.table(f"{schema_name}.{silver.LEDGER}")
    held = known.filter("source = 'logs' AND session_id = 's1'").select("file").first()[0]
    others = _files(spark, raw, v.BRONZE_LOGS) - {unquote(urlparse(held).path)}
    old = _files(spark, raw, v.BRONZE_LOGS)
    _age(old, 30)
    for path in others:  # files of other sessions cannot be read any more
        changed = os.path.getmtime(path)
        with open(path, "r+b") as file:
            file.write(b"gone")
            file.seek(-4, os.SEEK_END)
            file.write(b"gone")
        os.utime(path, (changed, changed))
    _add(spark, raw, [], [log(v.LOG_USER_PROMPT, "s1", 50)])
    assert silver.silver_update(spark, raw, schema_name, NO_MARGIN) == 1
    events = spark.table(f"{schema_name}.{v.SILVER_EVENTS}")
    prompts = events.filter("event_type = 'USER_PROMPT'").groupBy("session_id").count().collect()
    assert {r.session_id: r["count"] for r in prompts} == {"s1": 2, "s2": 1, "s3": 1}


def test_the_plan_of_a_scan_names_its_files(spark, raw, schema_name):
    silver.silver_update(spark, raw, schema_name)
    logs = readers.from_catalog(spark, raw).logs
    files = spark.table(f"{schema_name}.{silver.LEDGER}").filter("source = 'logs'")
    one = files.filter("session_id = 's1'")
    plan = ledger.in_files(logs, one)._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan and "PartitionFilters" in plan
    assert ledger.in_files(logs, one).count() == 2
    assert ledger.in_files(logs, files.limit(0)).count() == 0


def test_many_files_are_bounded_by_their_times(spark, raw, schema_name, monkeypatch):
    monkeypatch.setattr(ledger, "LISTED_FILES", 1)
    test_updates_equal_a_full_run(spark, raw, schema_name)


def test_a_run_that_ends_early_is_done_again(spark, raw, schema_name, monkeypatch):
    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(ledger.Update, "finish", stop)
    with pytest.raises(RuntimeError):
        silver.silver_update(spark, raw, schema_name)
    monkeypatch.undo()
    assert silver.silver_update(spark, raw, schema_name) == 3
    silver.silver_etl(spark, raw, f"{schema_name}_full")
    assert _rows(spark, schema_name) == _rows(spark, f"{schema_name}_full")


def test_a_file_that_is_published_late_counts(spark, raw, schema_name):
    silver.silver_update(spark, raw, schema_name)
    before = _files(spark, raw, v.BRONZE_LOGS)
    _add(spark, raw, [], [log(v.LOG_USER_PROMPT, "s9", 5)])
    _age(_files(spark, raw, v.BRONZE_LOGS) - before, 0.5)
    spark.catalog.refreshTable(f"{raw}.{v.BRONZE_LOGS}")
    assert silver.silver_update(spark, raw, schema_name) == 1
