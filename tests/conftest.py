from __future__ import annotations

import os
import sys
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from sessionlens import vocabulary as v  # noqa: E402
from sessionlens.sources import schemas  # noqa: E402

T0 = datetime(2024, 3, 1, 12, 0, 0)
NOW = datetime(2024, 3, 2, 12, 0, 0)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    os.environ["TZ"] = "UTC"
    session = (
        SparkSession.builder.master("local[4]")
        .appName("sessionlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema_name():
    return f"s{uuid.uuid4().hex[:10]}"


def frame(spark, schema, rows):
    """Rows given as dicts; fields left out are NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def span(name, session="s1", start=0, end=None, events=None, resource=None, **attributes):
    named = {key.replace("__", "."): value for key, value in attributes.items()}
    nanos = int(T0.timestamp()) * 10**9
    return {
        "name": name,
        "attributes": {**({"session.id": session} if session else {}), **named},
        "start_time_unix_nano": nanos + int(start * 10**9),
        "end_time_unix_nano": nanos + int((start if end is None else end) * 10**9),
        "events": [(None, None, event, None) for event in events or []],
        "resource": (resource or {}, None),
    }


def log(body, session="s1", ts=0, **attributes):
    named = {key.replace("__", "."): value for key, value in attributes.items()}
    time = {} if ts is None else {"event.timestamp": at(ts).isoformat() + "Z"}
    return {
        "body": body,
        "attributes": {**({"session.id": session} if session else {}), **time, **named},
    }


def point(name, value, session="s1", **attributes):
    named = {**({"session.id": session} if session else {}), **attributes}
    return {"name": name, "sum": (None, None, value, None, named, None, None, None)}


def traces(spark, rows):
    return frame(spark, schemas.TRACES, rows)


def logs(spark, rows):
    return frame(spark, schemas.LOGS, rows)


def metrics(spark, rows):
    return frame(spark, schemas.METRICS, rows)


def event(kind, ts=0.0, session="s1", **fields):
    return {
        "session_id": session,
        "event_ts": None if ts is None else at(ts),
        "event_type": kind,
        **fields,
    }


def events(spark, rows):
    return frame(spark, schemas.SESSION_EVENTS, rows)


def session(name="s1", ended_h_ago=3.0, **fields):
    return {
        "session_id": name,
        "user_id": "ann",
        "session_start": NOW - timedelta(hours=ended_h_ago + 1),
        "session_end": NOW - timedelta(hours=ended_h_ago),
        "num_interactions": 1,
        **fields,
    }


def summaries(spark, rows):
    return frame(spark, schemas.SESSION_SUMMARY, rows)


@pytest.fixture
def silver(spark, schema_name):
    """Creates a silver schema with the given rows and returns its name."""

    def make(summary=(), event_rows=(), metric_rows=()):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema_name}")
        for table, schema, rows in (
            (v.SILVER_SUMMARY, schemas.SESSION_SUMMARY, summary),
            (v.SILVER_EVENTS, schemas.SESSION_EVENTS, event_rows),
            (v.SILVER_METRICS, schemas.SESSION_METRICS, metric_rows),
        ):
            frame(spark, schema, rows).write.mode("overwrite").saveAsTable(
                f"{schema_name}.{table}"
            )
        return schema_name

    return make


@pytest.fixture
def bronze(spark, schema_name):
    """Creates a bronze schema with the given rows and returns its name."""

    def make(trace_rows=(), log_rows=(), metric_rows=()):
        name = f"{schema_name}_raw"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
        for table, schema, rows in (
            (v.BRONZE_TRACES, schemas.TRACES, trace_rows),
            (v.BRONZE_LOGS, schemas.LOGS, log_rows),
            (v.BRONZE_METRICS, schemas.METRICS, metric_rows),
        ):
            frame(spark, schema, rows).write.mode("overwrite").saveAsTable(f"{name}.{table}")
        return name

    return make
