"""The streaming timeline gives what the batch gives on the same files."""

import pytest

from conftest import event, events, log, logs, metrics, point, span, traces
from sessionlens import vocabulary as v
from sessionlens.operators import segments, timeline
from sessionlens.plans import silver
from sessionlens.sinks import tables
from sessionlens.sources import bronze as readers
from sessionlens.streaming import timeline as streaming

LOGS = [
    log(v.LOG_USER_PROMPT, ts=0, prompt="a"),
    log(v.LOG_API_REQUEST, ts=60, model="m"),
    log(v.LOG_API_ERROR, ts=90, error="Request was aborted."),
    log(v.LOG_USER_PROMPT, ts=20_000, prompt="b"),
    log(v.LOG_USER_PROMPT, "s2", ts=10, prompt="c"),
    log(v.LOG_USER_PROMPT, None, ts=10),
    # Alike in their first 500 characters; at one instant with other costs; without time.
    log(v.LOG_USER_PROMPT, ts=300, prompt="x" * 500 + "one"),
    log(v.LOG_USER_PROMPT, ts=300, prompt="x" * 500 + "two"),
    log(v.LOG_API_REQUEST, ts=400, model="m", cost_usd="0.1"),
    log(v.LOG_API_REQUEST, ts=400, model="m", cost_usd="0.2"),
    log(v.LOG_USER_PROMPT, ts=None, prompt="no time"),
]
SPANS = [span(v.SPAN_TOOL, start=70, tool_name="Bash"), span(v.SPAN_INTERACTION)]


def _write(spark, folder, log_rows):
    logs(spark, log_rows).coalesce(1).write.mode("append").parquet(f"{folder}/{v.BRONZE_LOGS}")


def _raw(spark, folder):
    traces(spark, SPANS).coalesce(1).write.parquet(f"{folder}/{v.BRONZE_TRACES}")
    metrics(spark, [point(v.METRIC_COST, 1.0)]).write.parquet(f"{folder}/{v.BRONZE_METRICS}")
    _write(spark, folder, LOGS)
    return folder


def _rows(frame):
    return sorted(str(tuple(row)) for row in frame.collect())


def _run_stream(spark, folder, table, checkpoint):
    events = streaming.stream_events(streaming.stream_bronze(spark, folder))
    query = streaming.write_timeline(events, table, checkpoint, available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    spark.catalog.refreshTable(table)  # the stream has a session of its own
    return _rows(spark.table(table).drop(*silver.LAYOUT))


@pytest.fixture
def events_table(spark, schema_name):
    tables.ensure_schema(spark, schema_name)
    return f"{schema_name}.events"


def test_stream_equals_batch_row_for_row(spark, tmp_path, events_table):
    folder, checkpoint = _raw(spark, str(tmp_path)), f"{tmp_path}/checkpoint"

    def batch():
        table = f"{events_table}_batch{len(list(tmp_path.iterdir()))}"
        silver.write_timeline(readers.from_files(spark, folder), table)
        return _rows(spark.table(table).drop(*silver.LAYOUT))

    assert _run_stream(spark, folder, events_table, checkpoint) == batch()
    # The same records again, three equal ones, a new event, and one that is days late.
    newer = log(v.LOG_USER_PROMPT, "s2", ts=500_000, prompt="d")
    late = log(v.LOG_USER_PROMPT, "s2", ts=-500_000, prompt="e")
    same = [log(v.LOG_USER_PROMPT, "s4", ts=5, prompt="again")] * 3
    _write(spark, folder, [*LOGS, newer, late, *same])
    streamed = _run_stream(spark, folder, events_table, checkpoint)
    again = timeline.session_events(traces(spark, SPANS), logs(spark, [*LOGS, *LOGS, newer, late, *same]))
    assert streamed == _rows(again)
    assert sum("again" in row for row in streamed) == 3
    # The batch job over the very same files replaces the sessions and changes nothing.
    silver.write_timeline(readers.from_files(spark, folder), events_table)
    assert _rows(spark.table(events_table).drop(*silver.LAYOUT)) == streamed
    assert tables.partition_columns(spark, events_table) == silver.LAYOUT


def _delivered(spark, table):
    return _rows(spark.table(table).select("session_id", "event_ts", "event_type"))


def test_a_delivery_counts_once_and_reads_no_other(spark, events_table):
    first = events(spark, [event(v.LLM_CALL, 5)] * 3 + [event(v.LLM_CALL, 90_000, "s2")])
    second = events(spark, [event(v.LLM_CALL, 5), event(v.TOOL_CALL, None)])
    silver.merge_events(first, events_table, "q-0")
    silver.merge_events(second, events_table, "q-1")
    before = _delivered(spark, events_table)
    assert len(before) == 6
    files = set(spark.table(events_table).filter("delivery = 'q-0'").inputFiles())
    silver.merge_events(second, events_table, "q-1")
    assert _delivered(spark, events_table) == before
    assert set(spark.table(events_table).filter("delivery = 'q-0'").inputFiles()) == files
    assert silver.gather_deliveries(spark, events_table) == 3
    assert _delivered(spark, events_table) == before
    shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {events_table}").collect()}
    assert {partition.split("/")[1] for partition in shown} == {"delivery=base"}
    assert silver.gather_deliveries(spark, events_table) == 0


def test_deliveries_into_a_table_without_partitions(spark, events_table):
    events(spark, [event(v.LLM_CALL, 1, "old")]).write.saveAsTable(events_table)
    for _ in range(2):
        silver.merge_events(events(spark, [event(v.LLM_CALL, 2)] * 2), events_table, "q-0")
    assert spark.table(events_table).count() == 3


def test_closed_segments_equal_those_of_the_batch(spark, tmp_path, schema_name):
    folder, table = _raw(spark, str(tmp_path)), f"{schema_name}_segments"
    # An event far ahead moves the watermark past the end of all other segments.
    ahead = log(v.LOG_USER_PROMPT, "ahead", ts=500_000)
    _write(spark, folder, [ahead, LOGS[0]])
    events = streaming.unrepeated(streaming.stream_events(streaming.stream_bronze(spark, folder)))
    query = streaming.write_stream(
        streaming.stream_segments(events), table, f"{tmp_path}/checkpoint", available_now=True
    )
    query.awaitTermination()
    columns = ["session_id", "segment_start", "segment_end", "num_events"]
    batch = segments.idle_segments(
        timeline.session_events(traces(spark, SPANS), logs(spark, LOGS)), 7200
    )
    assert _rows(spark.table(table).select(*columns)) == _rows(batch.select(*columns))
    closed = spark.table(table).filter("session_id = 's1'").orderBy("segment_start").first()
    assert (closed.num_prompts, closed.num_user_aborts) == (3, 1)


def test_late_events_revise_segments(spark, tmp_path, events_table):
    """Days later than any watermark: segments are lengthened, joined and added."""
    folder, checkpoint = _raw(spark, str(tmp_path)), f"{tmp_path}/checkpoint"
    table = f"{events_table}_segments"

    def run():
        events = streaming.stream_events(streaming.stream_bronze(spark, folder))
        query = streaming.write_timeline(
            events, events_table, checkpoint, available_now=True, segments_table=table
        )
        query.awaitTermination()
        assert query.exception() is None
        for name in (events_table, table):
            spark.catalog.refreshTable(name)
        whole = segments.idle_segments(spark.table(events_table), streaming.SEGMENT_GAP_S)
        stored = spark.table(table).drop("segment_day")
        assert _rows(stored) == _rows(whole)
        return {(r.session_id, r.segment): r.num_events for r in stored.collect()}

    first = run()
    assert len([key for key in first if key[0] == "s1"]) == 2
    files = set(spark.table(table).filter("segment_day = '2024-03-01'").inputFiles())
    between = [log(v.LOG_USER_PROMPT, ts=ts) for ts in range(6000, 20_000, 6000)]
    _write(spark, folder, between)
    joined = run()
    assert len([key for key in joined if key[0] == "s1"]) == 1
    _write(spark, folder, [log(v.LOG_USER_PROMPT, "s7", ts=-500_000)])
    now = set(spark.table(table).filter("segment_day = '2024-03-01'").inputFiles())
    assert now != files
    assert set(run()) - set(joined) == {("s7", 0)}
    assert set(spark.table(table).filter("segment_day = '2024-03-01'").inputFiles()) == now
