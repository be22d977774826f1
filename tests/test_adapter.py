"""The test tables as bronze frames, and the registered queries on stored tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import query_catalogue
import stored_queries
import testdata_adapter as adapter

KINDS = ("signup", "view", "click", "purchase", "error")


@pytest.fixture(scope="module")
def one_file(spark, tmp_path_factory):
    """A folder with events in one file of one row group."""
    folder = str(tmp_path_factory.mktemp("adapter"))
    start = datetime(2024, 1, 1)
    rows = [
        (n, start + timedelta(minutes=n), n % 7, KINDS[n % 5], n / 4, json.dumps({"k": n % 100}))
        for n in range(400)
    ]
    schema = (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize(
    "make", [adapter.traces, adapter.logs, adapter.metrics, adapter.mixed_metrics]
)
def test_events_of_one_row_group_are_expanded_by_several_tasks(spark, one_file, make):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = make(spark, one_file)
        plan = found._jdf.queryExecution().executedPlan().toString()
        above_scan = plan[: plan.index("FileScan")]
        assert above_scan.rindex("Exchange") > above_scan.rindex("Generate")
        if make is not adapter.mixed_metrics:
            assert found.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_deliveries_are_computed_once(spark, one_file, monkeypatch):
    inputs = query_catalogue.Inputs(spark, one_file)
    merge, plans, counts = stored_queries.silver.merge_events, [], {}

    def noted(arrived, table, delivery):
        plans.append(arrived._jdf.queryExecution().executedPlan().toString())
        counts[delivery] = arrived.count()
        merge(arrived, table, delivery)

    monkeypatch.setattr(stored_queries.silver, "merge_events", noted)
    found = stored_queries.delivered_timeline(inputs)
    assert len(plans) == 4 and not any("Generate" in plan or "Union" in plan for plan in plans)
    assert len(counts) == 3 and all(counts.values())
    assert found.columns == inputs.events.columns
    expected = sorted(map(str, inputs.events.collect()))
    assert sorted(map(str, found.collect())) == expected and len(expected) == sum(counts.values())
