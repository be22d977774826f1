"""Cumulative counters against a sequential model."""

import random
from collections import defaultdict

import pytest

from conftest import frame
from sessionlens import vocabulary as v
from sessionlens.operators import metrics, temporality
from sessionlens.sources import schemas

HOUR = 3600 * 10**9


def _point(value, t, start=1, session="s1", kind="CUMULATIVE", monotonic=None, resource=None, **more):
    attributes = {"session.id": session, **more} if session else None
    fields = {
        "name": v.METRIC_COST,
        "sum": (start, t, value, None, attributes, None, kind, monotonic),
        "resource": (resource, None),
    }
    return fields


def _points(spark, rows):
    return frame(spark, schemas.METRICS, rows)


def _costs(spark, rows, **options):
    deltas = temporality.as_deltas(_points(spark, rows), **options)
    found = metrics.cost_by_session(deltas).collect()
    return {r.session_id: round(r.total_cost_usd, 9) for r in found}


def _model(rows):
    """Distinct cumulative points in order; increases, or whole values after a restart."""
    totals, series = defaultdict(float), defaultdict(set)
    for row in rows:
        start, t, value, _, attributes, _, kind, monotonic = row["sum"]
        if attributes is None or value is None:
            continue
        if "CUMULATIVE" not in kind:
            totals[attributes["session.id"]] += value
            continue
        key = (tuple(sorted(attributes.items())), str(row["resource"][0]))
        series[key].add((t or 0, value, start or 0, monotonic is not False))
    for (attributes, _), points in series.items():
        last = None
        for t, value, start, monotonic in sorted(points):
            fresh = last is None or last[2] != start or (monotonic and value < last[1])
            totals[dict(attributes)["session.id"]] += value if fresh else value - last[1]
            last = (t, value, start)
    return {session: round(total, 9) for session, total in totals.items()}


@pytest.mark.parametrize("seed, bucket_s", [(1, 3600), (2, 1), (3, 10**6)])
def test_random_series_equal_the_model(spark, seed, bucket_s):
    r = random.Random(seed)
    rows, value = [], defaultdict(int)
    for _ in range(400):
        session, model = f"s{r.randrange(3)}", f"m{r.randrange(2)}"
        if r.random() < 0.1:
            value[session, model] = 0
        value[session, model] += r.randrange(5)
        rows.append(
            _point(
                float(value[session, model]), r.randrange(20) * HOUR // 4, r.choice([1, 1, 2]),
                session, r.choice(["AGGREGATION_TEMPORALITY_CUMULATIVE", "delta"]), None,
                r.choice([None, {"host": "a"}]), model=model,
            )
        )
        if r.random() < 0.1:
            rows.append(rows[-1])
    assert _costs(spark, rows, bucket_s=bucket_s) == _model(rows)


def test_restarts_copies_and_delta_points(spark):
    rows = [_point(float(x), t * HOUR) for t, x in enumerate([1, 3, 3, 7])]
    assert _costs(spark, rows) == {"s1": 7.0}
    assert _costs(spark, rows * 3) == {"s1": 7.0}
    assert _costs(spark, [*rows, _point(2.0, 9 * HOUR)]) == {"s1": 9.0}  # fell: began again
    assert _costs(spark, [*rows, _point(8.0, 9 * HOUR, start=5)]) == {"s1": 15.0}
    falling = [_point(float(x), t, monotonic=False) for t, x in enumerate([5, 3, 4])]
    assert _costs(spark, falling) == {"s1": 4.0}
    plain = [_point(2.0, 1, kind="AGGREGATION_TEMPORALITY_DELTA"), _point(2.0, 1, kind=None)] * 2
    assert _costs(spark, plain) == {"s1": 8.0}


def test_missing_parts_and_empty_table(spark):
    rows = [_point(None, 1), _point(3.0, None), _point(4.0, 2, start=None), _point(9.0, 1, session=None)]
    assert _costs(spark, rows) == {"s1": 7.0}
    assert _costs(spark, []) == {}


def test_a_series_is_ordered_by_buckets(spark):
    plan = temporality.increases(_points(spark, []))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert len(windows) == 2 and "Python" not in plan
    # Single points are ordered inside a bucket; whole series only by their buckets' last points.
    assert any("b#" in line.split("], [")[1] for line in windows)


def test_points_are_read_once_and_edges_of_buckets_meet(spark):
    rows = _points(spark, [])
    plan = temporality.increases(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1
    assert "Join" not in plan
    # Buckets of one point, of two and of many, in two series; a copy at the edge of a bucket.
    times = [0, HOUR, HOUR + 1, 5 * HOUR, 5 * HOUR + 1, 5 * HOUR + 2, 5 * HOUR + 3, 9 * HOUR]
    rows = [_point(10.0 * (n + 1), t, session=s) for n, t in enumerate(times) for s in ("s1", "s2")]
    rows += [_point(20.0, HOUR), _point(70.0, 5 * HOUR + 3)]
    found = temporality.increases(_points(spark, rows)).collect()
    assert sorted((r.attributes["session.id"], r.t, r.value) for r in found) == [
        (s, t, 10.0) for s in ("s1", "s2") for t in times
    ]
    # Attributes in another order are the same series.
    one, two = _point(1.0, 1, a="x", b="y"), _point(3.0, 2, b="y", a="x")
    assert _costs(spark, [one, two]) == {"s1": 3.0}
