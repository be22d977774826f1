"""Number and timestamp texts against Python's own formatting."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sessionlens.functions.text import fixed_point, shortest_number, timestamp_text


def _values():
    generator = random.Random(7)
    ties = [k / 100000 for k in range(5, 2000, 10)]
    noise = [generator.uniform(0, 10**generator.randint(-6, 9)) for _ in range(500)]
    return ties + noise + [0.0, 1.0, 0.5, 2.5, 0.00005, 1e-9, 123456789.99995, -0.00015, -3.5]


@pytest.mark.parametrize("digits", [2, 4])
def test_fixed_point_rounds_like_python(spark, digits):
    values = _values()
    rows = spark.createDataFrame([(value,) for value in values], "x double")
    texts = {r.x: r.t for r in rows.select("x", fixed_point(F.col("x"), digits).alias("t")).collect()}
    assert {x: f"{x:.{digits}f}" for x in values} == texts


def test_fixed_point_of_huge_values(spark):
    row = spark.sql("SELECT 1e20 AS x").select(fixed_point(F.col("x"), 4).alias("t")).first()
    assert row.t == f"{1e20:.4f}"


def test_shortest_number(spark):
    values = {0.0: "0", 1234.0: "1234.0", 12345678.5: "12345678.5", 0.25: "0.25", 100.0: "100.0"}
    rows = spark.createDataFrame([(value,) for value in values], "x double")
    found = {r.x: r.t for r in rows.select("x", shortest_number(F.col("x")).alias("t")).collect()}
    assert found == values


def test_timestamp_text_drops_an_empty_fraction(spark):
    moments = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120)]
    rows = spark.createDataFrame([(m,) for m in moments], "ts timestamp")
    found = {r.ts: r.t for r in rows.select("ts", timestamp_text(F.col("ts")).alias("t")).collect()}
    assert found == {m: str(m) for m in moments}
