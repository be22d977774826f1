"""Readers of the three bronze tables, from a catalog or from files.

Files are always read with an explicit schema: no inference job, and columns
that a writer left out come back as NULL. Catalyst prunes the nested columns
that a plan does not touch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sessionlens import vocabulary as v
from sessionlens.sources import schemas


@dataclass(frozen=True)
class Bronze:
    """The raw telemetry frames of one schema or directory."""

    traces: DataFrame
    logs: DataFrame
    metrics: DataFrame


def from_catalog(spark: SparkSession, schema: str) -> Bronze:
    """Read the tables of `schema` (one-, two- or three-part name)."""
    return Bronze(
        traces=spark.table(f"{schema}.{v.BRONZE_TRACES}"),
        logs=spark.table(f"{schema}.{v.BRONZE_LOGS}"),
        metrics=spark.table(f"{schema}.{v.BRONZE_METRICS}"),
    )


def from_files(spark: SparkSession, directory: str, file_format: str = "parquet") -> Bronze:
    """Read `<directory>/<table>` for each bronze table."""

    def load(table, schema):
        return spark.read.schema(schema).format(file_format).load(f"{directory}/{table}")

    return Bronze(
        traces=load(v.BRONZE_TRACES, schemas.TRACES),
        logs=load(v.BRONZE_LOGS, schemas.LOGS),
        metrics=load(v.BRONZE_METRICS, schemas.METRICS),
    )
