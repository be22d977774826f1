"""Writing tables: creation, whole-table publication, appends, upserts.

Formats with row-level operations get MERGE. For plain files the new contents of a
partition are written beside the old ones and take their place by one change in the
catalog (see `partitions`); a table without partitions is written anew and exchanges names
with the old one, which leaves a moment without the table. `recover` finishes or undoes
what a run that ended in between has left.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlens.operators import changes
from sessionlens.sinks import partitions
from sessionlens.sinks.partitions import partition_columns, quoted, schema_of

DEFAULT_FORMAT = "parquet"
ROW_LEVEL_FORMATS = ("delta", "iceberg")


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    file_format: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
) -> None:
    """Create the table with a fixed schema and layout unless it is there."""
    recover(spark, name)
    if not exists(spark, name):
        empty = spark.createDataFrame([], schema)
        empty.write.format(file_format).partitionBy(*partition_by).saveAsTable(name)


def ensure_table_like(
    name: str,
    frame: DataFrame,
    file_format: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
) -> None:
    """Create the table with the schema of `frame` unless it is there."""
    ensure_table(frame.sparkSession, name, frame.schema, file_format, partition_by)


def table_format(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    rows = described.filter(F.col("col_name") == "Provider").select("data_type").take(1)
    return rows[0][0].lower() if rows else ""


def has_row_level_operations(spark: SparkSession, name: str) -> bool:
    return table_format(spark, name) in ROW_LEVEL_FORMATS


class Staging:
    """Intermediate results as Parquet tables of a schema, dropped at the end.

    A table of the target's own schema lies where all executors can read it, and
    keeps column pruning and statistics.
    """

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.names = spark, schema, []

    def __enter__(self) -> Staging:
        return self

    def keep(self, frame: DataFrame) -> DataFrame:
        """Compute `frame` once and read it back."""
        name = f"{self.schema}.staged_{uuid.uuid4().hex}"
        self.names.append(name)
        frame.write.format(DEFAULT_FORMAT).saveAsTable(name)
        return self.spark.table(name)

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    own = {row["key"]: row["value"] for row in rows}
    return {k: v for k, v in own.items() if not k.startswith(("spark.sql.", "transient_"))}


def _rename(spark: SparkSession, name: str, new_name: str) -> None:
    # The new name is relative to the catalog of the table.
    relative = ".".join(new_name.split(".")[-2:])
    spark.sql(f"ALTER TABLE {name} RENAME TO {relative}")


def recover(spark: SparkSession, name: str) -> None:
    """Undo a publication that ended between its two renames; finish or undo the changes
    of partitions that ended early."""
    previous = f"{name}__previous"
    if not exists(spark, name) and exists(spark, previous):
        _rename(spark, previous, name)
    if exists(spark, name) and partition_columns(spark, name):
        partitions.recover(spark, name)


def publish(
    frame: DataFrame,
    name: str,
    file_format: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
) -> None:
    """Make `frame`, which may read the table, its new contents.

    A table that exists keeps its format, partitioning and properties; the other
    arguments are for a new one.
    """
    spark = frame.sparkSession
    if not exists(spark, name):
        frame.write.format(file_format).partitionBy(*partition_by).saveAsTable(name)
    elif partition_columns(spark, name):
        evolve(frame, name)
        exchange_partitions(frame, None, name)
    else:
        _exchange(frame, name)


def _exchange(frame: DataFrame, name: str) -> None:
    """Write the new contents beside the table, then exchange the names."""
    spark = frame.sparkSession
    staged, previous = f"{name}__next", f"{name}__previous"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    frame.write.format(table_format(spark, name)).saveAsTable(staged)
    if properties := _properties(spark, name):
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ({pairs})")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    _rename(spark, name, previous)
    _rename(spark, staged, name)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def evolve(frame: DataFrame, name: str) -> None:
    """Add the columns of `frame` that the table does not have."""
    spark = frame.sparkSession
    known = set(spark.table(name).columns)
    new = [f for f in frame.schema if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def _in_order(frame: DataFrame, name: str) -> DataFrame:
    """`frame` with the columns of the table, in its order; others become NULL."""
    columns = [
        (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in frame.sparkSession.table(name).schema
    ]
    return frame.select(*columns)


def append(frame: DataFrame, name: str) -> None:
    """Add rows; the table gains new columns, those that `frame` lacks become NULL."""
    evolve(frame, name)
    _in_order(frame, name).write.insertInto(name)


def upsert(frame: DataFrame, name: str, keys: list[str]) -> None:
    """MERGE by key: matching rows are replaced, others added.

    `frame` is read for the check and for the merge, so pass it materialized.
    """
    spark = frame.sparkSession
    source = changes.with_keys(frame, keys)
    changes.require_unique(source, keys)
    if has_row_level_operations(spark, name):
        merge_rows(source, name, keys)
    elif partition_columns(spark, name):
        _replace_in_partitions(source, name, keys, None)
    else:
        publish(changes.upsert(spark.table(name), source, keys), name)


def merge_rows(frame: DataFrame, name: str, keys: list[str]) -> None:
    """MERGE of the storage format: update all matching rows, insert the others."""
    on = [F.col(f"{name.split('.')[-1]}.{key}") == F.col(f"source.{key}") for key in keys]
    condition = on[0]
    for more in on[1:]:
        condition = condition & more
    (
        frame.alias("source")
        .mergeInto(name, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def replace(
    frame: DataFrame,
    name: str,
    keys: list[str],
    touched: DataFrame | None = None,
    within: Callable[[DataFrame], Column] | None = None,
) -> None:
    """Exchange all rows of the touched keys for those of `frame`.

    `within` is called with the new rows, before anything is changed, and returns a condition
    on partition columns that all stored rows of the touched keys and all new rows
    fulfil, so that no other partition is read.
    """
    spark = frame.sparkSession
    if has_row_level_operations(spark, name):
        replace_rows(frame, frame if touched is None else touched, name, keys)
    elif partition_columns(spark, name):
        _replace_in_partitions(frame, name, keys, touched, within)
    else:
        if within is not None:
            within(frame)
        publish(changes.replace_by_key(spark.table(name), frame, keys, touched), name)


def _replace_in_partitions(
    frame: DataFrame,
    name: str,
    keys: list[str],
    touched: DataFrame | None,
    within: Callable[[DataFrame], Column] | None = None,
) -> None:
    """Rewrite only the partitions in which touched keys have or get rows."""
    spark, parts = frame.sparkSession, partition_columns(frame.sparkSession, name)
    recover(spark, name)
    with Staging(spark, schema_of(name)) as staging:
        rows = staging.keep(changes.with_keys(frame, keys))
        gone = staging.keep((rows if touched is None else touched).select(*keys).distinct())
        evolve(rows, name)
        target = spark.table(name)
        if within is not None:
            target = target.filter(within(rows))
        hit = staging.keep(partitions_hit(target, rows, gone, keys, parts))
        inside = target.alias("t").join(hit.alias("h"), _same(parts, "t", "h"), "left_semi")
        exchange_partitions(changes.replace_by_key(inside, rows, keys, gone), hit, name)


def exchange_partitions(contents: DataFrame, touched: DataFrame | None, name: str) -> None:
    """Make `contents` the rows of the touched partitions of a table, or of all."""
    spark = contents.sparkSession
    partitions.exchange(_in_order(contents, name), touched, name, table_format(spark, name))


def partitions_hit(
    target: DataFrame, rows: DataFrame, gone: DataFrame, keys: list[str], parts: list[str]
) -> DataFrame:
    """The partitions of `target` that hold keys of `gone`, and those of the new rows."""
    held = target.join(gone, keys, "left_semi").select(*parts)
    return held.unionByName(rows.select(*parts)).distinct()


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    equal = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return functools.reduce(lambda a, b: a & b, equal)


def replace_rows(frame: DataFrame, touched: DataFrame, name: str, keys: list[str]) -> None:
    """One MERGE of the storage format: rows of the touched keys go, those of `frame` come.

    A source row either names a key whose rows are deleted, or is a new row, whose
    key matches nothing; so no reader and no crash sees the one without the other.
    """
    target = name.split(".")[-1]
    rows = changes.with_keys(frame, keys)
    named = [F.col(key).alias(f"_gone_{key}") for key in keys]
    source = touched.select(*named).distinct().unionByName(rows, allowMissingColumns=True)
    on = [F.col(f"{target}.{key}") == F.col(f"source._gone_{key}") for key in keys]
    is_row = F.col(f"source._gone_{keys[0]}").isNull()
    (
        source.alias("source")
        .mergeInto(name, functools.reduce(lambda a, b: a & b, on))
        .whenMatched()
        .delete()
        .whenNotMatched(is_row)
        .insert({c: F.col(f"source.{c}") for c in rows.columns})
        .withSchemaEvolution()
        .merge()
    )
