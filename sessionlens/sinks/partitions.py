"""Exchange of whole partitions that a crash cannot break.

New contents of a partition are written to a folder of their own, and the partition is then
pointed at it: one change in the catalog. So a reader finds the old or the new rows of a
partition, at any moment, and never a half-written one.

Which partitions a change points where is written down first, as a table named after the
changed one. A change that ended before its journal was complete has changed nothing, and
what it wrote is deleted. One that ended later is finished by whoever next calls
`recover`; its steps may be done twice. The former contents stay until the change after, for readers
that have begun on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

VERSIONS = "_versions"
_INTENT, _JOURNAL = "__intent_", "__journal_"
_ROOT, _DONE = "change.root", "change.done"
#: Columns of a journal beside those that name the partition.
_NEW, _OLD = "_new_location", "_old_location"


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def schema_of(name: str) -> str:
    return name.rpartition(".")[0] or "default"


def _location(spark: SparkSession, name: str, spec: str = "") -> str:
    """Where a table, or a partition of it, is stored."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect()
    details = [row["col_name"].startswith("# Detailed") for row in rows].index(True)
    return next(row["data_type"] for row in rows[details:] if row["col_name"] == "Location")


def _spec(row: Row, parts: Sequence[str]) -> str:
    """The partition of a row, as SQL names it."""
    pairs = (f"`{p}` = {'NULL' if row[p] is None else quoted(row[p])}" for p in parts)
    return f"PARTITION ({', '.join(pairs)})"


def _beside(spark: SparkSession, name: str, mark: str) -> list[str]:
    """Tables that belong to changes of `name`."""
    schema, _, table = name.rpartition(".")
    shown = spark.sql(f"SHOW TABLES IN {schema or 'default'} LIKE '{table}{mark}*'").collect()
    prefix = f"{schema}." if schema else ""
    return [f"{prefix}{row['tableName']}" for row in shown]


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((row["value"] for row in rows if row["key"] == key), None)


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exchange(
    contents: DataFrame, touched: DataFrame | None, name: str, file_format: str
) -> None:
    """Make `contents` the rows of the partitions in `touched` (partition columns), or of all.

    A touched partition without contents is dropped. `contents` may read the table, has its
    columns in their order, and no rows of existing partitions that are not touched.
    """
    spark, parts = contents.sparkSession, partition_columns(contents.sparkSession, name)
    if unfinished(spark, name):
        raise RuntimeError(f"recover {name} before it is changed again")
    run = uuid.uuid4().hex
    root = f"{_location(spark, name).rstrip('/')}/{VERSIONS}/{run}"
    intent = f"{name}{_INTENT}{run}"
    spark.sql(
        f"CREATE TABLE {intent} (run STRING) USING parquet"
        f" TBLPROPERTIES ({quoted(_ROOT)} = {quoted(root)})"
    )
    contents.write.format(file_format).partitionBy(*parts).save(root)
    as_text = [F.col(p).cast("string").alias(p) for p in parts]
    found = spark.read.format(file_format).schema(contents.schema).load(root)
    places = _folders(found.select(*as_text, F.col("_metadata.file_path").alias("_file")), parts)
    new = {tuple(place[p] for p in parts): place[_NEW] for place in places.collect()}
    shown = _existing(spark, name)
    held = shown
    if touched is not None:
        held = {tuple(r) for r in touched.select(*as_text).distinct().collect()}
    journal = []
    for key in sorted(held | new.keys(), key=str):
        row = Row(*parts)(*key)
        old = _location(spark, name, _spec(row, parts)) if key in shown else None
        journal.append((*key, unquote(new[key]) if key in new else None, old))
    if journal:
        fields = ", ".join(f"`{c}` string" for c in (*parts, _NEW, _OLD))
        # The journal exists when it is complete: the catalog gets it after its rows.
        written = spark.createDataFrame(journal, fields).coalesce(1)
        written.write.saveAsTable(f"{name}{_JOURNAL}{run}")
    recover(spark, name, keep=run)


def _folders(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Partitions and their folders, from rows with their `_file`; a path is cut once per file."""
    # Counted, as a mere distinct below another one is left out of the plan.
    files = rows.groupBy(*parts, "_file").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
    folder = F.regexp_extract("_file", "^(.*)/", 1).alias(_NEW)
    return files.select(*parts, folder).distinct()


def _existing(spark: SparkSession, name: str) -> set[tuple]:
    """Values of all partitions, as text."""
    found = set()
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = [unquote(pair.partition("=")[2]) for pair in row[0].split("/")]
        found.add(tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values))
    return found


def _finish(spark: SparkSession, name: str, journal: str) -> None:
    """Point all partitions of a journal where it says; harmless when done before.

    New places come first: rows that move from one partition to another are found in
    both for a moment, rather than in none.
    """
    parts = partition_columns(spark, name)
    rows = spark.table(journal).collect()
    for row in sorted(rows, key=lambda row: row[_NEW] is None):
        spec = _spec(row, parts)
        if row[_NEW] is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
        elif row[_OLD] is None:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION {quoted(row[_NEW])}")
        else:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {quoted(row[_NEW])}")
    spark.catalog.refreshTable(name)
    spark.sql(f"ALTER TABLE {journal} SET TBLPROPERTIES ({quoted(_DONE)} = 'true')")


def _forget(spark: SparkSession, journal: str) -> None:
    """Delete the contents that a finished change took the place of, and its journal."""
    for row in spark.table(journal).collect():
        if row[_OLD] is not None and row[_OLD] != row[_NEW]:
            _delete_folder(spark, row[_OLD])
    spark.sql(f"DROP TABLE {journal}")


def unfinished(spark: SparkSession, name: str) -> list[str]:
    """Journals of changes that have been decided but not finished."""
    return [j for j in _beside(spark, name, _JOURNAL) if not _property(spark, j, _DONE)]


def recover(spark: SparkSession, name: str, keep: str | None = None) -> None:
    """Finish the changes of a table whose journal is complete, and undo the others.

    The last finished change keeps its former contents, those of earlier ones go; `keep` names
    the change that has just been made. One writer at a time may change a table.
    """
    journals = {j.rpartition(_JOURNAL)[2]: j for j in _beside(spark, name, _JOURNAL)}
    finished = [run for run, j in journals.items() if _property(spark, j, _DONE)]
    for run, journal in journals.items():
        if run not in finished:
            _finish(spark, name, journal)
    for intent in _beside(spark, name, _INTENT):
        if intent.rpartition(_INTENT)[2] not in journals:
            _delete_folder(spark, _property(spark, intent, _ROOT))
        spark.sql(f"DROP TABLE {intent}")
    if keep is not None or len(finished) < len(journals):
        for run in finished:
            _forget(spark, journals[run])
