"""Which bronze files have been processed, and which sessions they hold.

Bronze tables only grow, by files. The ledger has a row (source, file, session) for every file
that a run has processed and every session in it. New files are those that are not in the ledger,
whatever the times of their records, so late records count like all others. The whole
rows of a session are in its files of the ledger and in the new ones.

Files are looked for by the time of their last change: a run looks back `margin` behind the
newest file it knows, as a writer may publish a file some time after writing it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.functions.attributes import SESSION_KEY, attr
from sessionlens.sinks import tables
from sessionlens.sources.bronze import Bronze

SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
    ]
)
MARGIN = "INTERVAL 1 DAY"
#: With more files than this a scan is bounded by their times instead of their names.
LISTED_FILES = 10_000
_PATH = {"traces": "attributes", "logs": "attributes", "metrics": "sum.attributes"}


def session_of(source: str) -> Column:
    return attr(SESSION_KEY, _PATH[source])


def new_files(
    frame: DataFrame, source: str, ledger: DataFrame, margin: str = MARGIN
) -> DataFrame:
    """(file, changed_at) of the files of `frame` that the ledger does not know."""
    known = ledger.filter(F.col("source") == source)
    newest = known.agg(F.max("changed_at")).first()[0]
    files = frame
    if newest is not None:
        changed = F.col("_metadata.file_modification_time")
        files = frame.filter(changed >= F.lit(newest) - F.expr(margin))
    # No column of the records is read.
    found = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("changed_at"),
    ).distinct()
    return found.join(known.select("file").distinct(), "file", "left_anti")


def in_files(frame: DataFrame, files: DataFrame, *columns: Column) -> DataFrame:
    """`columns` (all by default) of the rows of `frame` that lie in `files` (file, changed_at).

    Other files are not read, or, if very many are wanted, none that changed earlier or later.
    """
    chosen = columns or tuple(F.col(c) for c in frame.columns)
    if files.isEmpty():
        return frame.filter(F.lit(False)).select(*chosen)
    listed = files.select("file").distinct().limit(LISTED_FILES + 1).collect()
    if len(listed) <= LISTED_FILES:
        named = F.col("_metadata.file_path").isin([row["file"] for row in listed])
        return frame.filter(named).select(*chosen)
    low, high = files.agg(F.min("changed_at"), F.max("changed_at")).first()
    times = F.col("_metadata.file_modification_time").between(F.lit(low), F.lit(high))
    rows = frame.filter(times).select(*chosen, F.col("_metadata.file_path").alias("_in_file"))
    wanted = files.select(F.col("file").alias("_in_file")).distinct()
    return rows.join(wanted, "_in_file", "left_semi").drop("_in_file")


class Update:
    """What has come into the bronze tables since the ledger was last written.

    `touched` has the sessions with new rows, `raw` the whole rows of these sessions, old and
    new. `finish` writes the ledger; a run that ends before is done again.
    """

    def __init__(
        self, raw: Bronze, name: str, staging: tables.Staging, margin: str = MARGIN
    ):
        spark = raw.logs.sparkSession
        self.name = name
        tables.ensure_table(spark, name, SCHEMA)
        ledger = spark.table(name)
        frames = {"traces": raw.traces, "logs": raw.logs, "metrics": raw.metrics}
        arrived = [
            self._sessions(frame, source, staging.keep(new_files(frame, source, ledger, margin)))
            for source, frame in frames.items()
        ]
        self.arrived = staging.keep(arrived[0].unionByName(arrived[1]).unionByName(arrived[2]))
        sessions = self.arrived.select("session_id").filter(F.col("session_id").isNotNull())
        self.touched = staging.keep(sessions.distinct())
        entries = ledger.unionByName(self.arrived).join(self.touched, "session_id", "left_semi")
        self.entries = staging.keep(entries.select("source", "file", "changed_at").distinct())
        self.raw = Bronze(**{s: self._rows(frame, s) for s, frame in frames.items()})

    def _sessions(self, frame: DataFrame, source: str, files: DataFrame) -> DataFrame:
        """Ledger entries of new files; a file without sessions has one without session."""
        path = F.col("_metadata.file_path").alias("file")
        held = in_files(frame, files, path, session_of(source).alias("session_id"))
        pairs = held.filter(F.col("session_id").isNotNull()).distinct()
        return files.join(pairs, "file", "left").select(
            F.lit(source).alias("source"), "file", "changed_at", "session_id"
        )

    def _rows(self, frame: DataFrame, source: str) -> DataFrame:
        files = self.entries.filter(F.col("source") == source)
        rows = in_files(frame, files).withColumn("_session", session_of(source))
        touched = self.touched.select(F.col("session_id").alias("_session"))
        return rows.join(touched, "_session", "left_semi").drop("_session")

    def is_empty(self) -> bool:
        return self.arrived.isEmpty()

    def finish(self) -> None:
        tables.append(self.arrived, self.name)
