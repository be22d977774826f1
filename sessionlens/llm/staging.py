"""Intermediate tables in the folder that driver and executors share.

A staged table cuts lineage without being lost together with an executor, and keeps
column pruning and statistics. The folder is that of ``spark.checkpoint.dir``; only a
session on one machine (a test) that does not name one gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="sessionlens-llm-")
    return _own_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written once to the shared folder, as a scan of the written files."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes the files of a staged table that nothing reads any more."""
    spark = frame.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
