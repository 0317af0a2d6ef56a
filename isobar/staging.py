"""Written intermediate tables on the cluster's shared folder.

A staged table cuts lineage the way a reliable checkpoint does, but in a
columnar format, so later reads of a few columns stay cheap and a lost
executor only re-reads its files.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one in local mode if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="isobar-"))  # the setting itself is fixed once a session runs
    return spark.sparkContext.getCheckpointDir()


def session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/isobar/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written files.

    Shuffle files of the write go at once: later reads take the written table.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    _PATHS[written] = path
    return written


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def apart(staged: DataFrame, session: SparkSession | None = None) -> DataFrame:
    """A frame that ``stage`` returned, read in ``session``, or else in one of its own.

    Spark's training summaries hold on to their session and travel with the
    model; a session that has observed rows (``DataFrame.observe``) cannot be
    serialized, a fresh one can.
    """
    return (session or staged.sparkSession.newSession()).read.schema(staged.schema).parquet(_PATHS[staged])


def discard(staged: DataFrame) -> None:
    """Delete the files of a frame that ``stage`` returned, once all that reads it has been written."""
    if path := _PATHS.pop(staged, None):
        remove(staged.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    remove(spark, session_folder(spark))
