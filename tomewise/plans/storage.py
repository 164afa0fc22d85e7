"""Intermediate tables that outlive executors, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast is held once on the driver and once per executor.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

# Where the tables of the job at hand are stored; outside of a job, the scratch folder itself.
_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)

# Scratch folders of local sessions; they are removed when the program ends.
_LOCAL: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, the one that holds the checkpoints.

    On a cluster it must be set, since a folder of one machine is lost to the
    others; a local session without it gets a temporary folder that lasts as long
    as the program. The session's settings stay as they are.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.TemporaryDirectory(prefix="tomewise-")
    return _LOCAL[context.applicationId].name


@contextmanager
def stored_tables(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Tables stored inside of the block lie in a folder of their own, which is removed at its end.

    The folder is a new one below ``folder``, or below the scratch folder. Results
    that read stored tables must be written inside of the block.
    """
    path = f"{folder or scratch_dir(spark)}/job-{uuid.uuid4().hex}"
    outer = _JOB_FOLDER.set(path)
    try:
        yield path
    finally:
        _JOB_FOLDER.reset(outer)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    For tables that several branches read: each branch then prunes columns and
    pushes filters on its own, the work before runs once, and a lost executor
    costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{_JOB_FOLDER.get() or scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if its input has fewer splits than there are cores, else as it is.

    For what one pass over a few large splits yields, where further steps follow; an input with enough splits is not
    shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_broadcast(df: DataFrame, text_column: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table of one string column and a few numbers is small enough."""
    size = df.agg(
        F.sum(F.octet_length(text_column) + F.lit(ROW_OVERHEAD_BYTES)).alias("bytes")
    ).head()["bytes"]
    return (size or 0) <= limit


def few_rows(df: DataFrame) -> DataFrame:
    """A stored table of a few short columns: marked for broadcast if its number of rows allows, else as it is."""
    return F.broadcast(df) if df.count() * ROW_OVERHEAD_BYTES <= BROADCAST_BYTES else df
