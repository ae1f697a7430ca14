"""Session settings and the shared folder a job may write to."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Everything here is a hint for the optimizer; results do not depend on it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Buckets of one sorted file each need no sort (sources.stored).
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Do not record a Python call site for every column of a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


TASK_BYTES = 192 * 1024 * 1024  # shuffled bytes that one task should take


def partitions_for(shuffled_bytes: int) -> int:
    """Shuffle partitions so that one fits in a task's memory.  The default of
    200 would mean half a terabyte per task at 100 TB; too many do no harm, as
    small neighbours are put together at run time."""
    return max(200, -(-shuffled_bytes // TASK_BYTES))


def get_session(
    app_name: str = "meterframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Build a session.  On a cluster leave ``master`` to the submit
    configuration and size the shuffle with ``partitions_for``; tests pass
    ``local[n]`` and a small number."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, whose tasks share the driver's disk, may leave it
    unnamed: it gets a folder of its own, removed when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    master = spark.sparkContext.master
    if not re.match(r"local($|\[)", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    own = tempfile.mkdtemp(prefix="meterframe-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir() or own


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in any file system that Spark reads."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Let a written folder take the place of another, if there is one.  The
    other is moved aside first, and goes when the new one stands."""
    files, place = _file_system(spark, path)
    _, ready = _file_system(spark, new)
    _, aside = _file_system(spark, f"{new}-old")
    before = files.exists(place)
    if before and not files.rename(place, aside):
        raise OSError(f"{path} could not be moved aside")
    if not files.rename(ready, place):
        if before:
            files.rename(aside, place)
        raise OSError(f"{new} could not be moved to {path}")
    if before:
        files.delete(aside, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it is there; whether it was created."""
    files, place = _file_system(spark, path)
    if files.exists(place):
        return False
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "kept") -> DataFrame:
    """Write to the shared folder and read back: worked out once, and not lost
    with an executor.  (``checkpoint()`` would work it out twice.)"""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
