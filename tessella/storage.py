"""Where intermediate and derived tables are written."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Session, path and thread of each table on disk.
_written: list[tuple[SparkSession, str, int]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. It is the session's; a temporary one only where all run on this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path, threading.get_ident()))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends at files that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing will read again: what was made of them is written down itself."""
    for df in tables:
        spark = df.sparkSession
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            p, fs = hadoop(spark, path)
            fs.delete(p, True)


def mark() -> int:
    """A point to which discard_since goes back."""
    return len(_written)


def discard_since(point: int, *kept: DataFrame) -> None:
    """Delete what this thread has written since a point, but for the tables that are named."""
    names = {file.rsplit("/", 2)[-2] for df in kept for file in df.inputFiles()}
    for spark, path, thread in _written[point:]:
        if thread == threading.get_ident() and path.rsplit("/", 1)[-1] not in names:
            p, fs = hadoop(spark, path)
            fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Have shuffle files deleted that nothing refers to any more; Spark sees to it when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is written, for nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def hadoop(spark: SparkSession, path: str):
    """The path as Hadoop knows it, and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@atexit.register
def _drop_written() -> None:
    for spark, path, _ in _written:
        try:
            p, fs = hadoop(spark, path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001 - the session is gone, its scheduler clears the folder
            return
