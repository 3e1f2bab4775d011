"""Stored tables with a folder for each value of their keys: replaced, deleted and expired by folder, read with pruning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import discard, hadoop, materialize

#: Fixed value: the name of the folder of a null key.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder(spark: SparkSession, path: str, values: dict[str, object]) -> str:
    """Where the rows of these key values lie."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([path.rstrip("/"), *[f"{k}={NO_VALUE if v is None or v == '' else escape(str(v))}" for k, v in values.items()]])


def put(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write rows in place of those of the same key values; other folders stay as they are.

    Rows are dealt to tasks by key and a salt of their number, so that a large key is written by many tasks.
    """
    df.hint("rebalance", *keys).write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def delete(spark: SparkSession, path: str, values: dict[str, object]) -> bool:
    """Drop the rows of these key values; whether there were any."""
    p, fs = hadoop(spark, folder(spark, path, values))
    return bool(fs.exists(p) and fs.delete(p, True))


def replace(df: DataFrame, path: str, values: dict[str, object]) -> None:
    """Rows of one run, written again: what they replace goes even if nothing comes in its place."""
    spark = df.sparkSession
    rows = materialize(df, "replacement")  # it may read what it replaces
    if rows.isEmpty():
        delete(spark, path, values)
    else:
        put(rows.withColumns({k: F.lit(v) for k, v in values.items()}), path, list(values))
    discard(rows)


def expire(spark: SparkSession, path: str, time: str, cutoff: dt.datetime, day: str = "day") -> int:
    """Drop rows before the cutoff from a table by day: whole days by folder, the day of the cutoff by rows. The number of folders."""
    p, fs = hadoop(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    days = [n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}=") and not n.endswith(NO_VALUE)]
    gone = [d for d in days if d < cutoff.date().isoformat()]
    for d in gone:
        delete(spark, path, {day: d})
    if cutoff.date().isoformat() in days:
        own = spark.read.parquet(path).where((F.col(day) == F.lit(cutoff.date())) & (F.col(time) >= F.lit(cutoff).cast("timestamp_ntz"))).drop(day)
        replace(own, path, {day: cutoff.date()})
    return len(gone)
