"""Exact distinct counts under several conditions by bitmaps: one pass, no copies of rows, merged over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import materialize


def dense_ids(rows: DataFrame, key: str) -> DataFrame:
    """(key, id): a number for each value, dense within each file that is written. It is stored, so numbers stay."""
    return materialize(rows.select(key).where(F.col(key).isNotNull()).distinct().withColumn("id", F.monotonically_increasing_id()), "dense-ids")


def marks(rows: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """(keys, bucket, a bitmap a condition): which ids met each condition. A bucket holds 32,768 ids in 4 KB a condition."""
    position = F.bitmap_bit_position("id")
    return rows.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket")).agg(*[F.bitmap_construct_agg(F.when(c, position)).alias(n) for n, c in conditions.items()])


def running(stored: DataFrame, day: str, names: list[str]) -> DataFrame:
    """For each day the bitmaps of all days up to it. Buckets without a row on a day keep what they had."""
    last = F.broadcast(stored.agg(F.max(day).alias("_last")))  # one row
    first = stored.groupBy("bucket").agg(F.min(day).alias("_first")).join(last, F.lit(True))
    every = first.select("bucket", F.explode(F.sequence("_first", "_last")).alias(day)).join(stored.select(day).distinct(), day, "left_semi")
    upto = Window.partitionBy("bucket").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return every.join(stored, ["bucket", day], "left").select(day, "bucket", *[F.bitmap_or_agg(n).over(upto).alias(n) for n in names])


def counts(stored: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Distinct ids by key and condition: the bits of all buckets."""
    return stored.groupBy(*keys).agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(n) for n in names])
