"""Additive rollups: one definition each, for whole rebuilds and for micro-batches alike."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hour_of


def _emojis(posts: DataFrame, *keys: Column) -> DataFrame:
    """A row for each distinct emoji of a post, with its count in the post: narrow, no shuffle."""
    counted = F.transform(F.array_distinct("emojis"), lambda e: F.struct(e.alias("emoji"), F.size(F.filter("emojis", lambda x: x == e)).cast("long").alias("occ")))
    return posts.where(F.size("emojis") > 0).select(*keys, F.explode(counted).alias("e")).select("*", "e.emoji", "e.occ").drop("e")



def _by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("occ").alias("occurrences"), F.count("*").alias("posts"))


def emoji_hourly(posts: DataFrame) -> DataFrame:
    return _by(_emojis(posts, hour_of(F.col("created_at")).alias("hour")), "hour", "emoji")


def emoji_hourly_by_lang(posts: DataFrame) -> DataFrame:
    rows = _emojis(posts, hour_of(F.col("created_at")).alias("hour"), F.col("langs"))
    return _by(rows.withColumn("lang", F.explode("langs")), "lang", "hour", "emoji")


def posts_hourly(posts: DataFrame) -> DataFrame:
    return posts.groupBy(hour_of(F.col("created_at")).alias("hour")).agg(
        F.count("*").alias("posts"), F.count_if(F.size("emojis") > 0).alias("posts_with_emojis"), F.sum(F.size("emojis").cast("long")).alias("emoji_occurrences")
    )


def emoji_total(posts: DataFrame) -> DataFrame:
    return _by(_emojis(posts), "emoji")


def emoji_total_by_lang(posts: DataFrame) -> DataFrame:
    return _by(_emojis(posts, F.col("langs")).withColumn("lang", F.explode("langs")), "lang", "emoji")


def lang_total(posts: DataFrame) -> DataFrame:
    rows = posts.where(F.size("emojis") > 0).select(F.explode("langs").alias("lang"), F.size("emojis").cast("long").alias("occ"))
    return _by(rows, "lang")


def live_ingest_second(posts: DataFrame) -> DataFrame:
    second = F.date_trunc("second", F.col("ingested_at")).cast("timestamp_ntz").alias("second")
    return posts.where(F.col("src") == "live").groupBy(second).agg(F.count("*").alias("posts"))


@dataclass(frozen=True)
class Spec:
    """A rollup: its function, keys and measures; `time` is the column by which it can be repaired in part."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    measures: tuple[str, ...] = ("occurrences", "posts")
    time: str | None = None

    def select(self, posts: DataFrame, where: Column | None = None) -> DataFrame:
        return self.build(posts if where is None else posts.where(where))

    def summed(self, deltas: DataFrame) -> DataFrame:
        """Deltas are always read as sums."""
        return deltas.groupBy(*self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])

    def version(self) -> str:
        """Changes with the definition, so that a stored table's drift shows."""
        code = self.build.__code__
        return hashlib.sha256(repr((self.name, self.keys, self.measures, code.co_code, code.co_consts)).encode()).hexdigest()[:16]


SPECS = {
    s.name: s
    for s in (
        Spec("emoji_hourly", emoji_hourly, ("hour", "emoji"), time="hour"),
        Spec("emoji_hourly_by_lang", emoji_hourly_by_lang, ("lang", "hour", "emoji"), time="hour"),
        Spec("posts_hourly", posts_hourly, ("hour",), ("posts", "posts_with_emojis", "emoji_occurrences"), time="hour"),
        Spec("emoji_total", emoji_total, ("emoji",)),
        Spec("emoji_total_by_lang", emoji_total_by_lang, ("lang", "emoji")),
        Spec("lang_total", lang_total, ("lang",)),
        Spec("live_ingest_second", live_ingest_second, ("second",), ("posts",), time="second"),
    )
}
