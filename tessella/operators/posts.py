"""The posts table: normalization of raw events, last write wins, text policy, archive projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.glyphs import extract_emojis, normalize_emoji
from ..functions.scalars import micros_ntz, normalize_langs, resolve_created_at
from ..schemas import EMOJI_CAP, EXTRAS


def normalize(events: DataFrame, src: str = "live", cap: int = EMOJI_CAP) -> DataFrame:
    """Posts rows, with `anomalies`, from raw events (did, rkey, text, langs, createdAt, timeUs)."""
    received = micros_ntz(F.col("timeUs"))
    time, anomaly = resolve_created_at(F.col("createdAt"), F.col("rkey"), received)
    out = events.withColumn("_emojis", F.transform(extract_emojis(F.col("text")), normalize_emoji))
    cut = F.when(F.size("_emojis") > cap, F.lit("emoji-truncated"))
    return out.select(
        "did", "rkey", F.date_trunc("second", time).cast("timestamp_ntz").alias("created_at"), F.coalesce("text", F.lit("")).alias("text"),
        normalize_langs(F.col("langs")).alias("langs"), F.slice("_emojis", 1, cap).alias("emojis"), F.lit(src).alias("src"), received.alias("ingested_at"),
        F.array_compact(F.array(anomaly, cut)).alias("anomalies"),
    )


def last_wins(df: DataFrame, keys: list[str], version: str, ties: list[str] | None = None) -> DataFrame:
    """The latest row of each key: by version, then by `ties` (all other columns by default), all descending."""
    rest = ties if ties is not None else [c for c in df.columns if c not in (*keys, version)]
    order = Window.partitionBy(*keys).orderBy(F.col(version).desc(), *[F.col(c).desc() for c in rest])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def posts_final(posts: DataFrame) -> DataFrame:
    return last_wins(posts, ["did", "rkey"], "ingested_at", ["src", "created_at", "text", "langs", "emojis"])


def text_policy(posts: DataFrame, policy: str = "emoji") -> DataFrame:
    """Policy emoji keeps the text of posts with an emoji only; policy all keeps every text."""
    if policy == "all":
        return posts
    return posts.withColumn("text", F.when(F.size("emojis") > 0, F.col("text")).otherwise(""))


def archive_rows(posts: DataFrame, extras: str | None = None) -> DataFrame:
    """Archive columns. With a struct or map column `extras`, absent parts are ''; without one the four columns are null."""
    raw = [F.coalesce(F.to_json(F.col(f"{extras}.{c}")) if dict(posts.dtypes)[extras].startswith("struct") else F.col(extras)[c], F.lit("")).alias(c) if extras else F.lit(None).cast("string").alias(c) for c in EXTRAS]
    return posts.select("did", "rkey", "created_at", "text", "langs", "emojis", "src", *raw)
