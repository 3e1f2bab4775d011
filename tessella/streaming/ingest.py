"""Live ingest: at-least-once events, de-duplicated by key, normalized, written with their rollup deltas batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import SPECS
from ..operators.posts import archive_rows, normalize, text_policy
from ..operators.rollups import RollupStore
from ..plans.registry import query
from ..schemas import RAW_EVENT, SEEN_HOURS
from ..sources import tables
from ..sources.tables import with_tables
from ..storage import new_path


def raw_events(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON events of a folder as a stream; the checkpoint is the cursor, files a batch the back-pressure."""
    return spark.readStream.schema(RAW_EVENT).option("maxFilesPerTrigger", files_per_batch).json(path)


def first_seen(events: DataFrame, keys: list[str], hours: int = SEEN_HOURS) -> DataFrame:
    """Drop keys that were seen within the retention, counted from the batch that first held them.

    Marks age by the time of the batch, which its offset log keeps, and not by any time of the events: an event of any age
    passes once. A batch that is run again has the same time and finds the same marks, as these are kept once it is written.
    """
    seen = events.withColumn("_seen_at", F.current_timestamp())
    return seen.withWatermark("_seen_at", f"{hours} hours").dropDuplicatesWithinWatermark(keys).drop("_seen_at")


def start_ingest(events: DataFrame, root: str, checkpoint: str, policy: str = "emoji", once: bool = False) -> StreamingQuery:
    """Write posts, archive and deltas of each batch below `root`. A batch that is run again changes nothing.

    All three are written before one commit makes posts and deltas visible; a batch that broke off before it overwrites what
    it had written. Rollups have no watermark: a late post updates its hour.
    """
    spark = events.sparkSession
    store = RollupStore(spark, f"{root}/rollups")

    def write(batch: DataFrame, batch_id: int) -> None:
        if store.applied(batch_id):
            return
        batch.persist()
        try:
            posts = text_policy(batch.drop("anomalies"), policy)
            posts.write.mode("overwrite").parquet(f"{root}/posts/batch={batch_id}")
            archive_rows(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/archive/batch={batch_id}")
            store.append(posts, batch_id, stored=f"{root}/posts/batch={batch_id}")
        finally:
            batch.unpersist()

    rows = normalize_stream(first_seen(events, ["did", "rkey"]))
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def normalize_stream(events: DataFrame) -> DataFrame:
    return normalize(events)


def run_batches(stream: DataFrame, name: str, write) -> None:
    spark = stream.sparkSession
    stream.writeStream.foreachBatch(write).option("checkpointLocation", new_path(spark, f"{name}-checkpoint")).trigger(availableNow=True).start().awaitTermination()


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream. The pattern lets the table be one file as well as a folder."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


@query("stream_dedupe_counts", "SELECT event_type, count(DISTINCT event_id) AS events, sum(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS even FROM events GROUP BY event_type")
def stream_dedupe_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every event delivered twice, counted once; counts leave as deltas by batch and are summed at read."""
    once = stream_of(spark, sf, "events")
    out = new_path(spark, "stream-dedupe")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("event_type").agg(F.count("*").alias("events"), F.count_if(F.col("event_id") % 2 == 0).alias("even")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_batches(first_seen(once.unionByName(once), ["event_id"]), "dedupe", write)
    return spark.read.parquet(out).groupBy("event_type").agg(F.sum("events").alias("events"), F.sum("even").alias("even"))


@query("stream_rollup_deltas", with_tables("posts", "emojis") + "SELECT hour, emoji, sum(occ)::BIGINT AS occurrences, count(*) AS posts FROM emo GROUP BY hour, emoji")
def stream_rollup_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly rollup from micro-batch deltas: the function of the batch rebuild, applied to each batch."""
    spec, out = SPECS["emoji_hourly"], new_path(spark, "stream-rollup")
    posts = tables.posts_from(stream_of(spark, sf, "documents"))
    run_batches(posts, "rollup", lambda batch, batch_id: spec.select(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))
    return spec.summed(spark.read.parquet(out))


@query("ingest_replay", with_tables("raw") + "SELECT glyph AS emoji, sum(least(runs, 300))::BIGINT AS occurrences, count(*) AS posts, (SELECT count(*) FROM raw) AS stored FROM raw WHERE runs > 0 GROUP BY glyph")
def ingest_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The live path, stopped and started again: half of the events, then all of them, so that one half is replayed and the
    other comes late. Every post is stored and counted once."""
    raw, source, root, checkpoint = tables.raw_events(spark, sf), *(new_path(spark, f"replay-{x}") for x in ("events", "store", "checkpoint"))
    for part in (raw.where("doc_id % 2 = 1"), raw):
        part.withColumn("did", F.concat("did", F.lit("/"), "doc_id")).drop("doc_id").write.mode("append").json(source)
        start_ingest(raw_events(spark, source), root, checkpoint, once=True).awaitTermination()
    stored = spark.read.parquet(f"{root}/posts").agg(F.count("*").alias("stored"))
    return RollupStore(spark, f"{root}/rollups").read("emoji_total").crossJoin(F.broadcast(stored))  # one row


@query("seen_keys", with_tables("raw") + "SELECT did, count(*) AS events, count(*) FILTER (WHERE doc_id % 3 = 1) AS late FROM raw GROUP BY did")
def seen_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Events delivered in three batches that repeat each other, the second with events that are a year older: each once."""
    raw = tables.raw_events(spark, sf).withColumn("rkey", F.concat("rkey", F.lit("/"), "doc_id"))
    raw = raw.withColumn("timeUs", F.when(F.col("doc_id") % 3 == 1, F.col("timeUs") - 365 * 86_400_000_000).otherwise(F.col("timeUs"))).withColumn("late", F.col("doc_id") % 3 == 1)
    source, out, checkpoint = (new_path(spark, f"seen-{x}") for x in ("events", "once", "checkpoint"))
    rows = raw.select("did", "rkey", "timeUs", "late")
    for part in (rows.where(F.col("rkey").like("%0") | ~F.col("late")), rows.where("late"), rows):
        part.write.mode("append").parquet(source)
        once = first_seen(spark.readStream.schema(rows.schema).parquet(source), ["did", "rkey"])
        writer = once.writeStream.foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/batch={k}"))
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("did").agg(F.count("*").alias("events"), F.count_if("late").alias("late"))
