"""State per host: hard-failure streaks by associative summaries of slices, for a whole table and for micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..functions.scalars import deadness
from ..plans.registry import query
from ..sources import tables
from ..sources.tables import with_tables
from ..storage import discard_since, mark, materialize, new_path

#: Failures in a row and seconds they must span before a host is given up; silent hosts need fewer but longer.
TRIP, TRIP_STALL = (30, 30), (6, 120)


def outcomes(events: DataFrame) -> DataFrame:
    """(host, ts, kind): ok for a success or any HTTP answer, a kind of hard failure, else nothing: such rows prove nothing."""
    kind = F.when(F.col("event").isin("loaded", "empty"), "ok").otherwise(F.coalesce(deadness(F.col("error")), F.when(F.col("error").rlike(r"http \d{3}\b"), "ok")))
    return events.select(F.col("pds_host").alias("host"), "ts", "event_id", kind.alias("kind")).where("kind is not null")


#: Rows of a slice; a host of any size is cut into slices along its time.
SLICE_ROWS = 100_000


def runs(rows: DataFrame, slices: int | None = None) -> DataFrame:
    """(host, slice, ts, event_id, kind, island, n, first): outcomes in slices of like size, each row with its place in its run.

    A run is a stretch of one kind within a slice; every success is one of its own.
    """
    count = slices or rows.count() // SLICE_ROWS + 1
    placed = rows.repartitionByRange(count, "host", "ts", "event_id").withColumn("slice", F.spark_partition_id().cast("long"))
    placed = materialize(placed, "host-slices")
    by = Window.partitionBy("slice", "host").orderBy("ts", "event_id")
    fresh = (F.coalesce(F.lag("kind").over(by) != F.col("kind"), F.lit(True)) | (F.col("kind") == "ok")).cast("int")
    placed = placed.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("slice", "host", "island").orderBy("ts", "event_id")
    placed = placed.withColumns({"n": F.row_number().over(own).cast("long"), "first": F.first("ts").over(own)})
    return materialize(placed.select("host", "slice", "ts", "event_id", "kind", "island", "n", "first"), "host-runs")


def _trips(kind: Column, n: Column, first: Column, last: Column, trip: tuple[int, int], stall: tuple[int, int]) -> Column:
    own = lambda k: F.when(kind == "stall", stall[k]).otherwise(trip[k])
    return (kind != "ok") & (n >= own(0)) & (F.timestamp_diff("SECOND", first, last) >= own(1))


def summaries(found: DataFrame, trip: tuple[int, int], stall: tuple[int, int]) -> DataFrame:
    """A row for each host and slice: the run at its head, the run at its tail, whether both are one, the first trip between.

    Only the run at the head can go on from the slice before, so all other trips are known from the slice alone.
    """
    order, head = F.struct("ts", "event_id"), F.col("island") == 1
    inner = ~head & _trips(F.col("kind"), F.col("n"), F.col("first"), F.col("ts"), trip, stall)
    return found.groupBy("host", "slice").agg(
        F.min_by("kind", order).alias("head_kind"), F.count_if(head).alias("head_n"), F.min("ts").alias("head_first"), F.max(F.when(head, F.col("ts"))).alias("head_last"),
        F.max_by("kind", order).alias("tail_kind"), F.max_by("n", order).alias("tail_n"), F.max_by("first", order).alias("tail_first"),
        (F.max("island") == 1).alias("whole"), F.min(F.when(inner, F.struct("ts", "event_id", "kind", "n"))).alias("inner"),
    )


def stitched(parts: DataFrame, trip: tuple[int, int], stall: tuple[int, int]) -> DataFrame:
    """Summaries with the run that reaches each slice from before (held_n, held_first), whether the slice's head trips on it,
    and the run that leaves it (run_n, run_first). The window sees a row a slice."""
    by = Window.partitionBy("host").orderBy("slice")
    on = F.coalesce((F.lag("tail_kind").over(by) == F.col("head_kind")) & (F.col("head_kind") != "ok"), F.lit(False))
    parts = parts.withColumn("on", on).withColumn("chain", F.sum((~(F.col("on") & F.col("whole"))).cast("int")).over(by))
    within = Window.partitionBy("host", "chain").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumns({"run_n": F.sum("tail_n").over(within), "run_first": F.first("tail_first").over(within)})
    # what joins a slice at its head and goes on beyond it counts from the chain; a head that ends inside starts from what is held
    parts = parts.withColumns({"held_n": F.when(F.col("on"), F.lag("run_n").over(by)).otherwise(0), "held_first": F.when(F.col("on"), F.lag("run_first").over(by)).otherwise(F.col("head_first"))})
    return parts.withColumn("at_head", _trips(F.col("head_kind"), F.col("held_n") + F.col("head_n"), F.col("held_first"), F.col("head_last"), trip, stall))


def first_trips(found: DataFrame, joined: DataFrame, trip: tuple[int, int], stall: tuple[int, int]) -> DataFrame:
    """(host, kind, tripped_at, failures) from runs and stitched summaries: one slice a host is looked at again, at most."""
    where = joined.where("at_head or inner is not null")
    one = where.groupBy("host").agg(F.min_by(F.struct("slice", "at_head", "held_n", "held_first", "inner"), "slice").alias("_at")).select("host", "_at.*")
    inner = one.where("not at_head").select("host", "inner.kind", F.col("inner.ts").alias("tripped_at"), F.col("inner.n").alias("failures"))
    heads = found.where("island = 1").join(one.where("at_head").select("host", "slice", "held_n", "held_first"), ["host", "slice"])
    heads = heads.where(_trips(F.col("kind"), F.col("held_n") + F.col("n"), F.col("held_first"), F.col("ts"), trip, stall))
    order = F.struct("ts", "event_id")
    heads = heads.groupBy("host").agg(F.min_by("kind", order).alias("kind"), F.min("ts").alias("tripped_at"), F.min(F.col("held_n") + F.col("n")).alias("failures"))
    return inner.unionByName(heads)


def trips(rows: DataFrame, trip: tuple[int, int] = TRIP, stall: tuple[int, int] = TRIP_STALL, slices: int | None = None) -> DataFrame:
    """(host, kind, tripped_at, failures): where each host is first given up. A success or another kind starts anew.

    A host's outcomes are cut into slices, slices are summed up on their own, and a row a slice is stitched by host.
    """
    found = runs(rows, slices)
    return first_trips(found, stitched(summaries(found, trip, stall), trip, stall), trip, stall)


_STREAKS = with_tables("events") + r""", k AS (SELECT pds_host AS host, ts, event_id, CASE WHEN event IN ('loaded', 'empty') THEN 'ok' WHEN contains(error, 'ENOTFOUND') THEN 'dns' WHEN regexp_matches(error, 'http 451\b') THEN 'legal' WHEN contains(error, 'stalled:') THEN 'stall' WHEN regexp_matches(error, 'http [0-9]{3}\b') THEN 'ok' END AS kind FROM ev),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY host ORDER BY ts, event_id) AS island FROM (SELECT *, (coalesce(lag(kind) OVER (PARTITION BY host ORDER BY ts, event_id) <> kind, true) OR kind = 'ok')::INT AS fresh FROM k WHERE kind IS NOT NULL)),
n AS (SELECT *, row_number() OVER w AS n, first_value(ts) OVER w AS first FROM i WINDOW w AS (PARTITION BY host, island ORDER BY ts, event_id)),
h AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY ts, event_id) AS r FROM n WHERE kind <> 'ok' AND n >= 3 AND date_diff('second', first, ts) >= 600)
SELECT host, kind, ts AS tripped_at, n AS failures FROM h WHERE r = 1"""


@query("host_trips", _STREAKS)
def host_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds fit for sparse events: three failures over ten minutes."""
    return trips(outcomes(tables.repo_events(spark, sf)), (3, 600), (3, 600))


def streak_step(state: tuple, kind: str, at: float, trip: tuple[int, int] = TRIP, stall: tuple[int, int] = TRIP_STALL) -> tuple:
    """(kind, failures, first, dead) after one outcome. Once dead, always dead."""
    own, n, first, dead = state
    if dead:
        return state
    if kind == "ok":
        return ("", 0, 0.0, False)
    own, n, first = (kind, n + 1, first) if own == kind else (kind, 1, at)
    most, span = stall if kind == "stall" else trip
    return (own, n, first, n >= most and at - first >= span)


_STATE = "host string, kind string, n long, first timestamp_ntz, dead boolean"


def watch_hosts(rows: DataFrame, root: str, checkpoint: str, trip: tuple[int, int] = TRIP, stall: tuple[int, int] = TRIP_STALL, slices: int | None = None) -> StreamingQuery:
    """Hosts as they trip, from a stream of outcomes (host, ts, event_id, kind), below `root`/trips.

    Each micro-batch is summed up by slices and stitched to the run that each host had after the batch before, which lies
    below `root`/state. No task holds a host's rows. A batch that is run again reads and writes the same states.
    """
    spark = rows.sparkSession

    def step(batch: DataFrame, k: int) -> None:
        point = mark()
        before = spark.read.schema(_STATE).parquet(f"{root}/state/batch={k - 1}") if k else spark.createDataFrame([], _STATE)
        found = runs(batch, slices)
        carried = before.where("not dead and n > 0").select(
            "host", F.lit(-1).cast("long").alias("slice"), F.col("kind").alias("head_kind"), F.col("n").alias("head_n"), F.col("first").alias("head_first"), F.col("first").alias("head_last"),
            F.col("kind").alias("tail_kind"), F.col("n").alias("tail_n"), F.col("first").alias("tail_first"), F.lit(True).alias("whole"),
        )
        parts = summaries(found, trip, stall).join(before.where("dead").select("host"), "host", "left_anti")  # once dead, always dead
        joined = materialize(stitched(parts.unionByName(carried, allowMissingColumns=True), trip, stall), "host-stitched")
        new = materialize(first_trips(found, joined.where("slice >= 0"), trip, stall), "host-trips")
        new.write.mode("overwrite").parquet(f"{root}/trips/batch={k}")
        last = joined.groupBy("host").agg(F.max_by(F.struct(F.col("tail_kind").alias("kind"), F.col("run_n").alias("n"), F.col("run_first").alias("first")), "slice").alias("_last")).select("host", "_last.*")
        last = last.join(new.select("host", F.lit(True).alias("dead")), "host", "left").fillna(False, ["dead"])
        last = last.withColumn("n", F.when(F.col("kind") == "ok", 0).otherwise(F.col("n"))).unionByName(before.where("dead"))
        last.write.mode("overwrite").parquet(f"{root}/state/batch={k}")
        discard_since(point)

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@query("stream_host_trips", _STREAKS)
def stream_host_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Events in five parts of their time, a micro-batch each, the stream stopped and started again between them; held
    against the windows of host_trips."""
    events = tables.read(spark, sf, "events")
    source, root, checkpoint = (new_path(spark, f"host-{x}") for x in ("events", "watch", "watch-checkpoint"))
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))  # one row
    part = F.least(F.lit(4), F.floor((F.unix_micros("ts") - F.unix_micros("low")) * 5 / F.greatest(F.lit(1), F.unix_micros("high") - F.unix_micros("low"))))
    parted = materialize(events.withColumn("ts", F.col("ts").cast("timestamp")).crossJoin(F.broadcast(ends.select(F.col("low").cast("timestamp"), F.col("high").cast("timestamp")))).withColumn("part", part).drop("low", "high"), "host-parts")
    for k in range(5):
        parted.where(F.col("part") == k).drop("part").write.mode("append").parquet(source)
        stream = spark.readStream.schema(parted.drop("part").schema).parquet(source)
        watch_hosts(outcomes(tables.repo_events_from(stream)), root, checkpoint, (3, 600), (3, 600), 8).awaitTermination()
    return spark.read.parquet(f"{root}/trips").select("host", "kind", "tripped_at", "failures")
