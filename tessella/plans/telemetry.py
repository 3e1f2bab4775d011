"""Crawl telemetry: scopes, snapshots, rates, feeds, verification state. All times are relative to an explicit as_of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import floor_seconds, human_bytes, logical_shard
from ..operators import bitmaps, stacks
from ..schemas import EXCLUDED_PREFIXES, EXCLUDED_RUN, IDLE_SECONDS, ISSUE_EVENTS, LEGACY_RUNS, RATE_MINUTES, REASON_SHARDS, SETTLED, STATUSES, TARGET_REPOS, TERMINAL_EVENTS, TIMELINE_POINTS
from ..sources import tables
from ..sources.tables import with_tables
from ..storage import materialize
from .registry import query

_PR, _EV, _VP = with_tables("events", "progress"), with_tables("events"), with_tables("verify")
_LOGICAL = "regexp_replace(shard, '^(overcap-long-|overcap-)shard', 'shard')"
_MAIN = f"run_id <> '{EXCLUDED_RUN}' AND " + " AND ".join(f"NOT starts_with(run_id, '{p}')" for p in EXCLUDED_PREFIXES)
_SCOPE = f", sc AS (SELECT DISTINCT arg_max(run_id, (ts, run_id)) AS run_id FROM pr WHERE {_MAIN} GROUP BY {_LOGICAL})"
_SUM = lambda names: " + ".join(names)
_IN = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"


def is_main_run(run: Column) -> Column:
    return reduce(lambda c, p: c & ~run.startswith(p), EXCLUDED_PREFIXES, run != EXCLUDED_RUN)


def run_scope(progress: DataFrame) -> DataFrame:
    """The latest main run of each logical shard, without repeats."""
    by = progress.where(is_main_run(F.col("run_id"))).groupBy(logical_shard(F.col("shard")).alias("logical_shard"))
    return by.agg(F.max_by("run_id", F.struct("ts", "run_id")).alias("run_id")).where("run_id <> ''").select("run_id").distinct()


def in_scope(rows: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of the scope's runs; events without a run belong to a legacy run, where the scope has one."""
    legacy = scope.where(F.col("run_id").isin(list(LEGACY_RUNS))).select(F.lit("").alias("run_id")).distinct()
    return rows.join(F.broadcast(scope.unionByName(legacy)), "run_id", "left_semi")  # one row a shard


def snapshot(progress: DataFrame) -> DataFrame:
    """Latest counts of each logical shard."""
    latest = F.max_by(F.struct(*STATUSES, "in_flight"), F.struct("ts", "run_id", "shard"))
    by = progress.withColumn("logical", logical_shard(F.col("shard"))).groupBy(F.col("logical").alias("shard")).agg(F.max("ts").alias("latest_ts"), latest.alias("c"))
    return by.select("shard", "latest_ts", "c.*")


_SNAP = f", s0 AS (SELECT *, {_LOGICAL} AS logical, row_number() OVER (PARTITION BY {_LOGICAL} ORDER BY ts DESC, run_id DESC, shard DESC) AS r FROM pr WHERE run_id IN (SELECT run_id FROM sc)), snap AS (SELECT logical AS shard, ts AS latest_ts, {', '.join(STATUSES)}, in_flight FROM s0 WHERE r = 1)"


@query("run_scope", _PR + _SCOPE + " SELECT run_id FROM sc")
def scope_query(spark: SparkSession, sf: str) -> DataFrame:
    return run_scope(tables.progress(spark, sf))


@query("overview_snapshot", _PR + _SCOPE + _SNAP + f" SELECT shard, latest_ts, {', '.join(STATUSES)}, in_flight, ({_SUM(STATUSES)})::BIGINT AS total, (pending + fetching)::BIGINT AS remaining, ({_SUM(STATUSES)} - pending - fetching)::BIGINT AS resolved FROM snap")
def overview_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    p = tables.progress(spark, sf)
    s = snapshot(in_scope(p, run_scope(p)))
    total = reduce(lambda a, b: a + b, [F.col(c) for c in STATUSES])
    remaining = F.col("pending") + F.col("fetching")
    return s.withColumns({"total": total, "remaining": remaining, "resolved": total - remaining})


@query("event_totals", _PR + _SCOPE + f", a AS (SELECT max(ts) AS t FROM ev) SELECT coalesce(sum(posts) FILTER (WHERE event = 'loaded'), 0)::BIGINT AS posts_total, coalesce(sum(car_bytes), 0)::BIGINT AS bytes_total, coalesce(sum(posts) FILTER (WHERE event = 'loaded' AND ts >= t - INTERVAL {RATE_MINUTES} MINUTE), 0)::BIGINT AS recent_posts FROM ev, a WHERE run_id IN (SELECT run_id FROM sc)")
def event_totals(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.repo_events(spark, sf)
    rows = in_scope(e, run_scope(tables.progress(spark, sf))).join(F.broadcast(e.agg(F.max("ts").alias("as_of"))), F.lit(True))  # a row
    loaded = F.when(F.col("event") == "loaded", F.col("posts"))
    recent = F.when(F.col("ts") >= F.col("as_of") - F.expr(f"INTERVAL {RATE_MINUTES} MINUTES"), loaded)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in ((loaded, "posts_total"), (F.col("car_bytes"), "bytes_total"), (recent, "recent_posts"))])


def shard_rates(progress: DataFrame, minutes: int, as_of: DataFrame) -> DataFrame:
    """Accounts settled a minute by logical shard, over the minutes that its snapshots cover (one at least)."""
    rows = progress.join(F.broadcast(as_of), F.lit(True)).where(F.col("ts") >= F.col("as_of") - F.expr(f"INTERVAL {minutes} MINUTES"))
    settled = reduce(lambda a, b: a + b, [F.col(c) for c in SETTLED])
    at = F.struct("ts", "run_id", "shard")
    covered = F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")) / 60
    by = rows.withColumn("logical", logical_shard(F.col("shard"))).groupBy("logical")
    return by.agg(((F.max_by(settled, at) - F.min_by(settled, at)) / F.greatest(covered, F.lit(1.0))).alias("rpm"))


_DAYS = 2 * 24 * 60


@query("fleet_rate", _PR + _SCOPE + f", a AS (SELECT max(ts) AS t FROM pr), w AS (SELECT {_LOGICAL} AS logical, {_SUM(SETTLED)} AS v, ts, run_id, shard FROM pr, a WHERE run_id IN (SELECT run_id FROM sc) AND ts >= t - INTERVAL {_DAYS} MINUTE), g AS (SELECT logical, (arg_max(v, (ts, run_id, shard)) - arg_min(v, (ts, run_id, shard))) / greatest(date_diff('second', min(ts), max(ts)) / 60, 1) AS rpm FROM w GROUP BY logical) SELECT round(coalesce(sum(rpm), 0), 6) AS repos_per_min FROM g")
def fleet_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots here are hourly, so the window is two days instead of ten minutes."""
    p = tables.progress(spark, sf)
    rates = shard_rates(in_scope(p, run_scope(p)), _DAYS, p.agg(F.max("ts").alias("as_of")))
    return rates.agg(F.round(F.coalesce(F.sum("rpm"), F.lit(0.0)), 6).alias("repos_per_min"))


@query("last_error", _PR + _SCOPE + " SELECT did, error FROM ev WHERE event IN ('failed', 'quarantined') AND error <> '' AND run_id IN (SELECT run_id FROM sc) ORDER BY ts DESC, event_id DESC LIMIT 1")
def last_error(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_scope(tables.repo_events(spark, sf), run_scope(tables.progress(spark, sf)))
    return rows.where(F.col("event").isin("failed", "quarantined") & (F.col("error") != "")).orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("did", "error")


@query("shard_freshness", _PR + _SCOPE + _SNAP + ", a AS (SELECT max(ts) AS t FROM pr) SELECT shard, date_diff('second', latest_ts, t)::BIGINT AS age_s FROM snap, a")
def shard_freshness(spark: SparkSession, sf: str) -> DataFrame:
    p = tables.progress(spark, sf)
    rows = snapshot(in_scope(p, run_scope(p))).join(F.broadcast(p.agg(F.max("ts").alias("as_of"))), F.lit(True))
    return rows.select("shard", F.timestamp_diff("SECOND", F.col("latest_ts"), F.col("as_of")).alias("age_s")).orderBy(F.desc("age_s"), "shard")


@query("throughput_timeline", _PR + _SCOPE + f", e AS (SELECT * FROM ev WHERE run_id IN (SELECT run_id FROM sc)), b AS (SELECT greatest(60, ceil((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 / {TIMELINE_POINTS}))::BIGINT AS step FROM e) SELECT (epoch_us(ts) // (step * 1000000)) * step AS bucket, coalesce(sum(posts) FILTER (WHERE event = 'loaded'), 0)::BIGINT AS posts_loaded, sum(car_bytes)::BIGINT AS bytes_downloaded, step FROM e, b GROUP BY 1, step")
def throughput_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Events are summed by second once; the step and the buckets both come from that table."""
    e = in_scope(tables.repo_events(spark, sf), run_scope(tables.progress(spark, sf)))
    seconds = e.groupBy(floor_seconds(F.col("ts"), F.lit(1)).alias("second")).agg(
        F.min("ts").alias("low"), F.max("ts").alias("high"), F.sum(F.when(F.col("event") == "loaded", F.col("posts"))).alias("posts"), F.sum("car_bytes").alias("bytes")
    )
    span = F.timestamp_diff("MICROSECOND", F.min("low"), F.max("high")) / 1_000_000
    step = seconds.agg(F.greatest(F.lit(60), F.ceil(span / TIMELINE_POINTS)).cast("long").alias("step"))
    rows = seconds.join(F.broadcast(step), F.lit(True)).withColumn("bucket", F.floor(F.col("second") / F.col("step")) * F.col("step"))  # a row
    return rows.groupBy("bucket", "step").agg(F.coalesce(F.sum("posts"), F.lit(0)).alias("posts_loaded"), F.sum("bytes").alias("bytes_downloaded"))


@query("hosts_table", _PR + _SCOPE + f" SELECT pds_host AS host, count(*) FILTER (WHERE event IN {_IN(TERMINAL_EVENTS)}) AS total, count(*) FILTER (WHERE event = 'loaded') AS loaded, count(*) FILTER (WHERE event = 'empty') AS empty, count(*) FILTER (WHERE event IN {_IN(ISSUE_EVENTS)}) AS issues, sum(car_bytes)::BIGINT AS bytes, round(coalesce(avg(posts) FILTER (WHERE event = 'loaded'), 0), 6) AS avg_posts FROM ev WHERE run_id IN (SELECT run_id FROM sc) GROUP BY pds_host ORDER BY total DESC, loaded DESC, host LIMIT 12")
def hosts_table(spark: SparkSession, sf: str) -> DataFrame:
    e = in_scope(tables.repo_events(spark, sf), run_scope(tables.progress(spark, sf)))
    has = lambda *k: F.col("event").isin(*k)
    by = e.groupBy(F.col("pds_host").alias("host")).agg(
        F.count_if(has(*TERMINAL_EVENTS)).alias("total"), F.count_if(has("loaded")).alias("loaded"), F.count_if(has("empty")).alias("empty"), F.count_if(has(*ISSUE_EVENTS)).alias("issues"),
        F.sum("car_bytes").alias("bytes"), F.round(F.coalesce(F.avg(F.when(has("loaded"), F.col("posts"))), F.lit(0.0)), 6).alias("avg_posts"),
    )
    return by.orderBy(F.desc("total"), F.desc("loaded"), "host").limit(12)


@query("issues_feed", _EV + f" SELECT ts, did, pds_host, event, substr(error, 1, 160) AS error FROM ev WHERE event IN {_IN(ISSUE_EVENTS)} ORDER BY ts DESC, event_id DESC LIMIT 20")
def issues_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.repo_events(spark, sf).where(F.col("event").isin(*ISSUE_EVENTS)).orderBy(F.desc("ts"), F.desc("event_id")).limit(20)
    return rows.select("ts", "did", "pds_host", "event", F.substring("error", 1, 160).alias("error"))


_REASON = ", rc AS (SELECT date_trunc('day', ts) + to_hours((hour(ts) // 12 * 12)::INT) AS ts, date_trunc('day', ts)::DATE::VARCHAR AS snapshot_id, " + _LOGICAL + " AS shard, event AS status, CASE WHEN error = '' THEN 'none' ELSE error END AS reason, count(*) AS n FROM ev WHERE event IN ('failed', 'quarantined', 'unreachable') GROUP BY 1, 2, 3, 4, 5)"
_COMPLETE = f", ok AS (SELECT snapshot_id FROM rc GROUP BY snapshot_id HAVING count(DISTINCT shard) >= {REASON_SHARDS} ORDER BY max(ts) DESC, snapshot_id DESC LIMIT 1)"


def reason_snapshots(events: DataFrame) -> DataFrame:
    """Daily snapshots of problem events by shard, status and reason, taken anew at noon."""
    rows = events.where(F.col("event").isin("failed", "quarantined", "unreachable"))
    reason = F.when(F.col("error") == "", "none").otherwise(F.col("error"))
    half = (F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(hours=F.floor(F.hour("ts") / 12).cast("int") * 12)).alias("ts")
    return rows.groupBy(half, F.date_format("ts", "yyyy-MM-dd").alias("snapshot_id"), logical_shard(F.col("shard")).alias("shard"), F.col("event").alias("status"), reason.alias("reason")).agg(F.count("*").alias("n"))


def latest_complete(counts: DataFrame, shards: int = REASON_SHARDS) -> DataFrame:
    """The latest snapshot in which enough shards report."""
    by = counts.groupBy("snapshot_id").agg(F.max("ts").alias("t"), F.count_distinct("shard").alias("shards"))
    return by.where(F.col("shards") >= shards).orderBy(F.desc("t"), F.desc("snapshot_id")).limit(1).select("snapshot_id")


@query("reason_snapshot", _EV + _REASON + _COMPLETE + " SELECT snapshot_id FROM ok")
def reason_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return latest_complete(reason_snapshots(tables.repo_events(spark, sf)))


@query("reason_breakdown", _EV + _REASON + _COMPLETE + ", l AS (SELECT shard, status, reason, arg_max(n, ts) AS n FROM rc WHERE snapshot_id IN (SELECT snapshot_id FROM ok) GROUP BY ALL) SELECT status, reason, sum(n)::BIGINT AS n, (sum(sum(n)) OVER (PARTITION BY status))::BIGINT AS status_total FROM l GROUP BY status, reason")
def reason_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    """Latest count of each shard, status and reason within one snapshot, summed over shards."""
    counts = reason_snapshots(tables.repo_events(spark, sf))
    one = counts.join(F.broadcast(latest_complete(counts)), "snapshot_id", "left_semi")
    last = one.groupBy("shard", "status", "reason").agg(F.max_by("n", "ts").alias("n"))
    by = last.groupBy("status", "reason").agg(F.sum("n").alias("n"))
    return by.withColumn("status_total", F.sum("n").over(Window.partitionBy("status"))).orderBy("status", F.desc("n"), "reason")


_COUNTS = ["repos_total", "repos_checked", "exact", "loose", "mismatches", "loose_emitted", "sample_checked", "sample_failures"]
_VROWS = f", a AS (SELECT max(ts) AS t FROM vp), v0 AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts DESC, done DESC, (error <> '') DESC, repos_checked DESC, run_id DESC) AS r, max(ts) OVER (PARTITION BY shard) AS latest FROM vp, a WHERE regexp_matches(shard, '^shard[0-9]+$') AND repos_total > 0 AND ((done > 0 AND repos_checked > 0) OR ts >= t - INTERVAL 10 MINUTE)), vr AS (SELECT * FROM v0 WHERE r = 1)"


def verify_rows(progress: DataFrame, as_of: DataFrame, pattern: str = "^shard[0-9]+$", fresh: bool = True) -> DataFrame:
    """The latest row of each shard, by time, then done, failed and checked."""
    rows = progress.join(F.broadcast(as_of), F.lit(True)).where(F.col("shard").rlike(pattern) & (F.col("repos_total") > 0))
    if fresh:
        rows = rows.where(((F.col("done") > 0) & (F.col("repos_checked") > 0)) | (F.col("ts") >= F.col("as_of") - F.expr("INTERVAL 10 MINUTES")))
    order = F.struct("ts", "done", F.col("error") != "", "repos_checked", "run_id")
    by = rows.groupBy("shard").agg(F.max("ts").alias("latest_ts"), F.max_by(F.struct("run_id", "phase", *_COUNTS, "done", "error"), order).alias("c"), F.max("as_of").alias("as_of"))
    return by.select("shard", "latest_ts", "c.*", "as_of")


@query("verify_rollup", _VP + _VROWS + f""" SELECT count(*) AS shards, {', '.join(f'coalesce(sum({c}), 0)::BIGINT AS {c}' for c in _COUNTS)}, count(*) FILTER (WHERE done > 0) AS done_shards, count(*) FILTER (WHERE phase = 'failed' OR error <> '') AS failed_shards,
  arg_max(run_id, (latest, shard)) AS run_id, date_diff('second', max(latest), max(t))::BIGINT AS freshness_s,
  CASE WHEN count(DISTINCT phase) = 1 THEN min(phase) WHEN date_diff('second', max(latest), max(t)) < {IDLE_SECONDS} AND count(*) FILTER (WHERE done > 0) < count(*) THEN 'mixed' WHEN count(*) FILTER (WHERE done > 0) = count(*) THEN 'finished' ELSE 'idle' END AS phase,
  arg_min(shard || ': ' || error, shard) FILTER (WHERE error <> '') AS error FROM vr""")
def verify_rollup(spark: SparkSession, sf: str) -> DataFrame:
    p = tables.verify_progress(spark, sf)
    rows = verify_rows(p, p.agg(F.max("ts").alias("as_of")))
    done, fresh = F.count_if(F.col("done") > 0), F.timestamp_diff("SECOND", F.max("latest_ts"), F.max("as_of"))
    active = (fresh < IDLE_SECONDS) & (done < F.count("*"))
    return rows.agg(
        F.count("*").alias("shards"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS], done.alias("done_shards"), F.count_if((F.col("phase") == "failed") | (F.col("error") != "")).alias("failed_shards"),
        F.max_by("run_id", F.struct("latest_ts", "shard")).alias("run_id"), fresh.alias("freshness_s"),
        F.when(F.count_distinct("phase") == 1, F.min("phase")).when(active, "mixed").when(done == F.count("*"), "finished").otherwise("idle").alias("phase"),
        F.min_by(F.concat("shard", F.lit(": "), "error"), F.when(F.col("error") != "", F.col("shard"))).alias("error"),
    )


@query("recheck_open", _VP + _SCOPE + f", rs AS (SELECT DISTINCT {_LOGICAL} AS shard FROM pr WHERE starts_with(run_id, 'fail-')), can AS (SELECT {_LOGICAL} AS shard, arg_max(loaded, (ts, run_id, shard)) AS loaded FROM pr WHERE run_id IN (SELECT run_id FROM sc) GROUP BY 1), f0 AS (SELECT regexp_replace(shard, '^fail-shard', 'shard') AS s, exact, mismatches, done, error, row_number() OVER (PARTITION BY shard ORDER BY ts DESC, done DESC, (error <> '') DESC, repos_checked DESC, run_id DESC) AS r FROM vp WHERE regexp_matches(shard, '^fail-shard[0-9]+$') AND repos_total > 0) SELECT coalesce(sum(greatest(0, loaded - coalesce(exact, 0))), 0)::BIGINT AS recheck_open, count(*) AS shards FROM can JOIN rs USING (shard) LEFT JOIN (SELECT * FROM f0 WHERE r = 1 AND done > 0 AND mismatches = 0 AND error = '') c ON c.s = can.shard")
def recheck_open(spark: SparkSession, sf: str) -> DataFrame:
    p, v = tables.progress(spark, sf), tables.verify_progress(spark, sf)
    rechecked = p.where(F.col("run_id").startswith("fail-")).select(logical_shard(F.col("shard")).alias("shard")).distinct()
    main = snapshot(in_scope(p, run_scope(p))).select("shard", "loaded").join(rechecked, "shard")
    cleared = verify_rows(v, v.agg(F.max("ts").alias("as_of")), "^fail-shard[0-9]+$", fresh=False).where("done > 0 and mismatches = 0 and error = ''")
    cleared = cleared.select(F.regexp_replace("shard", "^fail-shard", "shard").alias("shard"), F.col("exact").alias("cleared"))
    left = F.greatest(F.lit(0), F.col("loaded") - F.coalesce("cleared", F.lit(0)))
    return main.join(cleared, "shard", "left").agg(F.coalesce(F.sum(left), F.lit(0)).alias("recheck_open"), F.count("*").alias("shards"))


@query("recrawl_status", _PR + f", r AS (SELECT run_id FROM pr WHERE starts_with(run_id, 'fail-') ORDER BY ts DESC, run_id DESC LIMIT 1), s0 AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts DESC) AS k FROM pr WHERE run_id IN (SELECT run_id FROM r)) SELECT (SELECT run_id FROM r) AS run_id, count(*) AS shards, greatest(0, sum({_SUM(STATUSES)} - pending - fetching))::BIGINT AS processed, ({TARGET_REPOS} - greatest(0, sum({_SUM(STATUSES)} - pending - fetching)))::BIGINT AS remaining_repos FROM s0 WHERE k = 1")
def recrawl_status(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of the latest run of a prefix against its target."""
    p = tables.progress(spark, sf)
    run = p.where(F.col("run_id").startswith("fail-")).orderBy(F.desc("ts"), F.desc("run_id")).limit(1).select("run_id")
    rows = p.join(F.broadcast(run), "run_id", "left_semi")
    last = rows.groupBy("run_id", "shard").agg(F.max_by(F.struct(*STATUSES), "ts").alias("c")).select("run_id", "c.*")
    total = reduce(lambda a, b: a + b, [F.col(c) for c in STATUSES])
    done = F.greatest(F.lit(0), F.sum(total - F.col("pending") - F.col("fetching")))
    return last.agg(F.max("run_id").alias("run_id"), F.count("*").alias("shards"), done.alias("processed"), (F.lit(TARGET_REPOS) - done).alias("remaining_repos"))


@query("loose_unique_dids", _EV + f", a AS (SELECT max(ts) AS t FROM ev) SELECT count(DISTINCT did) FILTER (WHERE event IN {_IN(TERMINAL_EVENTS)}) AS processed, count(DISTINCT did) FILTER (WHERE event = 'loaded') AS loaded, count(DISTINCT did) FILTER (WHERE event IN {_IN(ISSUE_EVENTS)}) AS issues, count(*) AS event_rows, round(count(DISTINCT did) FILTER (WHERE event IN {_IN(TERMINAL_EVENTS)} AND ts >= t - INTERVAL 1 DAY) / greatest(date_diff('second', min(ts) FILTER (WHERE ts >= t - INTERVAL 1 DAY), max(ts)) / 60, 1), 6) AS repos_per_min FROM ev, a WHERE starts_with(run_id, 'fail-')")
def loose_unique_dids(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct accounts by outcome, and their rate over the last day: accounts are folded to flags first, so that four
    conditional counts need one row an account and no copies of the events."""
    e = tables.repo_events(spark, sf)
    rows = e.join(F.broadcast(e.agg(F.max("ts").alias("as_of"))), F.lit(True)).where(F.col("run_id").startswith("fail-"))
    recent = F.col("ts") >= F.col("as_of") - F.expr("INTERVAL 1 DAY")
    has = lambda *k: F.bool_or(F.col("event").isin(*k))
    per = rows.groupBy("did").agg(
        has(*TERMINAL_EVENTS).alias("processed"), has("loaded").alias("loaded"), has(*ISSUE_EVENTS).alias("issues"), F.bool_or(F.col("event").isin(*TERMINAL_EVENTS) & recent).alias("recent"),
        F.count("*").alias("n"), F.min(F.when(recent, F.col("ts"))).alias("since"), F.max("ts").alias("last"),
    )
    minutes = F.timestamp_diff("SECOND", F.min("since"), F.max("last")) / 60
    return per.agg(*[F.count_if(c).alias(c) for c in ("processed", "loaded", "issues")], F.sum("n").alias("event_rows"), F.round(F.count_if("recent") / F.greatest(minutes, F.lit(1.0)), 6).alias("repos_per_min"))


_OUTCOMES = {"processed": TERMINAL_EVENTS, "loaded": ("loaded",), "issues": ISSUE_EVENTS}


@query("distinct_by_day", _EV + ", d AS (SELECT DISTINCT ts::DATE AS day FROM ev) SELECT day, " + ", ".join(f"count(DISTINCT did) FILTER (WHERE ts::DATE = day AND event IN {_IN(k)}) AS {n}, count(DISTINCT did) FILTER (WHERE event IN {_IN(k)}) AS {n}_so_far" for n, k in _OUTCOMES.items()) + " FROM d JOIN ev ON ts::DATE <= day GROUP BY day")
def distinct_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct accounts by outcome for each day and up to it, from bitmaps by day that are stored once and merged at read."""
    events = tables.repo_events(spark, sf).withColumn("day", F.to_date("ts"))
    ids = bitmaps.dense_ids(events, "did")
    marks = bitmaps.marks(events.join(ids, "did"), ["day"], {n: F.col("event").isin(*k) for n, k in _OUTCOMES.items()})
    stored = materialize(marks, "bitmaps-by-day")
    own, upto = bitmaps.counts(stored, ["day"], list(_OUTCOMES)), bitmaps.counts(bitmaps.running(stored, "day", list(_OUTCOMES)), ["day"], list(_OUTCOMES))
    return own.join(upto.select("day", *[F.col(n).alias(f"{n}_so_far") for n in _OUTCOMES]), "day")


_FRAME = "event_type || '@' || (user_id % 3) || ':' || (event_id % 2)"


@query("stack_shares", f"""WITH RECURSIVE n AS (SELECT event_id AS id, CASE WHEN event_id > 0 THEN event_id // 3 END AS parent, {_FRAME} AS frame FROM events),
w AS (SELECT event_id AS sample, event_id // 10 AS cur, 0 AS depth, []::VARCHAR[] AS frames FROM events
  UNION ALL SELECT w.sample, n.parent, w.depth + 1, list_append(w.frames, n.frame) FROM w JOIN n ON n.id = w.cur WHERE w.depth < 12),
s AS (SELECT array_to_string(arg_max(frames, depth)[1:6], ' < ') AS stack FROM w GROUP BY sample)
SELECT stack, count(*) AS samples, round(100 * count(*) / (SELECT count(*) FROM events), 1) AS share FROM s GROUP BY stack ORDER BY samples DESC, stack LIMIT 12""")
def stack_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent call stacks of a profile: nodes with parents, and samples at nodes, taken from the events."""
    events = tables.read(spark, sf, "events")
    nodes = events.select(F.col("event_id").alias("node"), F.when(F.col("event_id") > 0, F.floor(F.col("event_id") / 3)).alias("parent"), F.expr(_FRAME).alias("frame"))
    samples = events.select(F.floor(F.col("event_id") / 10).alias("node"))
    return stacks.top_stacks(nodes, samples, 12)


@query("host_bytes", _EV + ", h AS (SELECT pds_host, sum(car_bytes)::BIGINT AS bytes, min(car_bytes) AS least FROM ev GROUP BY pds_host) SELECT pds_host, bytes, "
       + ", ".join(f"CASE WHEN {c} >= 1099511627776 THEN printf('%.1f TiB', {c} / 1099511627776) WHEN {c} >= 1073741824 THEN printf('%.1f GiB', {c} / 1073741824) WHEN {c} >= 1048576 THEN printf('%.1f MiB', {c} / 1048576) WHEN {c} >= 1024 THEN printf('%.1f KiB', {c} / 1024) ELSE {c} || ' B' END AS {n}" for c, n in (("bytes", "shown"), ("least", "least_shown"))) + " FROM h")
def host_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes fetched from each host, as they are shown."""
    by = tables.repo_events(spark, sf).groupBy("pds_host").agg(F.sum("car_bytes").alias("bytes"), F.min("car_bytes").alias("least"))
    return by.select("pds_host", "bytes", human_bytes(F.col("bytes")).alias("shown"), human_bytes(F.col("least")).alias("least_shown"))


@query("drain_remaining", _PR + ", s0 AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts DESC, run_id DESC) AS k FROM pr WHERE shard IN ('shard0', 'shard1', 'shard2', 'shard3')) SELECT sum(pending + fetching)::BIGINT AS remaining, count(*) AS shards, count(*) = 4 AS complete FROM s0 WHERE k = 1")
def drain_remaining(spark: SparkSession, sf: str) -> DataFrame:
    """What named shards have left, and whether all of them report."""
    names = ["shard0", "shard1", "shard2", "shard3"]
    last = tables.progress(spark, sf).where(F.col("shard").isin(names)).groupBy("shard").agg(F.max_by(F.col("pending") + F.col("fetching"), F.struct("ts", "run_id")).alias("left"))
    return last.agg(F.sum("left").alias("remaining"), F.count("*").alias("shards"), (F.count("*") == len(names)).alias("complete"))


@query("tick_rates", _PR + " SELECT run_id, shard, ts, round(coalesce((pending - lag(pending) OVER w) / -(date_diff('second', lag(ts) OVER w, ts) / 3600), 0), 6) AS per_hour, coalesce(date_trunc('day', ts) <> lag(date_trunc('day', ts)) OVER w, true) AS new_day FROM pr WINDOW w AS (PARTITION BY run_id, shard ORDER BY ts)")
def tick_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rate between neighbouring snapshots, and where a new day starts."""
    w = Window.partitionBy("run_id", "shard").orderBy("ts")
    hours = F.timestamp_diff("SECOND", F.lag("ts").over(w), F.col("ts")) / 3600
    day = F.date_trunc("day", "ts")
    return tables.progress(spark, sf).select("run_id", "shard", "ts", F.round(F.coalesce((F.col("pending") - F.lag("pending").over(w)) / -hours, F.lit(0.0)), 6).alias("per_hour"), F.coalesce(day != F.lag(day).over(w), F.lit(True)).alias("new_day"))


@query("events_without_shard", _EV + "SELECT run_id, shard, count(*) AS events FROM ev WHERE NOT (run_id = 'main-a' AND shard = 'shard3') GROUP BY run_id, shard")
def events_without_shard(spark: SparkSession, sf: str) -> DataFrame:
    """What is left once the events of one run and shard are deleted."""
    gone = (F.col("run_id") == "main-a") & (F.col("shard") == "shard3")
    return tables.repo_events(spark, sf).where(~gone).groupBy("run_id", "shard").agg(F.count("*").alias("events"))
