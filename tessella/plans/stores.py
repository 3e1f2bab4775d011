"""Stored tables under change: rebuilds while batches arrive, merges, drift, deletes, ledger batches, promotion, pages, sweeps."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import bucket_of
from ..operators import verify as V
from ..operators.aggregates import SPECS, Spec, emoji_total
from ..operators.ledger_store import LedgerStore
from ..operators.posts import normalize
from ..operators.rollups import RollupStore
from ..operators.snapshots import SnapshotLog
from ..sources import archive, enumeration, partitioned, tables
from ..sources.tables import with_tables
from ..storage import materialize, new_path
from .registry import query


def normalized(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    """Posts from raw events, a document each, under ids of their own."""
    raw = tables.raw_events(spark, sf).where(where)
    return normalize(raw.withColumn("did", F.concat("did", F.lit("/"), "doc_id"))).drop("anomalies")


def listing(name: str, spec: Spec, rows: DataFrame) -> DataFrame:
    """A rollup as (rollup, key, posts, occurrences, with_emojis)."""
    have = lambda c, *names: next((F.col(n) for n in names if n in rows.columns), F.lit(None)).cast("long").alias(c)
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in spec.keys]).alias("key")
    return rows.select(F.lit(name).alias("rollup"), key, have("posts", "posts"), have("occurrences", "occurrences", "emoji_occurrences"), have("with_emojis", "posts_with_emojis"))


def everything(store: RollupStore) -> DataFrame:
    return reduce(DataFrame.unionByName, [listing(name, spec, store.read(name)) for name, spec in store.specs.items()])


_ALL = with_tables("raw") + """, occ AS (SELECT date_trunc('hour', created_at) AS hour, date_trunc('second', received) AS second, glyph, least(runs, 300) AS n, string_split(langs, '|') AS langs FROM raw),
lang AS (SELECT *, unnest(langs) AS l FROM occ)
SELECT 'emoji_hourly' AS rollup, hour || '|' || glyph AS key, count(*) AS posts, sum(n)::BIGINT AS occurrences, NULL::BIGINT AS with_emojis FROM occ WHERE n > 0 GROUP BY hour, glyph
UNION ALL SELECT 'emoji_hourly_by_lang', l || '|' || hour || '|' || glyph, count(*), sum(n)::BIGINT, NULL FROM lang WHERE n > 0 GROUP BY l, hour, glyph
UNION ALL SELECT 'posts_hourly', hour::VARCHAR, count(*), sum(n)::BIGINT, count(*) FILTER (WHERE n > 0) FROM occ GROUP BY hour
UNION ALL SELECT 'emoji_total', glyph, count(*), sum(n)::BIGINT, NULL FROM occ WHERE n > 0 GROUP BY glyph
UNION ALL SELECT 'emoji_total_by_lang', l || '|' || glyph, count(*), sum(n)::BIGINT, NULL FROM lang WHERE n > 0 GROUP BY l, glyph
UNION ALL SELECT 'lang_total', l, count(*), sum(n)::BIGINT, NULL FROM lang WHERE n > 0 GROUP BY l
UNION ALL SELECT 'live_ingest_second', second::VARCHAR, count(*), NULL, NULL FROM occ GROUP BY second"""


@query("rollups_normalized", _ALL)
def rollups_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """All seven rollups of normalized raw events, computed whole. Texts are looked through once, and what rollups need is written."""
    posts = materialize(normalized(spark, sf).drop("did", "rkey", "text"), "normalized")
    return reduce(DataFrame.unionByName, [listing(name, spec, spec.select(posts)) for name, spec in SPECS.items()])


@query("rebuild_while_ingesting", _ALL)
def rebuild_while_ingesting(spark: SparkSession, sf: str) -> DataFrame:
    """A rebuild and a repair with batches between their reading and their swap. Redelivered posts count twice until the
    rebuild; a batch that comes in meanwhile counts once; a merge under the repair makes it start again."""
    store = RollupStore(spark, new_path(spark, "ingesting"))
    part = lambda k: normalized(spark, sf, f"doc_id % 5 = {k}")
    store.append(part(0), 0)
    store.append(part(1), 1)
    store.append(part(0), "redelivered")
    rebuild = store.prepare_rebuild()
    store.append(part(2), 2)
    store.append(part(2), 2)  # run again: nothing changes
    if not store.commit(rebuild):
        raise ValueError("nothing stood in the way of the rebuild")
    repair = store.prepare_repair(None, F.expr("timestamp_ntz'2024-06-01 00:00:00'"))
    store.append(part(3), 3)
    store.compact(2)
    if store.commit(repair):
        raise ValueError("the repair has swapped out a merged batch that it had not read")
    store.append(part(4), 4)
    store.repair(None, F.expr("timestamp_ntz'2024-06-01 00:00:00'"))
    return everything(store)


@query("rollup_compaction", "SELECT 9 AS batches, true AS unchanged, true AS bounded, a.* FROM (" + _ALL + ") AS a")
def rollup_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Nine batches, merged by threes as they come: sums stay as they are, and parts do not grow with the batches."""
    store, n, fanout, unchanged = RollupStore(spark, new_path(spark, "compaction")), 9, 3, True
    for k in range(n):
        store.append(normalized(spark, sf, f"doc_id % {n} = {k}"), k)
        before = store.log.latest()
        if store.compact(fanout) and k < fanout:
            pairs = [(store.read(name, before), store.read(name)) for name in ("emoji_hourly", "posts_hourly")]
            unchanged = all(a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() for a, b in pairs)
    bounded = max(count for name, count in store.parts().items() if name != "posts") == 1
    store.log.vacuum(keep=1, grace_s=0)
    return everything(store).select(F.lit(n).alias("batches"), F.lit(unchanged).alias("unchanged"), F.lit(bounded).alias("bounded"), "*")


def _posts_only(posts: DataFrame) -> DataFrame:
    """An older definition of emoji_total: posts in place of occurrences."""
    return emoji_total(posts).withColumn("occurrences", F.col("posts"))


@query("rollup_drift", with_tables("raw") + """, t AS (SELECT glyph AS emoji, least(runs, 300) AS n, doc_id % 2 AS half FROM raw WHERE runs > 0)
SELECT emoji, CASE WHEN true THEN 'drifted' END AS found, sum(CASE WHEN half = 0 THEN 1 ELSE n END)::BIGINT AS mixed, sum(n)::BIGINT AS occurrences, count(*) AS posts, 'emoji_total' AS dirty_before, '' AS dirty_after FROM t GROUP BY emoji""")
def rollup_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A table that an older definition has filled: migration finds it drifted and dirty, a rebuild makes it right."""
    root = new_path(spark, "drift")
    older = SPECS | {"emoji_total": replace(SPECS["emoji_total"], build=_posts_only)}
    RollupStore(spark, root, older).append(normalized(spark, sf, "doc_id % 2 = 0"), 0)
    store = RollupStore(spark, root)
    found, dirty = store.migrate()["emoji_total"], ",".join(store.dirty())
    store.append(normalized(spark, sf, "doc_id % 2 = 1"), 1)
    mixed = store.read("emoji_total").select("emoji", F.col("occurrences").alias("mixed"))
    store.rebuild()
    clean = ",".join(store.dirty())
    after = store.read("emoji_total")
    return after.join(mixed, "emoji").select("emoji", F.lit(found).alias("found"), "mixed", "occurrences", "posts", F.lit(dirty).alias("dirty_before"), F.lit(clean).alias("dirty_after"))


_EV = with_tables("events")


@query("delete_run_shard", _EV + """, a AS (SELECT run_id, shard, did, count(*) AS n, sum(posts)::BIGINT AS posts FROM ev
  WHERE NOT (run_id = 'main-a' AND shard = 'shard0') AND NOT (run_id = 'main-b' AND shard = 'shard1' AND event <> 'loaded') AND NOT (run_id = 'fail-x' AND shard = 'shard2') GROUP BY ALL)
SELECT run_id, shard, count(*) AS accounts, sum(n)::BIGINT AS events, sum(posts)::BIGINT AS posts, true AS had FROM a GROUP BY run_id, shard""")
def delete_run_shard(spark: SparkSession, sf: str) -> DataFrame:
    """Results by run and shard in a stored table: one shard is deleted, one written again, one written again with nothing."""
    path, keys = new_path(spark, "results"), ["run_id", "shard"]
    per = lambda e: e.groupBy(*keys, "did").agg(F.count("*").alias("n"), F.sum("posts").alias("posts"))
    events = tables.repo_events(spark, sf)
    partitioned.put(per(events), path, keys)
    had = partitioned.delete(spark, path, {"run_id": "main-a", "shard": "shard0"}) and not partitioned.delete(spark, path, {"run_id": "main-a", "shard": "shard0"})
    again = per(events.where("run_id = 'main-b' and shard = 'shard1' and event = 'loaded'"))
    partitioned.replace(again.drop(*keys), path, {"run_id": "main-b", "shard": "shard1"})
    partitioned.replace(again.drop(*keys).limit(0), path, {"run_id": "fail-x", "shard": "shard2"})
    stored = spark.read.parquet(path)
    return stored.groupBy(*keys).agg(F.count("*").alias("accounts"), F.sum("n").alias("events"), F.sum("posts").alias("posts")).withColumn("had", F.lit(had))


@query("expire_rows", _EV + ", c AS (SELECT max(ts) - INTERVAL 5 DAY AS cutoff FROM ev) SELECT ts::DATE AS day, count(*) AS events, min(ts) AS oldest FROM ev, c WHERE ts >= cutoff GROUP BY ALL")
def expire_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events stored by day, of which the last five days stay."""
    path = new_path(spark, "aging")
    events = tables.repo_events(spark, sf).select("event_id", "ts", "did", F.col("ts").cast("date").alias("day"))
    partitioned.put(events, path, ["day"])
    partitioned.expire(spark, path, "ts", events.agg(F.max("ts") - F.expr("INTERVAL 5 DAY")).first()[0])
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("events"), F.min("ts").alias("oldest"))


def _changes(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Batches of ledger changes, of every kind, from the customers."""
    c = tables.read(spark, sf, "customer").selectExpr("c_custkey as k", "concat('c', c_custkey) as did", "concat('host', c_nationkey) as pds_host")
    c = c.withColumn("bucket", bucket_of(F.col("did")))
    new = c.withColumn("did", F.concat(F.lit("n"), "k")).withColumn("bucket", bucket_of(F.concat(F.lit("n"), "k")))
    seq = "k as seq"
    found = c.where("k % 4 = 0").selectExpr("did", "'pending' as kind", "'moved' as pds_host", "bucket", "2 as seq").unionByName(c.where("k % 4 = 0").selectExpr("did", "'pending' as kind", "'early' as pds_host", "bucket", "1 as seq"))
    born = new.where("k % 10 = 0").selectExpr("did", "'pending' as kind", "pds_host", "bucket", seq)
    ended = c.where("k % 7 = 1").selectExpr("did", "'tombstoned' as kind", "pds_host", "bucket", seq).unionByName(new.where("k % 10 = 1").selectExpr("did", "'tombstoned' as kind", "pds_host", "bucket", seq))
    dead = c.where("k % 9 = 2").selectExpr("did", "'parked' as kind", "'dead' as pds_host", "'host dead: x' as error", "bucket", seq).unionByName(new.where("k % 10 = 2").selectExpr("did", "'parked' as kind", "'dead' as pds_host", "'host dead: x' as error", "bucket", seq))
    begun = c.where("k % 2 = 0").selectExpr("did", "'fetching' as kind", seq)
    kind = "element_at(array('loaded', 'retry', 'throttled', 'terminal', 'terminal', 'loaded'), cast(k % 6 + 1 as int))"
    done = c.unionByName(new.where("k % 10 > 2")).where("k % 3 <> 0").selectExpr(
        "did", f"{kind} as kind", "if(k % 6 = 4, 'empty', 'failed') as status", "if(k % 12 < 6, concat('http 4', k % 12), null) as error", "k * 7 as retry_after",
        "k % 100 as posts_total", "'d' as rkey_digest", "k as loaded_at", seq,
    )
    return [found.unionByName(born), ended, dead, begun, done]


_UPSERT = with_tables("ledger") + """, k0 AS (SELECT c_custkey AS k, did, pds_host, status, attempts, retry_after, error, posts_total, rkey_digest, loaded_at FROM led),
a AS (SELECT k, did, CASE WHEN k % 4 = 0 AND status = 'pending' THEN 'moved' ELSE pds_host END AS pds_host, status, attempts, retry_after, error, posts_total, rkey_digest, loaded_at FROM k0
  UNION ALL SELECT c_custkey, 'n' || c_custkey, 'host' || c_nationkey, 'pending', 0, NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 10 = 0),
b AS (SELECT * REPLACE (CASE WHEN z THEN 'tombstoned' ELSE status END AS status, CASE WHEN z THEN NULL ELSE retry_after END AS retry_after) FROM (SELECT *, left(did, 1) = 'c' AND k % 7 = 1 AND status NOT IN ('loaded', 'verified') AS z FROM a)
  UNION ALL SELECT c_custkey, 'n' || c_custkey, '', 'tombstoned', 0, NULL, NULL, NULL, NULL, NULL, false FROM customer WHERE c_custkey % 10 = 1),
c AS (SELECT * REPLACE (CASE WHEN y THEN 'dead' ELSE pds_host END AS pds_host, CASE WHEN y THEN 'unreachable' ELSE status END AS status, CASE WHEN y THEN 5 ELSE attempts END AS attempts, CASE WHEN y THEN 'host dead: x' ELSE error END AS error, CASE WHEN y THEN NULL ELSE retry_after END AS retry_after)
    FROM (SELECT *, left(did, 1) = 'c' AND k % 9 = 2 AND status = 'pending' AS y FROM b)
  UNION ALL SELECT c_custkey, 'n' || c_custkey, 'dead', 'unreachable', 5, NULL, 'host dead: x', NULL, NULL, NULL, false, false FROM customer WHERE c_custkey % 10 = 2),
d AS (SELECT * REPLACE (CASE WHEN left(did, 1) = 'c' AND k % 2 = 0 AND status IN ('pending', 'unreachable') THEN 'fetching' ELSE status END AS status) FROM c),
e AS (SELECT *, CASE WHEN left(did, 1) = 'n' OR k % 3 = 0 THEN 'none' ELSE ['loaded', 'retry', 'throttled', 'terminal', 'terminal', 'loaded'][k % 6 + 1] END AS kind, CASE WHEN k % 12 < 6 THEN 'http 4' || (k % 12) END AS err FROM d),
f AS (SELECT did, pds_host, CASE kind WHEN 'loaded' THEN 'loaded' WHEN 'retry' THEN 'unreachable' WHEN 'throttled' THEN 'unreachable' WHEN 'terminal' THEN CASE WHEN k % 6 = 4 THEN 'empty' ELSE 'failed' END ELSE status END AS status,
  attempts + (kind = 'retry')::INT AS attempts, CASE WHEN kind IN ('retry', 'throttled') THEN k * 7 WHEN kind = 'loaded' THEN NULL ELSE retry_after END AS retry_after,
  CASE WHEN kind IN ('retry', 'throttled') THEN err WHEN kind = 'loaded' OR (kind = 'terminal' AND k % 6 = 4) THEN NULL WHEN kind = 'terminal' THEN coalesce(err, error) ELSE error END AS error,
  CASE WHEN kind = 'loaded' THEN k % 100 ELSE posts_total END AS posts_total, CASE WHEN kind = 'loaded' THEN 'd' ELSE rkey_digest END AS rkey_digest, CASE WHEN kind = 'loaded' THEN k ELSE loaded_at END AS loaded_at FROM e)
SELECT did, pds_host, status, attempts::BIGINT AS attempts, retry_after::BIGINT AS retry_after, error, posts_total::BIGINT AS posts_total, rkey_digest, loaded_at::BIGINT AS loaded_at FROM f"""


@query("ledger_upsert", _UPSERT)
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stored ledger after five batches of changes: births and moves, tombstones, dead hosts, claims, results."""
    store = LedgerStore(spark, tables.ledger(spark, sf))
    for changes in _changes(spark, sf):
        store.merge(changes)
    return store.read().drop("bucket")


@query("promotion_guarded", with_tables("classified") + "SELECT did, bucket, (SELECT count(*) FROM exp WHERE status = 'loaded') AS staged, true AS refused FROM cl WHERE status = 'loaded' AND result = 'exact'")
def promotion_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded accounts that are promoted once all that were staged are classified; with one result missing, none is."""
    ledger, expected = tables.ledger(spark, sf), tables.expected(spark, sf).where("status = 'loaded'")
    classified = materialize(V.classify(expected, tables.actual_posts(spark, sf)), "promotion")
    first = classified.agg(F.min("did")).first()[0]
    try:
        V.promote(ledger, expected, classified.where(F.col("did") != first))
        refused = False
    except ValueError:
        refused = True
    promoted, counts = V.promote(ledger, expected, classified)
    return promoted.select("did", "bucket", F.lit(counts["staged"]).alias("staged"), F.lit(refused).alias("refused"))


@query("ledger_pages", with_tables("ledger") + """, r AS (SELECT did, row_number() OVER (ORDER BY did) - 1 AS r, (SELECT greatest(1, count(*) // 7) FROM led) AS size FROM led)
SELECT (r // size)::INT AS page, count(*) AS accounts, min(did) AS first, max(did) AS last, true AS skips FROM r GROUP BY ALL""")
def ledger_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger in pages by account, each from the key where the last one ended, each from the files that hold it."""
    ledger = tables.ledger(spark, sf)
    size = max(1, ledger.count() // 7)
    directory = archive.write_sorted(ledger, "did", new_path(spark, "pages"), max(1, size // 2))
    files, after, pages = directory.count(), None, []
    while True:
        rows, opened = archive.page_after(directory, "did", after, size)
        page = rows.agg(F.count("*").alias("accounts"), F.min("did").alias("first"), F.max("did").alias("last"))
        pages.append(materialize(page.select(F.lit(len(pages)).alias("page"), "*", F.lit(0 < opened < max(2, files)).alias("skips")), "page"))
        after = pages[-1].first()["last"]
        if after is None:
            return reduce(DataFrame.unionByName, pages[:-1])


@query("archive_sweep", with_tables("posts") + """SELECT 'live-' || lpad((doc_id % 5 + 1)::VARCHAR, 6, '0') || '.parquet' || CASE WHEN doc_id % 5 = 4 THEN '.tmp' ELSE '' END AS file, doc_id % 5 + 1 AS sequence,
  CASE doc_id % 5 WHEN 4 THEN 'partial' WHEN 2 THEN 'unlisted' WHEN 1 THEN 'moved' ELSE 'whole' END AS state, count(*) FILTER (WHERE doc_id % 5 NOT IN (2, 4)) > 0 AS was_listed,
  (SELECT count(*) FROM posts WHERE rkey::BIGINT % 5 <> 1) AS rows_after, 5 AS next_sequence, 4 AS listed_after FROM documents GROUP BY ALL""")
def archive_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """An archive as a crash leaves it: two whole files, one that went on to another store, one renamed but not listed, one
    never renamed, and a torn line in the manifest. The sweep finds each; what was never renamed is written again."""
    root, posts = new_path(spark, "archive"), tables.posts(spark, sf)
    part = lambda k: posts.where(F.col("rkey").cast("long") % 5 == k)
    for k in (0, 1, 3):
        archive.finalize(part(k), root, "live", k + 1)
    archive.write_archive(part(2), f"{root}/files/live-000003.parquet")
    archive.write_archive(part(4), f"{root}/files/live-000005.parquet.tmp")
    archive.write_archive(part(0), f"{root}/files/other-000009.parquet")
    partitioned.hadoop(spark, root)[1].delete(partitioned.hadoop(spark, f"{root}/files/live-000002.parquet")[0], True)
    spark.range(1).select(F.lit('{"file": "live-0000').alias("value")).write.mode("append").text(f"{root}/manifest")
    found, following = archive.sweep(spark, root, "live")
    archive.finalize(part(4), root, "live", following)
    rows = spark.read.parquet(*[f"{root}/files/live-{k:06d}.parquet" for k in (1, 3, 4, following)]).count()
    listed = archive.inventory(spark, root, "live").where("listed_rows is not null and bytes is not null").count()
    return found.select("file", "sequence", "state", F.col("listed_rows").isNotNull().alias("was_listed"), F.lit(rows).alias("rows_after"), F.lit(following).alias("next_sequence"), F.lit(listed).alias("listed_after"))


@query("enumerate_replay", "SELECT 'c' || o_custkey AS did, max(o_orderkey) AS seq, arg_max(o_orderpriority, o_orderkey) AS op, (SELECT max(o_orderkey) FROM orders) AS cursor, (SELECT count(*) FROM orders) AS operations, true AS overlapped FROM orders GROUP BY o_custkey")
def enumerate_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Operations on accounts read page by page, stopped after three pages and in the middle of the fourth, started again
    some way before the cursor: the last operation of each account, however often it was read."""
    ops = tables.read(spark, sf, "orders").selectExpr("o_orderkey as seq", "concat('c', o_custkey) as did", "o_orderpriority as op")
    size = max(1, ops.count() // 6)
    directory = archive.write_sorted(ops, "seq", new_path(spark, "listing"), max(1, size // 3))
    page = lambda cursor: archive.page_after(directory, "seq", cursor, size)[0]
    log = SnapshotLog(spark, new_path(spark, "enumeration"))
    enumeration.enumerate_pages(log, page, "ops", most=3)
    log.write(page(log.latest().cursors["ops"]), "ops")  # written, but the run stops before the commit
    enumeration.enumerate_pages(log, page, "ops", overlap=size // 2)
    read = enumeration.operations(log, "ops")
    last = archive.replay_last(read)
    n, distinct = read.agg(F.count("*"), F.count_distinct("seq")).first()
    return last.select("did", "seq", "op", F.lit(log.latest().cursors["ops"]).alias("cursor"), F.lit(distinct).alias("operations"), F.lit(n > distinct).alias("overlapped"))


@query("report_sinks", with_tables("ledger") + "SELECT pds_host, count(*) AS accounts, count(*) FILTER (WHERE status = 'failed') AS failed, true AS sorted, (SELECT count(DISTINCT did) FROM led WHERE status = 'failed') AS listed FROM led GROUP BY pds_host")
def report_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """A report as JSON lines, largest first, the same as tab-separated values, and a list of accounts, written and read back."""
    ledger, root = tables.ledger(spark, sf), new_path(spark, "reports")
    by_host = ledger.groupBy("pds_host").agg(F.count("*").alias("accounts"), F.count_if(F.col("status") == "failed").alias("failed"))
    archive.write_report(by_host, "accounts", f"{root}/report")
    archive.write_tsv(by_host, f"{root}/tsv")
    archive.write_lines(ledger.where("status = 'failed'").select(F.concat(F.lit("did:"), "did").alias("did")), "did", f"{root}/dids")
    report = spark.read.schema("pds_host string, accounts long, failed long").json(f"{root}/report")
    lines = report.select("accounts", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    jumps = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", "accounts"))).alias("r")).where("size(r) > 1 and exists(sequence(1, greatest(size(r) - 1, 1)), k -> get(r, k).accounts > get(r, k - 1).accounts)")  # a row a host
    tsv = spark.read.schema("pds_host string, accounts long, failed long").option("sep", "\t").csv(f"{root}/tsv")
    listed = archive.did_list(spark, f"{root}/dids").select("did").distinct().count()
    return tsv.join(report.select("pds_host", F.col("accounts").alias("a"), F.col("failed").alias("f")), "pds_host").where("a = accounts and f = failed").select("pds_host", "accounts", "failed", F.lit(jumps.isEmpty()).alias("sorted"), F.lit(listed).alias("listed"))
