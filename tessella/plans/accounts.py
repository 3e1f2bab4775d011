"""Ledger, reconciliation and listing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import tid_of
from ..operators import ledger as L
from ..operators import verify as V
from ..sources import tables
from ..sources.tables import with_tables
from .registry import query

_LED, _CL = with_tables("ledger"), with_tables("classified")


@query("ledger_status_counts", _LED + "SELECT status, count(*) AS n, coalesce(sum(posts_total), 0)::BIGINT AS posts FROM led GROUP BY status")
def ledger_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return L.status_counts(tables.ledger(spark, sf))


@query("ledger_loaded_since", _LED + "SELECT count(*) FILTER (WHERE loaded_at >= 1700000500000) AS loaded_since, coalesce(sum(posts_total), 0)::BIGINT AS posts_total, (SELECT error FROM led WHERE error IS NOT NULL ORDER BY coalesce(loaded_at, retry_after, 0) DESC, did DESC LIMIT 1) AS last_error FROM led")
def ledger_loaded_since(spark: SparkSession, sf: str) -> DataFrame:
    latest = F.max_by("error", F.when(F.col("error").isNotNull(), F.struct(F.coalesce("loaded_at", "retry_after", F.lit(0)), F.col("did"))))
    return tables.ledger(spark, sf).agg(F.count_if(F.col("loaded_at") >= 1700000500000).alias("loaded_since"), F.coalesce(F.sum("posts_total"), F.lit(0)).alias("posts_total"), latest.alias("last_error"))


@query("ledger_hosts", _LED + "SELECT pds_host, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) AS accounts FROM led GROUP BY pds_host")
def ledger_hosts(spark: SparkSession, sf: str) -> DataFrame:
    by = tables.ledger(spark, sf).groupBy("pds_host").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count("*").alias("accounts"))
    return by.orderBy(F.desc("pending"), "pds_host")


@query("status_reasons", _LED + f"SELECT bucket, status, {L.reason_sql()} AS reason, count(*) AS n FROM led WHERE status IN ('unreachable', 'quarantined', 'failed') GROUP BY ALL")
def status_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return L.reason_counts(tables.ledger(spark, sf))


_CANDIDATES = "SELECT bucket, did, pds_host, coalesce(posts_total, 0)::BIGINT AS posts FROM led WHERE status IN ('loaded', 'verified') AND loaded_at < 1700001000000"


@query("recrawl_candidates", _LED + _CANDIDATES)
def recrawl_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return L.recrawl_candidates(tables.ledger(spark, sf), 1700001000000)


@query("recrawl_parts", "WITH RECURSIVE " + _LED.removeprefix("WITH ") + ", c AS (" + _CANDIDATES + """), o AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY posts DESC, md5(did), did) AS r FROM c),
g AS (SELECT bucket, did, pds_host, posts, r, [posts, 0, 0] AS loads, 0 AS part FROM o WHERE r = 1
  UNION ALL SELECT o.bucket, o.did, o.pds_host, o.posts, o.r, list_transform(range(1, 4), lambda k: g.loads[k] + CASE WHEN k = list_position(g.loads, list_min(g.loads)) THEN o.posts ELSE 0 END), list_position(g.loads, list_min(g.loads)) - 1 FROM g JOIN o ON o.bucket = g.bucket AND o.r = g.r + 1)
SELECT bucket, did, pds_host, posts, part::INT AS part FROM g""")
def recrawl_parts(spark: SparkSession, sf: str) -> DataFrame:
    return L.balanced_parts(L.recrawl_candidates(tables.ledger(spark, sf), 1700001000000), 3)


@query("claimable", _LED + "SELECT did, status FROM led WHERE pds_host <> 'host3' AND (status = 'pending' OR (status = 'unreachable' AND attempts < 5 AND retry_after <= 5000000)) ORDER BY status = 'unreachable', CASE WHEN status = 'unreachable' THEN retry_after END, did LIMIT 200")
def claimable(spark: SparkSession, sf: str) -> DataFrame:
    return L.claimable(tables.ledger(spark, sf), F.lit(5_000_000), 200, ["host3"]).select("did", "status")


@query("bucket_of", _LED + "SELECT did, bucket FROM led")
def bucket_of(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ledger(spark, sf).select("did", "bucket")


@query("rkey_digest", _LED + "SELECT did, rkey_digest, posts_total FROM led")
def rkey_digest(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ledger(spark, sf).select("did", "rkey_digest", "posts_total")


@query("park_dead_hosts", _LED + "SELECT did, CASE WHEN d THEN 'unreachable' ELSE status END AS status, CASE WHEN d THEN 5 ELSE attempts END AS attempts FROM (SELECT *, pds_host IN ('host1', 'host2') AND status IN ('pending', 'unreachable') AS d FROM led)")
def park_dead_hosts(spark: SparkSession, sf: str) -> DataFrame:
    led = tables.ledger(spark, sf)
    return L.park_hosts(led, led.where("pds_host in ('host1', 'host2')"), "host dead: parked").select("did", "status", "attempts")


@query("ledger_transition", _LED + "SELECT did, CASE WHEN go THEN new ELSE status END AS status, CASE WHEN go THEN CASE WHEN new = 'empty' THEN NULL ELSE error END ELSE error END AS error, go AS changed FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'empty' ELSE 'failed' END AS new, c_custkey % 3 = 0 AND status IN ('pending', 'fetching') AS go FROM led)")
def ledger_transition(spark: SparkSession, sf: str) -> DataFrame:
    """Guarded: only accounts still pending or being fetched change; empty clears the error, failed keeps it."""
    led = tables.ledger(spark, sf)
    changes = led.where("c_custkey % 3 = 0").selectExpr("did", "if(c_custkey % 2 = 0, 'empty', 'failed') as status", "cast(null as string) as error")
    return L.transition(led, changes, ["pending", "fetching"]).select("did", "status", "error", "changed")


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return V.classify(tables.expected(spark, sf), tables.actual_posts(spark, sf))


@query("reconcile_classify", _CL + "SELECT did, expected_posts, expected_digest, actual_posts, actual_digest, result FROM cl")
def reconcile_classify(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).select("did", "expected_posts", "expected_digest", "actual_posts", "actual_digest", "result")


@query("reconcile_counts", _CL + "SELECT result, count(*) AS accounts, sum(expected_posts)::BIGINT AS expected_posts, sum(actual_posts)::BIGINT AS actual_posts FROM cl GROUP BY result")
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return V.result_counts(classified(spark, sf))


@query("reconcile_examples", _CL + "SELECT result, did, expected_posts, actual_posts FROM (SELECT *, row_number() OVER (PARTITION BY result ORDER BY did) AS r FROM cl WHERE result <> 'exact') WHERE r <= 50")
def reconcile_examples(spark: SparkSession, sf: str) -> DataFrame:
    return V.examples(classified(spark, sf)).select("result", "did", "expected_posts", "actual_posts")


@query("terminal_report", _LED + "SELECT status, did FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY did) AS r FROM led WHERE status IN ('failed', 'quarantined', 'takendown', 'deactivated', 'tombstoned')) WHERE r <= 50")
def terminal_report(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    rows = tables.ledger(spark, sf).where(F.col("status").isin("failed", "quarantined", "takendown", "deactivated", "tombstoned"))
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("status").orderBy("did"))).where("r <= 50").select("status", "did")


@query("promotable", _CL + "SELECT led.did FROM led WHERE status = 'loaded' AND did IN (SELECT did FROM exp) AND did IN (SELECT did FROM cl WHERE result = 'exact')")
def promotable(spark: SparkSession, sf: str) -> DataFrame:
    exp = tables.expected(spark, sf)
    return L.promotable(tables.ledger(spark, sf), exp, classified(spark, sf)).select("did")


@query("orphans", with_tables("ledger", "expected", "actual") + "SELECT did, count(DISTINCT rkey) AS posts FROM act WHERE src = 'backfill' AND NOT EXISTS (SELECT 1 FROM exp WHERE exp.did = act.did) GROUP BY did")
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    return V.orphans(tables.actual_posts(spark, sf), tables.expected(spark, sf))


#: Accounts of every third number were never loaded to the end. Every 37th key is one of a post of an hour before or after
#: the load, which was never stored.
def _superset(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = tables.read(spark, sf, "orders")
    loaded = F.expr("if(o_custkey % 3 = 0, null, 1700000000000 + o_custkey * 1000)")
    own = o.select(F.concat(F.lit("c"), "o_custkey").alias("did"), F.col("o_orderkey").cast("string").alias("rkey"), loaded.alias("loaded_at"))
    near = F.expr("(1700000000000 + o_custkey * 1000 + if(o_orderkey % 2 = 0, 3600000, -3600000)) * 1000 + o_orderkey % 1000")
    fresh = o.where("o_orderkey % 37 = 0").select(F.concat(F.lit("c"), "o_custkey").alias("did"), tid_of(near).alias("rkey"), loaded.alias("loaded_at"))
    return V.superset_check(own.unionByName(fresh), tables.actual_posts(spark, sf))


_NEAR = "(1700000000000 + o_custkey * 1000 + CASE WHEN o_orderkey % 2 = 0 THEN 3600000 ELSE -3600000 END) * 1000 + o_orderkey % 1000"
_SETS = with_tables("actual") + f""", f AS (SELECT DISTINCT 'c' || o_custkey AS did, o_orderkey::VARCHAR AS rkey, false AS late FROM orders
  UNION SELECT 'c' || o_custkey, {tables.tid_sql(_NEAR)}, o_orderkey % 2 = 0 AND o_custkey % 3 <> 0 FROM orders WHERE o_orderkey % 37 = 0), s AS (SELECT DISTINCT did, rkey FROM act WHERE did IN (SELECT did FROM f)) """


@query("superset_missing", _SETS + "SELECT did, rkey FROM f WHERE NOT late EXCEPT SELECT did, rkey FROM s")
def superset_missing(spark: SparkSession, sf: str) -> DataFrame:
    return _superset(spark, sf)[0]


@query("superset_extra", _SETS + "SELECT did, rkey FROM s EXCEPT SELECT did, rkey FROM f")
def superset_extra(spark: SparkSession, sf: str) -> DataFrame:
    return _superset(spark, sf)[1]


@query("crash_requeue", with_tables("classified") + "SELECT led.did FROM led LEFT JOIN ad USING (did) WHERE status = 'loaded' AND loaded_at >= 1700000100000 AND NOT (CASE WHEN rkey_digest IS NULL THEN coalesce(actual_posts, 0) >= coalesce(posts_total, 0) ELSE coalesce(actual_posts = coalesce(posts_total, 0) AND actual_digest = rkey_digest, false) END)")
def crash_requeue(spark: SparkSession, sf: str) -> DataFrame:
    return V.requeue(tables.ledger(spark, sf), tables.actual_posts(spark, sf), 1700000100000)


_DIFF = with_tables("ledger", "listing") + """, d AS (SELECT led.did, led.pds_host, CASE WHEN li.did IS NULL THEN 'failed' WHEN coalesce(li.active, true) THEN NULL WHEN li.state IN ('takendown', 'suspended') THEN 'takendown' WHEN li.state = 'deactivated' THEN 'deactivated' ELSE 'failed' END AS terminal,
  CASE WHEN li.did IS NULL THEN 'not in ' || led.pds_host || ' listRepos (PLC-only DID)' ELSE led.pds_host || ' listRepos: active=false (' || coalesce(li.state, 'unknown') || ')' END AS error
  FROM led LEFT JOIN li ON li.did = led.did AND li.host = led.pds_host WHERE led.status IN ('pending', 'unreachable') AND led.pds_host IN (SELECT host FROM li)) """


@query("listing_diff", _DIFF + "SELECT did, pds_host, terminal, error FROM d WHERE terminal IS NOT NULL")
def listing_diff(spark: SparkSession, sf: str) -> DataFrame:
    return V.listing_diff(tables.ledger(spark, sf), tables.listing(spark, sf))


@query("listing_diff_hosts", _DIFF + "SELECT pds_host AS host, count(*) AS classified, count(*) FILTER (WHERE starts_with(error, 'not in ')) AS plc_only FROM d WHERE terminal IS NOT NULL GROUP BY pds_host")
def listing_diff_hosts(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.listing_diff(tables.ledger(spark, sf), tables.listing(spark, sf))
    by = rows.groupBy(F.col("pds_host").alias("host")).agg(F.count("*").alias("classified"), F.count_if(F.col("error").startswith("not in ")).alias("plc_only"))
    return by.orderBy(F.desc("classified"), "host")


@query("host_verdicts", _LED + "SELECT verdict, count(*) AS hosts, sum(pending)::BIGINT AS pending FROM (SELECT pds_host, count(*) FILTER (WHERE status = 'pending') AS pending, CASE WHEN max((error ILIKE '%enotfound%')::INT) = 1 AND count(*) FILTER (WHERE status = 'loaded') = 0 THEN 'dns-dead' WHEN count(*) FILTER (WHERE status = 'loaded') = 0 THEN 'unresponsive' ELSE 'alive' END AS verdict FROM led GROUP BY pds_host) GROUP BY verdict")
def host_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    by = tables.ledger(spark, sf).groupBy("pds_host").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "loaded").alias("loaded"), F.max(F.coalesce(F.col("error").ilike("%enotfound%"), F.lit(False))).alias("dns"))
    verdict = F.when(F.col("dns") & (F.col("loaded") == 0), "dns-dead").when(F.col("loaded") == 0, "unresponsive").otherwise("alive")
    return V.host_verdicts(by.withColumn("verdict", verdict))


@query("sample_accounts", _LED + "SELECT did FROM led WHERE status = 'loaded' ORDER BY md5(did || '/42'), did LIMIT 25")
def sample_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """A uniform sample of loaded accounts; the same seed gives the same rows."""
    return tables.ledger(spark, sf).where("status = 'loaded'").orderBy(F.md5(F.concat("did", F.lit("/42")).cast("binary")), "did").limit(25).select("did")


@query("bucket_slice", _LED + "SELECT did, bucket FROM led WHERE bucket % 4 = 1")
def bucket_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The accounts of one worker of four, by bucket."""
    return tables.ledger(spark, sf).where("bucket % 4 = 1").select("did", "bucket")


@query("batch_token", "WITH b AS (SELECT o_orderkey // 512 AS batch, string_agg('c' || o_custkey || chr(0) || o_orderkey, chr(0) ORDER BY 'c' || o_custkey, o_orderkey::VARCHAR) AS s FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders) GROUP BY 1) SELECT batch, sha1(s) AS token FROM b")
def batch_token(spark: SparkSession, sf: str) -> DataFrame:
    """Idempotence token of a batch: SHA-1 over its keys in order."""
    rows = tables.read(spark, sf, "orders").select("o_custkey", "o_orderkey").distinct().selectExpr("o_orderkey div 512 as batch", "concat('c', o_custkey) as did", "cast(o_orderkey as string) as rkey")
    keys = F.array_sort(F.collect_list(F.struct("did", "rkey")))  # at most a batch of 512 order keys
    return rows.groupBy("batch").agg(F.sha1(F.array_join(F.transform(keys, lambda k: F.concat(k.did, F.lit("\0"), k.rkey)), "\0")).alias("token"))


#: A text for every rule of every status, and two that no rule knows.
_TEXTS = [(status, pattern.replace("%", "x")) for status, rules in L.REASONS.items() for pattern, _ in rules] + [("failed", ""), ("quarantined", "new")]
_SQL_LIST = lambda k: "[" + ", ".join(f"'{t[k]}'" for t in _TEXTS) + "]"


@query("reason_labels", f"WITH e AS (SELECT event_id, {_SQL_LIST(0)}[(event_id % {len(_TEXTS)})::INT + 1] AS status, {_SQL_LIST(1)}[(event_id % {len(_TEXTS)})::INT + 1] AS error FROM events) SELECT status, {L.reason_sql()} AS reason, count(*) AS n FROM e GROUP BY ALL")
def reason_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of every kind under the rules of their status."""
    pick = lambda k: F.element_at(F.array(*[F.lit(t[k]) for t in _TEXTS]), (F.col("event_id") % len(_TEXTS) + 1).cast("int"))
    rows = tables.read(spark, sf, "events").select(pick(0).alias("status"), pick(1).alias("error"))
    return rows.groupBy("status", L.reason().alias("reason")).agg(F.count("*").alias("n"))


@query("accounts_touched", with_tables("events") + "SELECT pds_host, least(count(DISTINCT did), 5) AS touched, count(DISTINCT did) > 5 AS more FROM ev WHERE event = 'loaded' GROUP BY pds_host")
def accounts_touched(spark: SparkSession, sf: str) -> DataFrame:
    """How many accounts each host had loaded, counted up to a limit."""
    rows = tables.repo_events(spark, sf).where("event = 'loaded'").select("pds_host", "did").distinct()
    by = rows.groupBy("pds_host").agg(F.count("*").alias("n"))
    return by.select("pds_host", F.least(F.col("n"), F.lit(5)).alias("touched"), (F.col("n") > 5).alias("more"))
