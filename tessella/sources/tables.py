"""Logical tables derived from the given ones, and the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import TID_DIGITS, bucket_of, digest, logical_shard, tid_of
from ..schemas import STATUSES

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
GLYPHS = "[éèêàçùôîñüöäßáíóú]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from(read(spark, sf_dir, "documents"))


def posts_from(documents: DataFrame) -> DataFrame:
    """Posts: a document each, accented letters as glyphs."""
    start = "timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(0, cast(doc_id % 100000 as int))"
    return documents.selectExpr(
        "source as did", "lpad(cast(doc_id as string), 8, '0') as rkey", f"{start} as created_at", "text",
        "if(doc_id % 5 = 0, array(lang, 'unknown'), array(lang)) as langs",
        f"slice(regexp_extract_all(coalesce(text, ''), '{GLYPHS}', 0), 1, 300) as emojis",
        "if(doc_id % 4 = 0, 'live', 'backfill') as src", f"{start} + make_dt_interval(0, 0, 0, cast(n_chars as decimal(18, 6))) as ingested_at",
    )


#: Glyphs that raw events carry, by document id: as written, and in canonical form.
GLYPH_CASES = [
    ("", ""), ("\U0001f600", "\U0001f600"), ("\u2764", "\u2764\ufe0f"), ("\u2764\ufe0f", "\u2764\ufe0f"), ("\U0001f44d\U0001f3fd", "\U0001f44d\U0001f3fd"),
    ("\U0001f468\u200d\U0001f469\u200d\U0001f467\u200d\U0001f466",) * 2, ("\U0001f1e9\U0001f1ea",) * 2, ("1\ufe0f\u20e3",) * 2, ("\u260e", "\u260e\ufe0f"),
    ("\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f",) * 2,
]
#: Every fiftieth document has more glyphs than a post may hold.
GLYPH_RUNS = "if(doc_id % 50 = 1, 310, doc_id % 3 + 1)"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_from(read(spark, sf_dir, "documents"))


def raw_events_from(documents: DataFrame) -> DataFrame:
    """Raw post events, a document each: a glyph written some times behind the text, stated times in and out of the window,
    timestamp ids before and after it, languages of every shape."""
    rows = documents.selectExpr("*", "1717200000000000 + (doc_id % 100000) * 1000000 as timeUs")
    glyph = F.element_at(F.array(*[F.lit(raw) for raw, _ in GLYPH_CASES]), (F.col("doc_id") % len(GLYPH_CASES) + 1).cast("int"))
    iso = lambda seconds: F.date_format(F.timestamp_micros(F.col("timeUs") + seconds * 1_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    day = 86_400
    stated = F.when(F.col("doc_id") % 5 == 0, iso(-60)).when(F.col("doc_id") % 5 == 1, "garbage").when(F.col("doc_id") % 5 == 3, iso(2 * day - 60)).when(F.col("doc_id") % 5 == 4, iso(2 * day + 60))
    rkey = F.when(F.col("doc_id") % 4 == 2, tid_of(F.col("timeUs") - 30_000_000)).when(F.col("doc_id") % 4 == 3, tid_of(F.col("timeUs") + 10 * day * 1_000_000)).otherwise(F.concat(F.lit("k"), "doc_id"))
    langs = F.expr("element_at(array(cast(null as array<string>), cast(array() as array<string>), array('en', ' en ', '', 'ja'), array('', '  '), array(lang)), cast(doc_id % 7 % 5 + 1 as int))")
    return rows.select(
        "doc_id", F.concat(F.lit("did:"), F.coalesce("source", F.lit("none"))).alias("did"), rkey.alias("rkey"),
        F.concat(F.coalesce("text", F.lit("")), F.repeat(F.concat(F.lit(" "), glyph), F.expr(f"cast({GLYPH_RUNS} as int)"))).alias("text"),
        langs.alias("langs"), stated.alias("createdAt"), "timeUs", F.lit(None).cast("map<string,string>").alias("extras"),
    )


def posts_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts, and later versions of every tenth: a day on, glyphs reversed and less one."""
    first = posts(spark, sf_dir)
    again = first.where(F.col("rkey").cast("long") % 10 == 0)
    again = again.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).withColumn("emojis", F.expr("reverse(slice(emojis, 2, 300))"))
    return first.unionByName(again)


def repo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repo_events_from(read(spark, sf_dir, "events"))


def repo_events_from(events: DataFrame) -> DataFrame:
    """Crawl events of accounts: kind of event, host, shard, run, posts, bytes, error."""
    kinds = "map('view', 'loaded', 'signup', 'empty', 'error', 'failed', 'click', 'quarantined', 'purchase', 'unreachable')"
    errors = "map('error', 'http 451 refused', 'click', 'malformed car: unexpected eof while reading data', 'purchase', 'getaddrinfo ENOTFOUND host')"
    return events.selectExpr(
        "event_id", "cast(ts as timestamp_ntz) as ts", "concat('u', user_id) as did",
        "concat(if(user_id % 7 = 0, 'overcap-', ''), 'shard', user_id % 6) as shard",
        "element_at(array('main-a', 'main-b', 'fail-x'), cast(user_id % 3 + 1 as int)) as run_id", "concat('host', user_id % 20) as pds_host",
        f"{kinds}[event_type] as event", "coalesce(cast(get_json_object(props, '$.k') as bigint), 0) as posts",
        "cast(floor(value * 1000) as bigint) as car_bytes", f"coalesce(try_element_at({errors}, event_type), '') as error",
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots of status counts of each run and shard."""
    e = repo_events(spark, sf_dir)
    kinds = ["loaded", "empty", "failed", "quarantined", "unreachable"]
    per = e.groupBy("run_id", "shard", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(*[F.count_if(F.col("event") == k).alias(k) for k in kinds], F.count("*").alias("in_flight"))
    upto = Window.partitionBy("run_id", "shard").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("run_id", "shard")
    out = per.select("run_id", "shard", "ts", "in_flight", *[F.sum(k).over(upto).alias(k) for k in kinds], (F.sum("in_flight").over(every) - F.sum("in_flight").over(upto)).alias("pending"))
    rest = [s for s in STATUSES if s not in (*kinds, "pending")]
    return out.select("*", *[F.lit(0).cast("long").alias(s) for s in rest])


def verify_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verifier snapshots: main runs under their shard's name, the others as fail-shards."""
    p = progress(spark, sf_dir)
    total = sum((F.col(s) for s in STATUSES), F.lit(0))
    shard = F.when(F.col("run_id").startswith("fail-"), F.concat(F.lit("fail-"), logical_shard(F.col("shard")))).otherwise(logical_shard(F.col("shard")))
    return p.select(
        "ts", "run_id", shard.alias("shard"), F.when(F.col("pending") == 0, "finished").otherwise("classify").alias("phase"), total.cast("long").alias("repos_total"),
        (F.col("loaded") + F.col("empty")).alias("repos_checked"), F.col("loaded").alias("exact"), F.col("empty").alias("loose"),
        F.when(F.col("run_id").startswith("fail-"), F.lit(0)).otherwise(F.col("failed") % 3).cast("long").alias("mismatches"), F.col("empty").alias("loose_emitted"),
        F.col("quarantined").alias("sample_checked"), F.lit(0).cast("long").alias("sample_failures"), (F.col("pending") == 0).cast("int").alias("done"),
        F.when(F.col("failed") % 7 == 6, F.lit("sample failed")).otherwise("").alias("error"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An account a customer, with counts and digests of its orders."""
    own = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("posts_total"), digest(F.col("o_orderkey").cast("string")).alias("rkey_digest"))
    c = read(spark, sf_dir, "customer").join(own, F.col("c_custkey") == F.col("o_custkey"), "left")
    error = "case c_mktsegment when 'BUILDING' then 'HTTP 429 too many' when 'AUTOMOBILE' then 'getaddrinfo enotfound x' when 'MACHINERY' then 'malformed car: unexpected eof while reading data' when 'HOUSEHOLD' then 'RepoNotFound' end"
    out = c.selectExpr("c_custkey", "concat('c', c_custkey) as did", "concat('host', c_nationkey) as pds_host", f"element_at(array({', '.join(repr(s) for s in STATUSES)}), cast(c_custkey % 11 + 1 as int)) as status",
                       "c_custkey % 7 as attempts", "c_custkey * 1000 as retry_after", f"{error} as error", "posts_total", "rkey_digest", "if(c_custkey % 11 in (2, 3), 1700000000000 + c_custkey * 1000, null) as loaded_at")
    return out.withColumn("bucket", bucket_of(F.col("did")))


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the verifier expects of each account; some rows lack a digest."""
    return ledger(spark, sf_dir).selectExpr("did", "status", "coalesce(posts_total, 0) as expected_posts", "if(c_custkey % 13 = 0, '', coalesce(rkey_digest, '')) as expected_digest", "pds_host", "bucket", "loaded_at")


def actual_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored keys: some lost, some swapped, some repeated, some of unknown accounts. The orders are scanned once."""
    row = lambda when, did, rkey, src: f"if({when}, struct(concat('{did}', o_custkey) as did, {rkey} as rkey, '{src}' as src), null)"
    key = "cast(o_orderkey as string)"
    kept = row("o_orderkey % 997 <> 0", "c", f"if(o_orderkey % 991 = 0, concat('x', o_orderkey), {key})", "backfill")
    again = row("o_orderkey % 997 <> 0 and o_orderkey % 991 <> 0 and o_orderkey % 5 = 0", "c", key, "live")
    orphan = row("o_custkey % 500 = 0", "orphan", key, "backfill")
    return read(spark, sf_dir, "orders").selectExpr(f"inline(array_compact(array({kept}, {again}, {orphan})))")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that hosts list, with activity."""
    states = "element_at(array(null, 'takendown', 'suspended', 'deactivated', 'odd'), cast(c_custkey % 5 + 1 as int))"
    return read(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").selectExpr("concat('host', c_nationkey) as host", "concat('c', c_custkey) as did", "c_custkey % 4 <> 1 as active", f"{states} as state")


# ---- the same tables for DuckDB, as common table expressions

def tid_sql(micros: str) -> str:
    """The timestamp id of a time in microseconds, in SQL."""
    return f"array_to_string(list_transform(range(12, -1, -1), lambda k: substr('{TID_DIGITS}', (((({micros}) << 10) >> (5 * k)) & 31)::INT + 1, 1)), '')"


def _glyph_list(k: int) -> str:
    return "[" + ", ".join(f"'{case[k]}'" for case in GLYPH_CASES) + "]"


_START = "TIMESTAMP '2023-01-01' + to_hours((doc_id % 100000)::INT)"
SQL = {
    "raw": f"""raw0 AS (SELECT *, 1717200000000000 + (doc_id % 100000) * 1000000 AS us, CASE WHEN doc_id % 10 = 0 THEN 0 WHEN doc_id % 50 = 1 THEN 310 ELSE doc_id % 3 + 1 END AS runs FROM documents),
raw AS (SELECT doc_id, 'did:' || coalesce(source, 'none') AS did, make_timestamp(us) AS received, runs,
  CASE doc_id % 4 WHEN 2 THEN {tid_sql("us - 30000000")} WHEN 3 THEN {tid_sql("us + 864000000000")} ELSE 'k' || doc_id END AS rkey,
  {_glyph_list(0)}[(doc_id % 10)::INT + 1] AS written, {_glyph_list(1)}[(doc_id % 10)::INT + 1] AS glyph, CASE doc_id % 7 % 5 WHEN 2 THEN 'en|ja' WHEN 4 THEN coalesce(nullif(trim(lang), ''), 'unknown') ELSE 'unknown' END AS langs,
  CASE WHEN doc_id % 5 = 0 THEN make_timestamp(us - 60000000) WHEN doc_id % 5 = 3 THEN make_timestamp(us + 172740000000) WHEN doc_id % 4 = 2 THEN make_timestamp(us - 30000000) ELSE make_timestamp(us) END AS created_at,
  CASE WHEN doc_id % 5 IN (0, 3) THEN '' WHEN doc_id % 4 = 2 THEN 'createdat-tid-fallback' ELSE 'createdat-receive-fallback' END AS time_anomaly FROM raw0)""",
    "posts": f"""posts AS (SELECT source AS did, lpad(doc_id::VARCHAR, 8, '0') AS rkey, {_START} AS created_at, text,
  CASE WHEN doc_id % 5 = 0 THEN [lang, 'unknown'] ELSE [lang] END AS langs, regexp_extract_all(coalesce(text, ''), '{GLYPHS}')[1:300] AS emojis,
  CASE WHEN doc_id % 4 = 0 THEN 'live' ELSE 'backfill' END AS src, {_START} + to_seconds(n_chars) AS ingested_at FROM documents)""",
    "emojis": """emo AS (SELECT did, rkey, date_trunc('hour', created_at) AS hour, langs, emoji, len(list_filter(emojis, lambda x: x = emoji)) AS occ
  FROM (SELECT *, unnest(list_distinct(emojis)) AS emoji FROM posts))""",
    "events": """ev AS (SELECT event_id, ts::TIMESTAMP AS ts, 'u' || user_id AS did, (CASE WHEN user_id % 7 = 0 THEN 'overcap-' ELSE '' END) || 'shard' || (user_id % 6) AS shard,
  ['main-a', 'main-b', 'fail-x'][user_id % 3 + 1] AS run_id, 'host' || (user_id % 20) AS pds_host,
  CASE event_type WHEN 'view' THEN 'loaded' WHEN 'signup' THEN 'empty' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'quarantined' WHEN 'purchase' THEN 'unreachable' END AS event,
  coalesce(json_extract_string(props, '$.k')::BIGINT, 0) AS posts, floor(value * 1000)::BIGINT AS car_bytes,
  CASE event_type WHEN 'error' THEN 'http 451 refused' WHEN 'click' THEN 'malformed car: unexpected eof while reading data' WHEN 'purchase' THEN 'getaddrinfo ENOTFOUND host' ELSE '' END AS error FROM events)""",
    "progress": f"""pr0 AS (SELECT run_id, shard, date_trunc('hour', ts) AS ts, {', '.join(f"count(*) FILTER (WHERE event = '{k}') AS {k}" for k in ("loaded", "empty", "failed", "quarantined", "unreachable"))}, count(*) AS in_flight FROM ev GROUP BY ALL),
pr AS (SELECT run_id, shard, ts, in_flight, {', '.join(f"(sum({k}) OVER u)::BIGINT AS {k}" for k in ("loaded", "empty", "failed", "quarantined", "unreachable"))},
  (sum(in_flight) OVER (PARTITION BY run_id, shard) - sum(in_flight) OVER u)::BIGINT AS pending, {', '.join(f'0::BIGINT AS {k}' for k in ("fetching", "verified", "tombstoned", "deactivated", "takendown"))}
  FROM pr0 WINDOW u AS (PARTITION BY run_id, shard ORDER BY ts ROWS UNBOUNDED PRECEDING))""",
    "verify": f"""vp AS (SELECT ts, run_id, (CASE WHEN starts_with(run_id, 'fail-') THEN 'fail-' ELSE '' END) || regexp_replace(shard, '^(overcap-long-|overcap-)shard', 'shard') AS shard,
  CASE WHEN pending = 0 THEN 'finished' ELSE 'classify' END AS phase, ({' + '.join(STATUSES)})::BIGINT AS repos_total, loaded + empty AS repos_checked, loaded AS exact, empty AS loose,
  CASE WHEN starts_with(run_id, 'fail-') THEN 0 ELSE failed % 3 END AS mismatches, empty AS loose_emitted, quarantined AS sample_checked, 0 AS sample_failures, (pending = 0)::INT AS done,
  CASE WHEN failed % 7 = 6 THEN 'sample failed' ELSE '' END AS error FROM pr)""",
    "ledger": f"""kh AS (SELECT o_custkey, ('0x' || substr(h, 15, 2) || substr(h, 13, 2) || substr(h, 11, 2) || substr(h, 9, 2) || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::UBIGINT AS k
  FROM (SELECT o_custkey, sha256(o_orderkey::VARCHAR) AS h FROM orders)),
own AS (SELECT o_custkey, count(*) AS posts_total, lpad(lower(to_hex(bit_xor(k))), 16, '0') AS rkey_digest FROM kh GROUP BY o_custkey),
led AS (SELECT c_custkey, 'c' || c_custkey AS did, 'host' || c_nationkey AS pds_host, [{', '.join(repr(s) for s in STATUSES)}][c_custkey % 11 + 1] AS status, c_custkey % 7 AS attempts, c_custkey * 1000 AS retry_after,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'HTTP 429 too many' WHEN 'AUTOMOBILE' THEN 'getaddrinfo enotfound x' WHEN 'MACHINERY' THEN 'malformed car: unexpected eof while reading data' WHEN 'HOUSEHOLD' THEN 'RepoNotFound' END AS error,
  posts_total, rkey_digest, CASE WHEN c_custkey % 11 IN (2, 3) THEN 1700000000000 + c_custkey * 1000 END AS loaded_at,
  ((unicode(right('c' || c_custkey, 1)) + 31 * unicode(left(right('c' || c_custkey, 2), 1)) * (length('c' || c_custkey) >= 2)::INT + 961 * unicode(left(right('c' || c_custkey, 3), 1)) * (length('c' || c_custkey) >= 3)::INT) % 6)::BIGINT AS bucket
  FROM customer LEFT JOIN own ON c_custkey = o_custkey)""",
    "expected": """exp AS (SELECT did, status, coalesce(posts_total, 0) AS expected_posts, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE coalesce(rkey_digest, '') END AS expected_digest, pds_host, bucket, loaded_at FROM led)""",
    "actual": """act AS (SELECT 'c' || o_custkey AS did, CASE WHEN o_orderkey % 991 = 0 THEN 'x' || o_orderkey ELSE o_orderkey::VARCHAR END AS rkey, 'backfill' AS src FROM orders WHERE o_orderkey % 997 <> 0
  UNION ALL SELECT 'c' || o_custkey, o_orderkey::VARCHAR, 'live' FROM orders WHERE o_orderkey % 997 <> 0 AND o_orderkey % 991 <> 0 AND o_orderkey % 5 = 0
  UNION ALL SELECT 'orphan' || o_custkey, o_orderkey::VARCHAR, 'backfill' FROM orders WHERE o_custkey % 500 = 0)""",
    "classified": """ad AS (SELECT did, count(*) AS actual_posts, lpad(lower(to_hex(bit_xor(('0x' || substr(h, 15, 2) || substr(h, 13, 2) || substr(h, 11, 2) || substr(h, 9, 2) || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::UBIGINT))), 16, '0') AS actual_digest
  FROM (SELECT did, sha256(rkey) AS h FROM (SELECT DISTINCT did, rkey FROM act WHERE did IN (SELECT did FROM exp))) GROUP BY did),
cl AS (SELECT exp.*, coalesce(ad.actual_posts, 0) AS actual_posts, coalesce(ad.actual_digest, '') AS actual_digest,
  CASE WHEN expected_digest <> '' AND coalesce(ad.actual_posts, 0) = expected_posts AND coalesce(ad.actual_digest, '') = expected_digest THEN 'exact'
       WHEN expected_digest <> '' AND expected_posts > 0 AND coalesce(ad.actual_posts, 0) = expected_posts THEN 'digest-mismatch'
       WHEN coalesce(ad.actual_posts, 0) < expected_posts THEN 'count-short' ELSE 'loose' END AS result
  FROM exp LEFT JOIN ad USING (did))""",
    "listing": """li AS (SELECT 'host' || c_nationkey AS host, 'c' || c_custkey AS did, c_custkey % 4 <> 1 AS active, [NULL, 'takendown', 'suspended', 'deactivated', 'odd'][c_custkey % 5 + 1] AS state FROM customer WHERE c_custkey % 3 <> 0)""",
}
_NEEDS = {"emojis": ["posts"], "progress": ["events"], "verify": ["events", "progress"], "expected": ["ledger"], "classified": ["ledger", "expected", "actual"]}


def with_tables(*names: str) -> str:
    """A WITH clause that holds the named tables and those that they need."""
    order: list[str] = []
    for name in names:
        for n in (*_NEEDS.get(name, []), name):
            if n not in order:
                order.append(n)
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n"
