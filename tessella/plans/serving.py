"""Posts, rollups and the queries that serve them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import aggregates as A
from ..operators import posts as P
from ..operators.rollups import aligned_cutoff, compare_measures, repaired
from ..schemas import TOP_EMOJIS, TOP_LANGUAGES
from ..sources import archive, tables
from ..sources.tables import with_tables
from ..storage import new_path
from .registry import query

_POSTS, _EMO = with_tables("posts"), with_tables("posts", "emojis")
_LANGS = "(SELECT *, unnest(langs) AS lang FROM emo)"


@query("posts_last_wins", """
SELECT l_orderkey, l_linenumber, l_shipdate::TIMESTAMP AS l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""")
def posts_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return P.last_wins(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


@query("posts_final", f"""{_POSTS}, dup AS (SELECT did, rkey, ingested_at, emojis FROM posts UNION ALL
  SELECT did, rkey, ingested_at + INTERVAL 1 DAY, list_reverse(emojis[2:300]) FROM posts WHERE rkey::BIGINT % 10 = 0)
SELECT did, rkey, max(ingested_at) AS ingested_at, len(arg_max(emojis, ingested_at))::INT AS n_emojis FROM dup GROUP BY did, rkey""")
def posts_final(spark: SparkSession, sf: str) -> DataFrame:
    return P.posts_final(tables.posts_dup(spark, sf)).select("did", "rkey", "ingested_at", F.size("emojis").alias("n_emojis"))


@query("emoji_hourly", _EMO + "SELECT hour, emoji, sum(occ)::BIGINT AS occurrences, count(*) AS posts FROM emo GROUP BY hour, emoji")
def emoji_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_hourly(tables.posts(spark, sf))


@query("emoji_hourly_by_lang", _EMO + f"SELECT lang, hour, emoji, sum(occ)::BIGINT AS occurrences, count(*) AS posts FROM {_LANGS} GROUP BY lang, hour, emoji")
def emoji_hourly_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_hourly_by_lang(tables.posts(spark, sf))


_HOURLY = "SELECT date_trunc('hour', created_at) AS hour, count(*) AS posts, count(*) FILTER (WHERE len(emojis) > 0) AS posts_with_emojis, sum(len(emojis))::BIGINT AS emoji_occurrences FROM posts GROUP BY 1"


@query("posts_hourly", _POSTS + _HOURLY)
def posts_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return A.posts_hourly(tables.posts(spark, sf))


_TOTAL = "SELECT emoji, sum(occ)::BIGINT AS occurrences, count(*) AS posts FROM emo GROUP BY emoji"


@query("emoji_total", _EMO + _TOTAL)
def emoji_total(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_total(tables.posts(spark, sf))


_BY_LANG = f"SELECT lang, emoji, sum(occ)::BIGINT AS occurrences, count(*) AS posts FROM {_LANGS} GROUP BY lang, emoji"


@query("emoji_total_by_lang", _EMO + _BY_LANG)
def emoji_total_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_total_by_lang(tables.posts(spark, sf))


_LANG_TOTAL = "SELECT lang, sum(len(emojis))::BIGINT AS occurrences, count(*) AS posts FROM (SELECT *, unnest(langs) AS lang FROM posts WHERE len(emojis) > 0) GROUP BY lang"


@query("lang_total", _POSTS + _LANG_TOTAL)
def lang_total(spark: SparkSession, sf: str) -> DataFrame:
    return A.lang_total(tables.posts(spark, sf))


_LIVE = "SELECT date_trunc('second', ingested_at) AS second, count(*) AS posts FROM posts WHERE src = 'live' GROUP BY 1"


@query("live_ingest_second", _POSTS + _LIVE)
def live_ingest_second(spark: SparkSession, sf: str) -> DataFrame:
    return A.live_ingest_second(tables.posts(spark, sf))


@query("top_emojis", _EMO + f"SELECT emoji, sum(occ)::BIGINT AS count FROM emo GROUP BY emoji ORDER BY count DESC, emoji LIMIT {TOP_EMOJIS}")
def top_emojis(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_total(tables.posts(spark, sf)).select("emoji", F.col("occurrences").alias("count")).orderBy(F.desc("count"), "emoji").limit(TOP_EMOJIS)


@query("global_counters", _POSTS + "SELECT count(*) AS posts, coalesce(sum(len(emojis)), 0)::BIGINT AS emojis, count(*) FILTER (WHERE len(emojis) > 0) AS posts_with, count(*) FILTER (WHERE len(emojis) = 0) AS posts_without FROM posts")
def global_counters(spark: SparkSession, sf: str) -> DataFrame:
    sums = {m: F.coalesce(F.sum(m), F.lit(0)) for m in ("posts", "posts_with_emojis", "emoji_occurrences")}
    return A.posts_hourly(tables.posts(spark, sf)).agg(
        sums["posts"].alias("posts"), sums["emoji_occurrences"].alias("emojis"), sums["posts_with_emojis"].alias("posts_with"), (sums["posts"] - sums["posts_with_emojis"]).alias("posts_without")
    )


@query("top_languages", _POSTS + f"SELECT lang AS language, occurrences AS count FROM ({_LANG_TOTAL}) ORDER BY count DESC, language LIMIT {TOP_LANGUAGES}")
def top_languages(spark: SparkSession, sf: str) -> DataFrame:
    return A.lang_total(tables.posts(spark, sf)).select(F.col("lang").alias("language"), F.col("occurrences").alias("count")).orderBy(F.desc("count"), "language").limit(TOP_LANGUAGES)


@query("top_emojis_for_lang", _EMO + f"SELECT emoji, occurrences AS count FROM ({_BY_LANG}) WHERE lang = 'fr' ORDER BY count DESC, emoji LIMIT 10")
def top_emojis_for_lang(spark: SparkSession, sf: str) -> DataFrame:
    """The language and the limit are bound as parameters, never written into the text."""
    text = "SELECT emoji, occurrences AS count FROM {rollup} WHERE lang = :lang ORDER BY count DESC, emoji LIMIT :k"
    return spark.sql(text, args={"lang": "fr", "k": 10}, rollup=A.emoji_total_by_lang(tables.posts(spark, sf)))


@query("emoji_ratio", _POSTS + "SELECT count(*) AS posts, count(*) FILTER (WHERE len(emojis) > 0) AS with_emojis, CASE WHEN count(*) > 0 THEN printf('%.4f', count(*) FILTER (WHERE len(emojis) > 0) / count(*)) ELSE 'N/A' END AS ratio FROM posts")
def emoji_ratio(spark: SparkSession, sf: str) -> DataFrame:
    c = global_counters(spark, sf)
    return c.select("posts", F.col("posts_with").alias("with_emojis"), scalars.ratio(F.col("posts_with"), F.col("posts")).alias("ratio"))


def live_rates_of(live: DataFrame, as_of: DataFrame) -> DataFrame:
    rows = live.join(F.broadcast(as_of), F.lit(True))  # a row
    recent = rows.where(F.col("second") >= F.col("as_of") - F.expr("INTERVAL 15 MINUTES"))
    one = F.sum(F.when(F.col("second") >= F.col("as_of") - F.expr("INTERVAL 1 MINUTE"), F.col("posts")))
    return recent.agg((F.coalesce(one, F.lit(0)) / 60).alias("posts_per_sec_1m"), (F.coalesce(F.sum("posts"), F.lit(0)) / 900).alias("posts_per_sec_15m"))


@query("live_rates", _POSTS + f", live AS ({_LIVE}), a AS (SELECT max(second) AS t FROM live) SELECT coalesce(sum(posts) FILTER (WHERE second >= t - INTERVAL 1 MINUTE), 0) / 60 AS posts_per_sec_1m, coalesce(sum(posts), 0) / 900 AS posts_per_sec_15m FROM live, a WHERE second >= t - INTERVAL 15 MINUTE")
def live_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates at the time of the last live second; as_of is one row."""
    live = A.live_ingest_second(tables.posts(spark, sf))
    return live_rates_of(live, live.agg(F.max("second").alias("as_of")))


@query("freshness", _POSTS + f", live AS ({_LIVE}) SELECT greatest(date_diff('second', (SELECT max(second) FROM live), (SELECT date_trunc('second', max(ingested_at)) FROM posts)), 0)::BIGINT AS freshness_s")
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds from the last live post to the last post of any source."""
    last = F.max(F.when(F.col("src") == "live", F.date_trunc("second", "ingested_at")))
    rows = tables.posts(spark, sf).agg(last.alias("live"), F.max(F.date_trunc("second", "ingested_at")).alias("every"))
    return rows.select(F.greatest(F.timestamp_diff("SECOND", F.col("live"), F.col("every")), F.lit(0)).cast("long").alias("freshness_s"))


@query("totals_distinct_glyphs", _POSTS + "SELECT count(*) AS posts, count(*) FILTER (WHERE len(emojis) > 0) AS posts_with_emojis, sum(len(emojis))::BIGINT AS emoji_occurrences, (SELECT count(DISTINCT e) FROM (SELECT unnest(emojis) AS e FROM posts)) AS distinct_glyphs, round(count(*) FILTER (WHERE len(emojis) > 0) / count(*), 6) AS share FROM posts")
def totals_distinct_glyphs(spark: SparkSession, sf: str) -> DataFrame:
    posts = tables.posts(spark, sf)
    glyphs = A.emoji_total(posts).agg(F.count_distinct("emoji").alias("distinct_glyphs"))
    sums = A.posts_hourly(posts).agg(*[F.sum(m).alias(m) for m in ("posts", "posts_with_emojis", "emoji_occurrences")])
    return sums.join(F.broadcast(glyphs), F.lit(True)).withColumn("share", F.round(scalars.share(F.col("posts_with_emojis"), F.col("posts")), 6))  # a row each


@query("top10_emojis", _EMO + f"SELECT * FROM ({_TOTAL}) ORDER BY occurrences DESC, emoji LIMIT 10")
def top10_emojis(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_total(tables.posts(spark, sf)).orderBy(F.desc("occurrences"), "emoji").limit(10)


@query("top8_languages", _POSTS + f"SELECT * FROM ({_LANG_TOTAL}) ORDER BY occurrences DESC, lang LIMIT 8")
def top8_languages(spark: SparkSession, sf: str) -> DataFrame:
    return A.lang_total(tables.posts(spark, sf)).orderBy(F.desc("occurrences"), "lang").limit(8)


@query("last_24h_zero_filled", _POSTS + f", h AS ({_HOURLY}), a AS (SELECT max(hour) - INTERVAL 5 HOUR AS t FROM h), c AS (SELECT t - to_hours(n::INT) AS hour FROM a, range(0, 24) r(n)) SELECT hour, coalesce(posts, 0)::BIGINT AS posts, coalesce(posts_with_emojis, 0)::BIGINT AS posts_with_emojis FROM c LEFT JOIN h USING (hour)")
def last_24h(spark: SparkSession, sf: str) -> DataFrame:
    """24 hours up to an end five hours before the last one, so that later posts must stay out; empty hours are zero."""
    hourly = A.posts_hourly(tables.posts(spark, sf))
    end = hourly.agg((F.max("hour") - F.expr("INTERVAL 5 HOURS")).alias("end"))
    hours = end.select(F.explode(F.sequence(F.col("end") - F.expr("INTERVAL 23 HOURS"), F.col("end"), F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return hours.join(hourly, "hour", "left").select("hour", zero("posts"), zero("posts_with_emojis"))


@query("monthly_histogram", _POSTS + ", m AS (SELECT date_trunc('month', created_at)::DATE AS month, count(*) AS n FROM posts GROUP BY 1), b AS (SELECT max(month) AS z FROM m), c AS (SELECT unnest(generate_series(TIMESTAMP '2023-01-01', z::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM b) SELECT month, coalesce(n, 0)::BIGINT AS posts FROM c LEFT JOIN m USING (month)")
def monthly_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Posts a month, zero-filled from January 2023 to the last month."""
    by = tables.posts(spark, sf).groupBy(F.trunc(F.col("created_at").cast("date"), "month").alias("month")).agg(F.count("*").alias("n"))
    months = by.agg(F.max("month").alias("z")).select(F.explode(F.sequence(F.lit("2023-01-01").cast("date"), F.col("z"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return months.join(by, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("posts"))


@query("fun_facts", _EMO + f", t AS ({_TOTAL}) SELECT emoji, occurrences, (SELECT min(hour) FROM emo) AS oldest_hour FROM t ORDER BY occurrences DESC, emoji LIMIT 10")
def fun_facts(spark: SparkSession, sf: str) -> DataFrame:
    posts = tables.posts(spark, sf)
    top = A.emoji_total(posts).orderBy(F.desc("occurrences"), "emoji").limit(10).select("emoji", "occurrences")
    oldest = posts.where(F.size("emojis") > 0).agg(F.min(scalars.hour_of(F.col("created_at"))).alias("oldest_hour"))
    return top.join(F.broadcast(oldest), F.lit(True))  # a row


@query("text_policy", _POSTS + "SELECT rkey, CASE WHEN len(emojis) > 0 THEN text ELSE '' END AS text FROM posts")
def text_policy(spark: SparkSession, sf: str) -> DataFrame:
    return P.text_policy(tables.posts(spark, sf)).select("rkey", "text")


@query("glyph_extract", _POSTS + "SELECT rkey, emojis, len(emojis)::INT AS n FROM posts")
def glyph_extract(spark: SparkSession, sf: str) -> DataFrame:
    return tables.posts(spark, sf).select("rkey", "emojis", F.size("emojis").alias("n"))


@query("lang_normalize", "SELECT doc_id, list_distinct_ordered AS langs FROM (SELECT doc_id, CASE WHEN trim(coalesce(lang, '')) = '' THEN ['unknown'] WHEN doc_id % 3 = 0 THEN ['unknown'] WHEN lower(lang) = lang OR doc_id % 2 = 0 THEN [trim(lang)] ELSE [trim(lang), lower(trim(lang))] END AS list_distinct_ordered FROM documents)")
def lang_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Languages as clients send them: padded, repeated, empty."""
    sent = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(""), F.lit("  "))).when(F.col("doc_id") % 2 == 0, F.array("lang", F.concat(F.lit(" "), "lang", F.lit(" ")))).otherwise(F.array(F.lit(""), F.col("lang"), F.lower("lang")))
    return tables.read(spark, sf, "documents").select("doc_id", scalars.normalize_langs(sent).alias("langs"))


@query("tid_decode", "SELECT event_id, epoch_us(ts::TIMESTAMP) AS micros, true AS is_tid FROM events")
def tid_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written as timestamp ids and read back."""
    rows = tables.read(spark, sf, "events").select("event_id", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")).alias("us"))
    rows = rows.select("event_id", scalars.tid_of(F.col("us"), 5).alias("tid"))
    return rows.select("event_id", scalars.tid_micros(F.col("tid")).alias("micros"), (F.length("tid") == 13).alias("is_tid"))


@query("archive_manifest", _POSTS + "SELECT count(*)::BIGINT AS rows, min(created_at) AS min_time, max(created_at) AS max_time, true AS sized FROM posts")
def archive_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Write the archive, then account for its files."""
    path = new_path(spark, "archive")
    archive.write_archive(P.archive_rows(tables.posts(spark, sf)), path)
    m = archive.manifest(spark, path)
    return m.agg(F.sum("rows").alias("rows"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"), F.coalesce(F.min(F.col("bytes") > 0), F.lit(True)).alias("sized"))


@query("recent_repair", _POSTS + f", dup AS (SELECT * FROM posts UNION ALL SELECT did, rkey, created_at, text, langs, list_reverse(emojis[2:300]), src, ingested_at + INTERVAL 1 DAY FROM posts WHERE rkey::BIGINT % 10 = 0), fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY did, rkey ORDER BY ingested_at DESC) AS r FROM dup) WHERE r = 1), cut AS (SELECT date_trunc('hour', max(created_at) - INTERVAL 2 DAY) AS t FROM posts), old AS ({_HOURLY.replace('FROM posts', 'FROM dup')}), new AS ({_HOURLY.replace('FROM posts', 'FROM fin')}) SELECT old.* FROM old, cut WHERE hour < t UNION ALL SELECT new.* FROM new, cut WHERE hour >= t")
def recent_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly deltas over-count replayed posts; the last two days are rebuilt from last versions."""
    dup, spec = tables.posts_dup(spark, sf), A.SPECS["posts_hourly"]
    last = aligned_cutoff(tables.posts(spark, sf).agg(F.max("created_at").alias("t")).select("t").scalar(), 2)
    return repaired(spec, spec.summed(spec.select(dup)), P.posts_final(dup), last)


@query("rebuild_vs_delta", _POSTS + ", dup AS (SELECT emojis FROM posts UNION ALL SELECT list_reverse(emojis[2:300]) FROM posts WHERE rkey::BIGINT % 10 = 0), fin AS (SELECT CASE WHEN rkey::BIGINT % 10 = 0 THEN list_reverse(emojis[2:300]) ELSE emojis END AS emojis FROM posts), b AS (SELECT count(*) AS posts, sum((len(emojis) > 0)::INT) AS w, sum(len(emojis)) AS o FROM dup), a AS (SELECT count(*) AS posts, sum((len(emojis) > 0)::INT) AS w, sum(len(emojis)) AS o FROM fin) SELECT m AS measure, x::BIGINT AS before, y::BIGINT AS after, (y - x)::BIGINT AS delta FROM (SELECT 'posts' AS m, b.posts AS x, a.posts AS y FROM a, b UNION ALL SELECT 'posts_with_emojis', b.w, a.w FROM a, b UNION ALL SELECT 'emoji_occurrences', b.o, a.o FROM a, b)")
def rebuild_vs_delta(spark: SparkSession, sf: str) -> DataFrame:
    dup, spec = tables.posts_dup(spark, sf), A.SPECS["posts_hourly"]
    return compare_measures(spec, spec.summed(spec.select(dup)), spec.select(P.posts_final(dup)))


@query("storage_stats")
def storage_stats(spark: SparkSession, sf: str) -> DataFrame:
    return archive.storage(spark, sf, tables.NAMES)


@query("storage_rows", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in tables.NAMES))
def storage_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each stored table; storage_stats tells their bytes as well."""
    return archive.storage(spark, sf, tables.NAMES).select("table", "rows")
