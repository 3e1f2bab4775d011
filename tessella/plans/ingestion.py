"""Normalization of raw events: glyphs, times, languages, and the rollups of what comes out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import glyphs, scalars
from ..functions.scalars import strings_of_json
from ..operators import aggregates as A
from ..operators.posts import archive_rows, normalize, text_policy
from ..schemas import EMOJI_CAP
from ..sources import tables
from ..sources.tables import with_tables
from .registry import query

_RAW = with_tables("raw")
_JOINED = lambda column, most="runs": f"array_to_string(list_transform(range({most}), lambda k: {column}), '|')"


@query("emoji_extract", _RAW + f"SELECT doc_id, runs::INT AS n_emojis, {_JOINED('written')} AS emojis FROM raw")
def emoji_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Glyphs as they are written in each text, in order."""
    rows = tables.raw_events(spark, sf).select("doc_id", glyphs.extract_emojis(F.col("text")).alias("e"))
    return rows.select("doc_id", F.size("e").alias("n_emojis"), F.array_join("e", "|").alias("emojis"))


_POINTS = lambda glyph: f"array_to_string(list_transform(string_split({glyph}, ''), lambda c: printf('%04x', unicode(c))), ' ')"


@query("emoji_normalize", _RAW + f"SELECT glyph AS emoji, {_POINTS('glyph')} AS points, glyph AS again, count(*) AS posts, sum(runs)::BIGINT AS occurrences FROM raw WHERE runs > 0 GROUP BY glyph")
def emoji_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical forms with their code points, there and back, and how often they occur."""
    rows = tables.raw_events(spark, sf).select("doc_id", F.transform(glyphs.extract_emojis(F.col("text")), glyphs.normalize_emoji).alias("e"))
    each = rows.select("doc_id", F.explode("e").alias("emoji")).groupBy("doc_id", "emoji").agg(F.count("*").alias("n"))
    by = each.groupBy("emoji").agg(F.count("*").alias("posts"), F.sum("n").alias("occurrences"))
    points = glyphs.code_points(F.col("emoji"))
    return by.select("emoji", points.alias("points"), glyphs.from_code_points(points).alias("again"), "posts", "occurrences")


@query("created_at_resolve", _RAW + "SELECT doc_id, created_at, time_anomaly AS anomaly FROM raw")
def created_at_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Stated time in the window, else the time of the id, else the time of receipt."""
    rows = normalize(tables.raw_events(spark, sf).withColumn("text", F.lit("")).withColumn("did", F.col("doc_id").cast("string")))
    return rows.select(F.col("did").cast("long").alias("doc_id"), "created_at", F.array_join("anomalies", "|").alias("anomaly"))


@query("posts_normalized", _RAW + f"SELECT did, rkey, created_at, langs, least(runs, {EMOJI_CAP})::INT AS n_emojis, received AS ingested_at, array_to_string(list_filter([time_anomaly, CASE WHEN runs > {EMOJI_CAP} THEN 'emoji-truncated' ELSE '' END], lambda x: x <> ''), '|') AS anomalies, runs > 0 AS has_text FROM raw")
def posts_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Whole posts, with the cap and its anomaly; texts without a glyph are not kept."""
    rows = text_policy(normalize(tables.raw_events(spark, sf)))
    return rows.select("did", "rkey", "created_at", F.array_join("langs", "|").alias("langs"), F.size("emojis").alias("n_emojis"), "ingested_at", F.array_join("anomalies", "|").alias("anomalies"), (F.col("text") != "").alias("has_text"))


@query("emoji_total_normalized", _RAW + f"SELECT glyph AS emoji, sum(least(runs, {EMOJI_CAP}))::BIGINT AS occurrences, count(*) AS posts FROM raw WHERE runs > 0 GROUP BY glyph")
def emoji_total_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return A.emoji_total(normalize(tables.raw_events(spark, sf)))


@query("archive_extras", "SELECT count(*) AS rows, count(*) FILTER (WHERE event_id % 2 = 0) AS with_facets, count(*) FILTER (WHERE event_id % 2 <> 0) AS blank_facets, count(*) AS blank_reply, sum(CASE event_id % 3 WHEN 0 THEN 2 ELSE 0 END)::BIGINT AS langs FROM events")
def archive_extras(spark: SparkSession, sf: str) -> DataFrame:
    """Nested extras as JSON text, absent ones blank; language lists read from JSON, bad ones empty."""
    langs = F.when(F.col("event_id") % 3 == 0, '["en", "ja"]').when(F.col("event_id") % 3 == 1, '{"en": 1}').otherwise("oops")
    extras = F.struct(F.when(F.col("event_id") % 2 == 0, F.struct(F.col("value").alias("at"))).alias("facets"), *[F.lit(None).cast("struct<x:int>").alias(c) for c in ("reply", "embed", "labels")])
    rows = tables.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("did"), F.col("event_id").cast("string").alias("rkey"), F.col("ts").cast("timestamp_ntz").alias("created_at"), F.lit("").alias("text"),
        strings_of_json(langs).alias("langs"), F.array().cast("array<string>").alias("emojis"), F.lit("live").alias("src"), extras.alias("extras"),
    )
    out = archive_rows(rows, "extras")
    return out.agg(F.count("*").alias("rows"), F.count_if(F.col("facets").startswith('{"at"')).alias("with_facets"), F.count_if(F.col("facets") == "").alias("blank_facets"), F.count_if(F.col("reply") == "").alias("blank_reply"), F.sum(F.size("langs")).alias("langs"))


_ENDS = "WITH u AS (SELECT page_id, lower(split_part(url, '://', 1)) AS scheme, lower(split_part(split_part(url, '://', 2), '/', 1)) AS host FROM pages) "


@query("hosts_canonical", _ENDS + """SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL ELSE CASE scheme WHEN 'http' THEN 'http://' ELSE '' END || host ||
  CASE WHEN page_id % 4 = 2 THEN ':8443' WHEN page_id % 4 = 1 AND scheme = 'http' THEN ':443' ELSE '' END END AS host FROM u""")
def hosts_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Endpoints of every spelling: upper case, the scheme's port, another port, none at all."""
    rows = tables.read(spark, sf, "pages").selectExpr("page_id", "url", "split_part(url, '://', 1) as scheme", "split_part(split_part(url, '://', 2), '/', 1) as host")
    end = F.expr("case page_id % 4 when 0 then url when 1 then upper(scheme) || '://' || upper(host) || ':443/x' when 2 then scheme || '://me@' || host || ':8443' else 'no url' end")
    return rows.select("page_id", scalars.canonical_host(end).alias("host"))


@query("fetch_outcomes", """WITH e AS (SELECT event_id, [400, 404, 429, 503, 302][(event_id % 5)::INT + 1] AS status, ['RepoTakendown', 'RepoDeactivated', 'RepoNotFound', '', 'Other'][(event_id % 7 % 5)::INT + 1] AS error FROM events)
SELECT event_id, CASE error WHEN 'RepoTakendown' THEN 'takendown' WHEN 'RepoDeactivated' THEN 'deactivated' WHEN 'RepoNotFound' THEN 'failed' ELSE CASE WHEN status IN (429, 503, 302) THEN 'retry' ELSE 'failed' END END AS outcome,
  least(60 * 2.0 ** (event_id % 12), 3600)::DOUBLE AS delay, CASE event_id % 3 WHEN 0 THEN event_id % 500 WHEN 1 THEN greatest(event_id % 100 - 20, 0) ELSE 0 END::DOUBLE AS retry_after FROM e""")
def fetch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Terminal state of each failed fetch, backoff by attempts, and the Retry-After header as seconds or as a date."""
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))
    e, ts = F.col("event_id"), F.col("ts").cast("timestamp_ntz")
    date = F.concat(F.date_format(ts + F.make_dt_interval(secs=(e % 100 - 20)), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    header = F.when(e % 3 == 0, (e % 500).cast("string")).when(e % 3 == 1, date).otherwise("soon")
    outcome = scalars.http_outcome(pick([400, 404, 429, 503, 302], e % 5), pick(["RepoTakendown", "RepoDeactivated", "RepoNotFound", "", "Other"], e % 7 % 5))
    return tables.read(spark, sf, "events").select("event_id", outcome.alias("outcome"), scalars.retry_delay(e % 12, 60, 3600).alias("delay"), scalars.retry_after_seconds(header, scalars.floor_seconds(ts, F.lit(1))).alias("retry_after"))


@query("crawl_eta", "SELECT event_id, round(CASE WHEN event_id % 5 > 0 THEN event_id / (event_id % 5) / 60.0 END, 6) AS hours, CASE WHEN s >= 86400 THEN (s // 86400) || 'd ' || (s % 86400 // 3600) || 'h' WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS left FROM (SELECT event_id, event_id * 37 AS s FROM events)")
def crawl_eta(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return tables.read(spark, sf, "events").select(e, F.round(scalars.eta_hours(e, e % 5), 6).alias("hours"), scalars.human_duration(e * 37).alias("left"))


@query("lang_flags", "SELECT lang, CASE lang WHEN 'en' THEN '\U0001f1fa\U0001f1f8' WHEN 'fr' THEN '\U0001f1eb\U0001f1f7' WHEN 'de' THEN '\U0001f1e9\U0001f1ea' WHEN 'es' THEN '\U0001f1ea\U0001f1f8' ELSE '\U0001f3f3\ufe0f' END AS flag, count(*) AS posts FROM documents GROUP BY lang")
def lang_flags(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("posts")).select("lang", scalars.flag_of(F.col("lang")).alias("flag"), "posts")
