"""Closed registries and table schemas. Columns and SQL are generated from these, never copied."""

from __future__ import annotations

from pyspark.sql import types as T

#: States of an account in the ledger.
STATUSES = ("pending", "fetching", "loaded", "verified", "empty", "tombstoned", "deactivated", "takendown", "unreachable", "quarantined", "failed")
#: Statuses that do not count as settled for the crawl rate.
UNSETTLED = ("pending", "fetching", "unreachable")
SETTLED = tuple(s for s in STATUSES if s not in UNSETTLED)
#: Events that report a problem, and all that end a crawl of an account.
ISSUE_EVENTS = ("failed", "quarantined", "unreachable", "takendown", "deactivated")
TERMINAL_EVENTS = ("loaded", "empty", *ISSUE_EVENTS)
#: Run names that are no main run, by prefix; the legacy runs whose events may lack a run.
EXCLUDED_RUN = "dev"
EXCLUDED_PREFIXES = ("fail-", "hard-close-", "verify-", "v1-recrawl")
LEGACY_RUNS = ("whale-2026", "whale-2026-overcap", "whale-2026-overcap-long")
RECRAWL_PREFIX, LOOSE_PREFIX = "v1-recrawl", "fail-loose-recrawl-"
#: Windows, limits and targets of the serving queries.
RATE_MINUTES, IDLE_SECONDS, TIMELINE_POINTS = 10, 60, 200
TARGET_REPOS, TARGET_POSTS = 3_208_370, 478_676_984
TOP_EMOJIS, TOP_LANGUAGES, REASON_SHARDS, MAX_ATTEMPTS, BUCKETS = 3790, 30, 6, 5, 6
EMOJI_CAP, EARLIEST, FUTURE_HOURS, SEEN_HOURS, REWIND_SECONDS = 300, "2022-11-16 00:00:00", 48, 72, 120
SOURCES = ("live", "backfill")
ANOMALIES = ("createdat-tid-fallback", "createdat-receive-fallback", "emoji-truncated")
VERIFY_RESULTS = ("exact", "digest-mismatch", "count-short", "loose")

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()

POSTS = T.StructType([
    T.StructField("did", _S), T.StructField("rkey", _S), T.StructField("created_at", _TS), T.StructField("text", _S),
    T.StructField("langs", T.ArrayType(_S)), T.StructField("emojis", T.ArrayType(_S)), T.StructField("src", _S), T.StructField("ingested_at", _TS),
])
EXTRAS = ("facets", "reply", "embed", "labels")
ARCHIVE = T.StructType([*POSTS.fields[:7], *[T.StructField(c, _S) for c in EXTRAS]])
RAW_EVENT = T.StructType([
    T.StructField("did", _S), T.StructField("rkey", _S), T.StructField("text", _S), T.StructField("langs", T.ArrayType(_S)),
    T.StructField("createdAt", _S), T.StructField("timeUs", _L), T.StructField("extras", T.MapType(_S, _S)),
])
LEDGER = T.StructType([
    T.StructField("did", _S), T.StructField("pds_host", _S), T.StructField("status", _S), T.StructField("attempts", _L), T.StructField("retry_after", _L),
    T.StructField("error", _S), T.StructField("posts_total", _L), T.StructField("rkey_digest", _S), T.StructField("bucket", _L), T.StructField("loaded_at", _L),
])


def empty(spark, schema: T.StructType):
    """A typed result without rows."""
    return spark.createDataFrame([], schema)


def check_schema(df, schema: T.StructType) -> None:
    """Raise if a table lacks a column of the schema or has it in another type."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f.name for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns missing or of another type: {', '.join(wrong)}")
