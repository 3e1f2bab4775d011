"""Reconciliation of stored posts against the ledger: count and digest of each account."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import digest, tid_micros
from ..storage import materialize
from .ledger import promotable


def actual(posts: DataFrame, expected: DataFrame) -> DataFrame:
    """Count and digest of the distinct keys of each expected account; any source counts."""
    rows = posts.join(expected.select("did"), "did", "left_semi").select("did", "rkey").distinct()
    return rows.groupBy("did").agg(F.count("*").alias("actual_posts"), digest(F.col("rkey")).alias("actual_digest"))


def classify(expected: DataFrame, posts: DataFrame) -> DataFrame:
    """Adds actual_posts, actual_digest and result: exact, digest-mismatch, count-short or loose, in this order."""
    rows = expected.join(actual(posts, expected), "did", "left").withColumns({"actual_posts": F.coalesce("actual_posts", F.lit(0)), "actual_digest": F.coalesce("actual_digest", F.lit(""))})
    stored, equal = F.col("expected_digest") != "", F.col("actual_posts") == F.col("expected_posts")
    same = F.col("actual_digest") == F.col("expected_digest")
    result = (
        F.when(stored & equal & same, "exact").when(stored & (F.col("expected_posts") > 0) & equal & ~same, "digest-mismatch")
        .when(F.col("actual_posts") < F.col("expected_posts"), "count-short").otherwise("loose")
    )
    return rows.withColumn("result", result)


def result_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("result").agg(F.count("*").alias("accounts"), F.sum("expected_posts").alias("expected_posts"), F.sum("actual_posts").alias("actual_posts"))


def examples(classified: DataFrame, n: int = 50) -> DataFrame:
    """The first n accounts of each result but exact, by id."""
    from pyspark.sql.window import Window

    ranked = classified.where("result <> 'exact'").withColumn("rank", F.row_number().over(Window.partitionBy("result").orderBy("did")))
    return ranked.where(F.col("rank") <= n).drop("rank")


def orphans(posts: DataFrame, expected: DataFrame) -> DataFrame:
    """Accounts with backfilled posts that nothing expects, with counts of distinct keys."""
    rows = posts.where("src = 'backfill'").join(expected.select("did").distinct(), "did", "left_anti")
    return rows.select("did", "rkey").distinct().groupBy("did").agg(F.count("*").alias("posts"))


def superset_check(fetched: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing, extra) keys by account: fetched but not stored, stored but not fetched.

    Fetched keys whose time lies after the account's loaded_at (ms) are ignored; a null loaded_at ignores nothing.
    """
    fetched = fetched.select("did", "rkey", "loaded_at").distinct()
    stored = stored.select("did", "rkey").distinct().join(fetched.select("did").distinct(), "did", "left_semi")
    late = F.coalesce(tid_micros(F.col("rkey")) / 1000 > F.col("loaded_at"), F.lit(False))
    missing = fetched.where(~late).join(stored, ["did", "rkey"], "left_anti").select("did", "rkey")
    return missing, stored.join(fetched, ["did", "rkey"], "left_anti").select("did", "rkey")


def requeue(ledger: DataFrame, posts: DataFrame, since_ms: int) -> DataFrame:
    """Recently loaded accounts that are not intact: stricter than classify, as counting again is cheap."""
    recent = ledger.where((F.col("status") == "loaded") & (F.col("loaded_at") >= since_ms))
    rows = recent.join(actual(posts, recent), "did", "left")
    expected = F.coalesce("posts_total", F.lit(0))
    intact = F.when(F.col("rkey_digest").isNull(), F.coalesce("actual_posts", F.lit(0)) >= expected).otherwise(
        F.coalesce((F.col("actual_posts") == expected) & (F.col("actual_digest") == F.lower(F.lpad("rkey_digest", 16, "0"))), F.lit(False))
    )
    return rows.where(~intact).select("did")


def listing_diff(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Claimable accounts that their host's listing condemns: did, pds_host, terminal status, error.

    A host with no listed account condemns nothing.
    """
    hosts = listing.select(F.col("host").alias("pds_host")).distinct()
    listed = listing.select("did", F.col("host").alias("pds_host"), "active", "state", F.lit(True).alias("listed"))
    rows = ledger.where(F.col("status").isin("pending", "unreachable")).join(hosts, "pds_host", "left_semi").join(listed, ["did", "pds_host"], "left")
    terminal = (
        F.when(F.col("listed").isNull(), "failed").when(F.coalesce("active", F.lit(True)), F.lit(None)).when(F.col("state").isin("takendown", "suspended"), "takendown")
        .when(F.col("state") == "deactivated", "deactivated").otherwise("failed")
    )
    error = F.when(F.col("listed").isNull(), F.format_string("not in %s listRepos (PLC-only DID)", "pds_host")).otherwise(F.format_string("%s listRepos: active=false (%s)", F.col("pds_host"), F.coalesce("state", F.lit("unknown"))))
    return rows.withColumn("terminal", terminal).where("terminal is not null").select("did", "pds_host", "terminal", error.alias("error"))


def host_verdicts(hosts: DataFrame) -> DataFrame:
    """Hosts and pending accounts by verdict."""
    return hosts.groupBy("verdict").agg(F.count("*").alias("hosts"), F.sum("pending").alias("pending"))


def counted_write(df: DataFrame, name: str, **also) -> tuple[DataFrame, dict]:
    """The table as written, and its number of rows (`rows`) and other sums, taken in the pass that writes it."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in also.items()]), name)
    return written, seen.get


def promote(ledger: DataFrame, staged: DataFrame, results: DataFrame) -> tuple[DataFrame, dict]:
    """Accounts to mark verified, and the counts that allow it. Refuses if not every staged account was classified.

    Staged accounts and their results are written once each and counted as they are written.
    """
    held, stage = counted_write(staged.select("did"), "staged")
    classified, result = counted_write(results.select("did", "result"), "classified", exact=F.count_if(F.col("result") == "exact"))
    if result["rows"] != stage["rows"]:
        raise ValueError(f"{result['rows']} of {stage['rows']} staged accounts were classified; nothing is promoted")
    return promotable(ledger, held, classified), {"staged": stage["rows"], "exact": result["exact"]}
