"""The account ledger as whole-table transitions: guarded updates, claims, reasons, plans for another crawl."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import MAX_ATTEMPTS


def transition(ledger: DataFrame, changes: DataFrame, allowed: list[str]) -> DataFrame:
    """Set status (and error) of the accounts in `changes` whose status is still one of `allowed`; adds `changed`.

    Finished states clear the error; others keep the old one where no new one is given.
    """
    new = changes.select("did", F.col("status").alias("_status"), F.col("error").alias("_error"))
    out = ledger.join(new, "did", "left")
    go = F.coalesce(F.col("_status").isNotNull() & F.col("status").isin(allowed), F.lit(False))
    error = F.when(F.col("_status").isin("loaded", "verified", "empty"), F.lit(None)).otherwise(F.coalesce("_error", "error"))
    out = out.withColumn("changed", go).withColumn("error", F.when(go, error).otherwise(F.col("error"))).withColumn("status", F.when(go, F.col("_status")).otherwise(F.col("status")))
    return out.drop("_status", "_error")


def upsert(ledger: DataFrame, found: DataFrame, seq: str = "seq") -> DataFrame:
    """Enumerated accounts: new ones are pending, known pending ones take the later host, others stay."""
    last = found.groupBy("did").agg(F.max_by("pds_host", seq).alias("_host"))
    out = ledger.join(last, "did", "full")
    out = out.withColumn("pds_host", F.when(F.col("status").isNull() | ((F.col("status") == "pending") & F.col("_host").isNotNull()), F.col("_host")).otherwise(F.col("pds_host")))
    return out.withColumn("status", F.coalesce("status", F.lit("pending"))).drop("_host")


def park_hosts(ledger: DataFrame, dead: DataFrame, reason: str) -> DataFrame:
    """Claimable accounts of dead hosts wait as unreachable, out of attempts."""
    marked = ledger.join(dead.select("pds_host").distinct().withColumn("_dead", F.lit(True)), "pds_host", "left")
    go = F.coalesce("_dead", F.lit(False)) & F.col("status").isin("pending", "unreachable")
    return marked.withColumn("attempts", F.when(go, F.lit(MAX_ATTEMPTS).cast("long")).otherwise(F.col("attempts"))).withColumn("error", F.when(go, F.lit(reason)).otherwise(F.col("error"))).withColumn("status", F.when(go, "unreachable").otherwise(F.col("status"))).drop("_dead")


def claimable(ledger: DataFrame, now_ms: Column, n: int, excluded: list[str] = (), most_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The next n accounts: pending by id, then due unreachable ones by time; hosts can be excluded."""
    rows = ledger.where(~F.col("pds_host").isin(list(excluded))) if excluded else ledger
    due = (F.col("status") == "unreachable") & (F.col("attempts") < most_attempts) & (F.col("retry_after") <= now_ms)
    rows = rows.where((F.col("status") == "pending") | due)
    later = (F.col("status") == "unreachable").cast("int")
    return rows.orderBy(later, F.when(later == 1, F.col("retry_after")), "did").limit(n)


def promotable(ledger: DataFrame, staged: DataFrame, results: DataFrame) -> DataFrame:
    """Accounts to mark verified: staged, classified exact, and still loaded."""
    return ledger.where("status = 'loaded'").join(staged.select("did"), "did", "left_semi").join(results.where("result = 'exact'").select("did"), "did", "left_semi")


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("posts_total"), F.lit(0)).cast("long").alias("posts"))


#: Reasons by text pattern (as LIKE without case), first match wins.
REASONS = {
    "unreachable": [
        ("host dead: bulk-parked for final sweep", "bulk parked dead host (generic)"),
        ("%pds.trump.com%", "pds.trump.com dead/DNS"),
        ("final sweep parked: referendumapp%", "referendumapp 429/502 tail"),
        ("host dead:%", "other host-dead parked"),
        ("%http 429%", "http 429/rate limited"),
        ("%ENOTFOUND%", "dns ENOTFOUND"),
        ("%timed out%", "timeout/stall"),
        ("%stalled:%", "timeout/stall"),
    ],
    "quarantined": [
        ("malformed car: decoded value contains remainder%", "malformed CAR: decoded remainder"),
        ("malformed car: invalid argument encoding%", "malformed CAR: invalid arg encoding"),
        ("malformed car: unexpected eof while decoding varint%", "malformed CAR: EOF varint"),
        ("malformed car: unexpected eof while reading data%", "malformed CAR: EOF data"),
        ("post record % missing from the car%", "post record missing from CAR"),
        ("car is missing a mst-node block%", "missing MST node block"),
        ("car is missing a commit block%", "missing commit block"),
        ("malformed car: expected mst node block%", "expected MST node block"),
        ("malformed car: expected commit block%", "expected commit block"),
        ("malformed car: invalid binary cid%", "invalid binary CID"),
    ],
    "failed": [
        ("not in % listRepos (PLC-only DID)", "PLC-only DID missing from host listRepos"),
        ("%RepoNotFound%", "getRepo RepoNotFound"),
        ("%http 404%", "http 404"),
        ("%http 4%", "other http 4xx"),
    ],
}


def reason() -> Column:
    """Reason of an account's error under its status; null for statuses without reasons."""
    out = F.lit(None).cast("string")
    for status, rules in REASONS.items():
        own = F.lit("other/unclassified")
        if status == "failed":
            own = F.when(F.coalesce("error", F.lit("")) == "", "missing error text").otherwise(own)
        for pattern, label in reversed(rules):
            own = F.when(F.col("error").ilike(pattern), label).otherwise(own)
        out = F.when(F.col("status") == status, own).otherwise(out)
    return out


def reason_sql() -> str:
    parts = []
    for status, rules in REASONS.items():
        cases = " ".join(f"WHEN error ILIKE '{p}' THEN '{label}'" for p, label in rules)
        tail = "WHEN coalesce(error, '') = '' THEN 'missing error text'" if status == "failed" else ""
        parts.append(f"WHEN status = '{status}' THEN CASE {cases} {tail} ELSE 'other/unclassified' END")
    return f"CASE {' '.join(parts)} END"


def reason_counts(ledger: DataFrame) -> DataFrame:
    rows = ledger.where(F.col("status").isin(list(REASONS))).withColumn("reason", reason())
    return rows.groupBy("bucket", "status", "reason").agg(F.count("*").alias("n"))


def recrawl_candidates(ledger: DataFrame, before_ms: int) -> DataFrame:
    rows = ledger.where(F.col("status").isin("loaded", "verified") & (F.col("loaded_at") < before_ms))
    return rows.select("bucket", "did", "pds_host", F.coalesce("posts_total", F.lit(0)).alias("posts"))


def ranked_by_hash(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds `rank`, from 0, of a row among those of the same keys, by the MD5 of a column.

    A group of any size is ranked: it is cut into slices by the first digits of the hash, slices are counted first.
    """
    rows = rows.withColumn("_hash", F.md5(F.col(order).cast("binary"))).withColumn("_slice", F.substring("_hash", 1, 3))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*keys, "_slice").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, "_slice").orderBy("_hash", order)
    return rows.join(base, [*keys, "_slice"]).withColumn("rank", F.col("_base") + F.row_number().over(within) - 1).drop("_hash", "_slice", "_base")


def balanced_parts(rows: DataFrame, parts: int, by: str = "bucket") -> DataFrame:
    """Deal each shard's rows, largest first, to its part with the fewest posts so far; equal ones by a hash of the account.
    Adds `part`.

    A run of rows of p posts each is dealt in rounds: a part joins in the round in which its load, in units of p, comes up,
    and within a round parts go by what is left of their loads. So a run needs a stretch of ranks for each part that joins,
    whatever its length; the fold over a shard's distinct counts gives these, and rows find their part by rank.
    """

    def stretches(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for shard, own in pdf.groupby(by, dropna=False):
            loads = [0] * parts
            for posts, n in own.sort_values("posts", ascending=False)[["posts", "n"]].astype(int).itertuples(index=False):
                if not posts:
                    out.append((shard, posts, 0, n, [loads.index(min(loads))]))
                    continue
                joins = sorted({load // posts for load in loads})
                at, taken = 0, [0] * parts
                for k, turn in enumerate(joins):
                    ready = sorted((k for k in range(parts) if loads[k] // posts <= turn), key=lambda k: (loads[k] % posts, k))
                    size = n - at if k + 1 == len(joins) else min(n - at, len(ready) * (joins[k + 1] - turn))
                    if not size:
                        break
                    out.append((shard, posts, at, at + size, ready))
                    for i, part in enumerate(ready):
                        taken[part] += size // len(ready) + (i < size % len(ready))
                    at += size
                loads = [load + posts * t for load, t in zip(loads, taken, strict=True)]
        return pd.DataFrame(out, columns=[by, "posts", "low", "high", "ready"])

    counts = rows.groupBy(by, "posts").agg(F.count("*").alias("n"))
    dealt = counts.groupBy(by).applyInPandas(stretches, f"{by} long, posts long, low long, high long, ready array<int>")
    ranked = ranked_by_hash(rows, [by, "posts"], "did").join(dealt, [by, "posts"]).where("rank >= low and rank < high")
    part = F.element_at("ready", (F.pmod(F.col("rank") - F.col("low"), F.size("ready")) + 1).cast("int"))
    return ranked.withColumn("part", part).drop("rank", "low", "high", "ready")
