"""Stored tables: what plans read and move, edge inputs, and what a broken-off write leaves."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tessella.operators import verify as V
from tessella.operators.ledger_store import LedgerStore
from tessella.schemas import LEDGER
from tessella.sources import archive, partitioned

T0 = dt.datetime(2024, 5, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [("a b", "s/1", k) for k in range(5)] + [(None, "s/1", 9), ("", "s2", 8), ("x", "s2", 7)]
    partitioned.put(spark.createDataFrame(rows, "run string, shard string, n int"), path, ["run", "shard"])
    read = lambda: sorted((str(r.run), r.shard, r.n) for r in spark.read.parquet(path).collect())
    assert len(read()) == 8
    assert partitioned.delete(spark, path, {"run": "a b", "shard": "s/1"}) and not partitioned.delete(spark, path, {"run": "a b", "shard": "s/1"})
    assert partitioned.delete(spark, path, {"run": None, "shard": "s/1"}) and len(read()) == 2
    own = spark.read.parquet(path).where("run = 'x'").select((F.col("n") + 1).alias("n"))  # reads what it replaces
    partitioned.replace(own, path, {"run": "x", "shard": "s2"})
    assert read() == [("None", "s2", 8), ("x", "s2", 8)]
    pruned = plan(spark.read.parquet(path).where("run = 'x' and n > 3"))
    assert re.search(r"PartitionFilters: \[[^\]]*run[^\]]* = x", pruned)


def test_expiry(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(T0 + dt.timedelta(hours=7 * k),) for k in range(40)], "ts timestamp_ntz").withColumn("day", F.to_date("ts"))
    partitioned.put(rows, path, ["day"])
    cutoff = T0 + dt.timedelta(days=4, hours=3)
    assert partitioned.expire(spark, path, "ts", cutoff) == 4
    assert spark.read.parquet(path).agg(F.min("ts")).first()[0] >= cutoff and spark.read.parquet(path).count() == rows.where(F.col("ts") >= F.lit(cutoff).cast("timestamp_ntz")).count()
    assert partitioned.expire(spark, path, "ts", cutoff) == 0


def ledger(spark, n=40):
    rows = [(f"d{k}", "h", ["pending", "loaded", "unreachable", "verified"][k % 4], 1, 5, "old", None, None, k % 6, None) for k in range(n)]
    return spark.createDataFrame(rows, LEDGER)


def test_only_changes_move(spark):
    """The stored side is read by bucket, without an exchange; so is the write that follows."""
    store = LedgerStore(spark, ledger(spark), 5)
    changes = spark.createDataFrame([("d1", "retry", "e", 9, 1)], "did string, kind string, error string, retry_after long, seq long")
    text = plan(store.after(changes))
    assert text.count("Exchange hashpartitioning") == 1 and re.search(r"Bucketed: true", text) and "SelectedBucketsCount: 5 out of 5" in text


def test_guards(spark):
    """One batch that holds a change of each kind for an account of each status, and for one that is not there."""
    kinds = ["pending", "tombstoned", "parked", "fetching", "loaded", "retry", "throttled", "terminal", "odd"]
    states = ["pending", "loaded", "unreachable", "verified"]
    stored = spark.createDataFrame([(f"{s}-{k}", "h", s, 1, 5, "old", 3, "x", 0, 4) for s in states for k in kinds], LEDGER)
    rows = [(f"{s}-{k}", k, "new", "failed" if k == "terminal" else None, 8, 77, 2) for s in [*states, "none"] for k in kinds]
    rows += [("pending-pending", "pending", "earlier", None, 1, 1, 1)]
    changes = spark.createDataFrame(rows, "did string, kind string, pds_host string, status string, retry_after long, posts_total long, seq long")
    store = LedgerStore(spark, stored, 3)
    store.merge(changes)
    got = {r.did: r for r in store.read().collect()}
    status = lambda k: [got[f"{s}-{k}"].status for s in states]
    assert [got[f"{s}-pending"].pds_host for s in states] == ["new", "h", "h", "h"] and status("pending") == states
    assert status("tombstoned") == ["tombstoned", "loaded", "tombstoned", "verified"] and got["unreachable-tombstoned"].retry_after is None
    assert status("parked") == ["unreachable", "loaded", "unreachable", "verified"] and (got["pending-parked"].attempts, got["unreachable-parked"].attempts) == (5, 1)
    assert status("fetching") == ["fetching", "loaded", "fetching", "verified"]
    assert set(status("loaded")) == {"loaded"} and got["pending-loaded"].posts_total == 77 and got["pending-loaded"].error is None
    assert set(status("retry") + status("throttled")) == {"unreachable"} and (got["pending-retry"].attempts, got["pending-throttled"].attempts) == (2, 1)
    assert set(status("terminal")) == {"failed"} and got["pending-terminal"].error == "old"
    assert status("odd") == states and {d for d in got if d.startswith("none")} == {"none-pending", "none-tombstoned", "none-parked"}
    store.merge(changes.limit(0))
    assert store.read().count() == len(got)


def test_promotion(spark):
    own = spark.createDataFrame([("a", "loaded"), ("b", "loaded"), ("c", "verified"), ("d", "loaded")], "did string, status string")
    staged, results = own.where("did <> 'd'"), spark.createDataFrame([("a", "exact"), ("b", "loose"), ("c", "exact")], "did string, result string")
    promoted, counts = V.promote(own, staged, results)
    assert [r.did for r in promoted.collect()] == ["a"] and counts == {"staged": 3, "exact": 2}
    with pytest.raises(ValueError, match="2 of 3"):
        V.promote(own, staged, results.where("did <> 'c'"))


def test_pages(spark, tmp_path):
    df = spark.createDataFrame([(f"k{k:04d}", k) for k in range(300)], "k string, n int")
    directory = archive.write_sorted(df, "k", f"file://{tmp_path}/p", 20)
    after, seen, most = None, [], 0
    while rows := (page := archive.page_after(directory, "k", after, 30))[0].collect():
        seen, after, most = seen + [r.k for r in rows], rows[-1].k, max(most, page[1])
    assert seen == [f"k{k:04d}" for k in range(300)] and most <= 4 and directory.count() >= 15
    assert archive.page_after(directory, "k", "k0100x", 3)[0].first().k == "k0101"


def test_sweep(spark, tmp_path):
    """Nothing is found twice; an emptied archive keeps its sequence by the manifest alone."""
    root = f"file://{tmp_path}/a"
    df = spark.createDataFrame([(T0, 1)], "created_at timestamp_ntz, n int")
    archive.finalize(df, root, "live", 7)
    archive.write_archive(df, f"{root}/files/live-000008.parquet")
    found, following = archive.sweep(spark, root, "live")
    assert {r.file: r.state for r in found.collect()} == {"live-000007.parquet": "whole", "live-000008.parquet": "unlisted"} and following == 9
    found, following = archive.sweep(spark, root, "live")
    assert {r.state for r in found.collect()} == {"whole"} and following == 9
    archive.finalize(df, root, "live", following)
    assert archive.sweep(spark, root, "live")[1] == 10 and archive.sweep(spark, root, "other")[1] == 1
