"""Bitmaps, call stacks, enumeration with a cursor."""

from random import Random

from pyspark.sql import functions as F

from tessella.operators import bitmaps, stacks
from tessella.operators.snapshots import SnapshotLog
from tessella.sources.enumeration import enumerate_pages, operations, rewound


def test_bitmaps(spark):
    """Ids over several buckets, days on which a bucket is silent, null keys; no Expand in the plan."""
    rng = Random(1)
    rows = [(f"2024-01-0{rng.randint(1, 6)}" if k % 3 else "2024-01-09", f"u{rng.randint(0, 80)}", rng.choice("ab")) for k in range(400)] + [("2024-01-01", None, "a")]
    df = spark.createDataFrame(rows, "d string, u string, e string").withColumn("d", F.to_date("d"))
    ids = bitmaps.dense_ids(df, "u").withColumn("id", F.col("id") % 7 * 40_000 + F.xxhash64("u") % 9_999)
    marks = bitmaps.marks(df.join(ids, "u"), ["d"], {"a": F.col("e") == "a", "b": F.col("e") == "b"})
    assert "Expand" not in marks._jdf.queryExecution().executedPlan().toString()
    known = {r.u: r.id for r in ids.collect()}
    users = lambda test: len({known[u] for d, u, e in rows if u and test(d, e)})
    for got, before in ((bitmaps.counts(marks, ["d"], ["a", "b"]), False), (bitmaps.counts(bitmaps.running(marks, "d", ["a", "b"]), ["d"], ["a", "b"]), True)):
        days = got.collect()
        assert len(days) == len({d for d, _, _ in rows})
        for r in days:
            for c in "ab":
                assert r[c] == users(lambda d, e, r=r, c=c: e == c and (d <= str(r.d) if before else d == str(r.d)))


def test_stacks(spark):
    """Chains longer than the depth, roots, missing parents, samples of unknown nodes."""
    nodes = [(k, k - 1 if k else None, f"f{k}") for k in range(20)] + [(100, 99, "orphan")]
    got = {r.node: r.frames for r in stacks.paths(spark.createDataFrame(nodes, "node long, parent long, frame string"), 12).collect()}
    assert got[19] == [f"f{k}" for k in range(19, 7, -1)] and got[3] == ["f3", "f2", "f1", "f0"] and got[0] == ["f0"] and got[100] == ["orphan"]
    samples = spark.createDataFrame([(19,), (19,), (2,), (777,)], "node long")
    top = [tuple(r) for r in stacks.top_stacks(spark.createDataFrame(nodes, "node long, parent long, frame string"), samples, 3).collect()]
    assert top == [("f19 < f18 < f17 < f16 < f15 < f14", 2, 50.0), ("", 1, 25.0), ("f2 < f1 < f0", 1, 25.0)]


def test_enumeration(spark, tmp_path):
    """A page of another run in between, an overlap, an empty source."""
    ops = spark.createDataFrame([(k, f"d{k % 4}", k) for k in range(1, 26)], "seq long, did string, op long")
    page = lambda cursor: ops.where(F.col("seq") > (cursor or 0)).orderBy("seq").limit(10)
    log = SnapshotLog(spark, f"file://{tmp_path}/e")
    calls = []

    def slow(cursor):
        calls.append(cursor)
        if len(calls) == 2:  # another run is faster
            enumerate_pages(log, page, "ops", most=1)
        return page(cursor)

    assert enumerate_pages(log, slow, "ops") == 3 and log.latest().cursors == {"ops": 25}
    assert enumerate_pages(log, page, "ops", overlap=5) == 1 and log.latest().cursors == {"ops": 25}
    read = operations(log, "ops")
    assert read.select("seq").distinct().count() == 25 and calls[0] is None
    assert enumerate_pages(SnapshotLog(spark, f"file://{tmp_path}/none"), lambda c: ops.limit(0), "ops") == 0
    assert rewound(None) is None and rewound(10, 3) == 7
