"""Rollup invariants, stored rollups, streaming ingest."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.operators import aggregates as A
from tessella.operators.ledger import balanced_parts, upsert
from tessella.operators.rollups import RollupStore
from tessella.plans import stores
from tessella.schemas import POSTS, check_schema, empty
from tessella.sources import archive, tables
from tessella.streaming.hosts import streak_step
from tessella.streaming.ingest import raw_events, start_ingest

T0 = dt.datetime(2024, 5, 1)


def posts(spark, glyphs):
    rows = [("d", str(k), T0 + dt.timedelta(minutes=25 * k), "t", ["en"] if k % 3 else ["en", "de"], g, "live" if k % 2 else "backfill", T0 + dt.timedelta(seconds=k)) for k, g in enumerate(glyphs)]
    return spark.createDataFrame(rows, POSTS)


def total(df, *names):
    return tuple(df.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in names]).first())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=5), min_size=1, max_size=8))
def test_invariants(spark, glyphs):
    p = posts(spark, glyphs).cache()
    assert total(A.emoji_total(p), "occurrences")[0] == total(A.posts_hourly(p), "emoji_occurrences")[0] == sum(map(len, glyphs))
    assert sorted(map(tuple, A.emoji_hourly(p).groupBy("emoji").agg(F.sum("occurrences"), F.sum("posts")).collect())) == sorted(map(tuple, A.emoji_total(p).collect()))
    assert A.emoji_total(p).where("posts > occurrences").count() == 0
    by = A.emoji_total_by_lang(p).groupBy("lang").agg(F.sum("occurrences"))
    assert sorted(map(tuple, by.collect())) == sorted((r.lang, r.occurrences) for r in A.lang_total(p).collect())
    p.unpersist()


def test_store(spark, tmp_path):
    store = RollupStore(spark, f"file://{tmp_path}/r")
    a, b = posts(spark, [["x", "x"], ["y"]]), posts(spark, [["x", "x"], ["y"]]).withColumn("rkey", F.concat(F.lit("n"), "rkey"))
    store.append(a, 0)
    store.append(b, 1)
    store.append(b, 1)  # run again: overwrites
    assert total(store.read("emoji_total"), "occurrences") == (6,)
    store.append(a, 2)  # replayed posts over-count until the rebuild
    assert total(store.read("emoji_total"), "occurrences") == (9,)
    store.rebuild(a.unionByName(b).unionByName(a))
    assert total(store.read("emoji_total"), "occurrences") == (6,)
    store.append(posts(spark, [["z"]]).withColumn("rkey", F.lit("late")), 3)
    assert total(store.read("posts_hourly"), "posts") == (5,)
    store.repair(a, T0)
    assert total(store.read("posts_hourly"), "posts") == (2,) and not store.drifted(A.SPECS["posts_hourly"])


def test_archive(spark, tmp_path):
    old, new = f"{tmp_path}/v1", f"{tmp_path}/v2"
    p = posts(spark, [["x"], []])
    p.drop("ingested_at").write.parquet(old)
    archive.write_archive(p.drop("ingested_at").withColumn("reply", F.lit("")), new)
    rows = archive.read_archive(spark, old, new)
    assert rows.where("reply is null").count() == 2 and rows.where("reply = ''").count() == 2
    m = archive.manifest(spark, new).first()
    assert m.rows >= 1 and m.bytes > 0
    (tmp_path / "dids.txt").write_text("did:a host1\n\nbad line here\ndid:b\n")
    assert sorted(map(tuple, archive.did_list(spark, str(tmp_path / "dids.txt")).collect())) == [("did:a", "host1"), ("did:b", None)]
    check_schema(empty(spark, POSTS), POSTS)


def test_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    event = lambda k: {"did": "d", "rkey": str(k), "text": "hi 😀", "langs": ["en"], "createdAt": None, "timeUs": base + k}
    (src / "a.json").write_text("\n".join(json.dumps(event(k)) for k in (1, 2, 2, 3)))
    root, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/cp"
    start_ingest(raw_events(spark, str(src)), root, checkpoint, once=True).awaitTermination()
    (src / "b.json").write_text("\n".join(json.dumps(event(k)) for k in (3, 4)))
    start_ingest(raw_events(spark, str(src)), root, checkpoint, once=True).awaitTermination()
    assert spark.read.parquet(f"{root}/posts").count() == 4
    assert total(RollupStore(spark, f"{root}/rollups").read("emoji_total"), "occurrences", "posts") == (4, 4)


def test_state_machines():
    s = ("", 0, 0.0, False)
    for k in range(30):
        s = streak_step(s, "dns", k * 0.5)
    assert not s[3]  # one burst does not span long enough
    s = streak_step(s, "dns", 40.0)
    assert s[3] and streak_step(s, "ok", 50.0)[3]
    assert streak_step(("dns", 29, 0.0, False), "stall", 99.0)[1] == 1


def test_balance_and_upsert(spark):
    rows = spark.createDataFrame([(0, f"c{k}", "h", p) for k, p in enumerate([9, 7, 6, 5, 5, 2])], "bucket long, did string, pds_host string, posts long")
    loads = balanced_parts(rows, 3).groupBy("part").agg(F.sum("posts").alias("n"))
    assert sorted(r.n for r in loads.collect()) == [11, 11, 12]
    ledger = spark.createDataFrame([("a", "h1", "pending"), ("b", "h1", "loaded")], "did string, pds_host string, status string")
    found = spark.createDataFrame([("a", "h2", 1), ("a", "h3", 2), ("b", "h9", 1), ("c", "h4", 1)], "did string, pds_host string, seq long")
    assert {r.did: (r.pds_host, r.status) for r in upsert(ledger, found).collect()} == {"a": ("h3", "pending"), "b": ("h1", "loaded"), "c": ("h4", "pending")}


def test_texts_are_looked_through_once(spark, monkeypatch):
    """All seven rollups of normalized events from one pass over the texts."""
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    read = tables.read
    monkeypatch.setattr(tables, "read", lambda *a: read(*a).withColumn("text", F.udf(counted, "string")("text")))
    documents = read(spark, "/root/testdata/sf0.001", "documents").count()
    rollups = stores.rollups_normalized(spark, "/root/testdata/sf0.001").collect()
    assert {r.rollup for r in rollups} == set(A.SPECS) and sum(r.posts for r in rollups if r.rollup == "posts_hourly") == documents
    assert seen.value == documents
