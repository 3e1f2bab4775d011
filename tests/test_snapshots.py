"""The snapshot log and what rests on it: one winner a commit, readers of whole states, swaps under way, merges."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_rollups import T0, posts, total

from tessella.operators import aggregates as A
from tessella.operators.rollups import RollupStore
from tessella.operators.snapshots import Part, Snapshot, SnapshotLog, Table


@given(st.lists(st.integers(0, 30), max_size=40))
def test_batches(numbers):
    s = Snapshot()
    for n in numbers:
        s = s.with_batch(n)
    assert all(s.has(k) == (k in numbers) for k in range(32)) and not s.has("a") and s.with_batch("a").has("a")
    assert all(b + 1 < c for (_, b), (c, _) in zip(s.ranges, s.ranges[1:], strict=False))
    s = s.with_tables({"t": Table((Part("p", 1, 2),), "x", True)})
    assert Snapshot.from_json(s.to_json()) == s


def test_one_writer_at_a_time(spark, tmp_path):
    """Commits from many threads at once: none is lost, none is done twice."""
    log = SnapshotLog(spark, f"file://{tmp_path}/log dir")
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda k: log.commit(lambda now: None if now.has(k) else now.with_batch(k)), [*range(12), *range(12)]))
    assert sum(d is not None for d in done) == 12
    now = log.latest()
    assert now.version == 12 and now.ranges == ((0, 11),)
    assert log.read(3).version == 3 and not log._create(replace(now, version=3))


def test_reader_in_the_gap(spark, tmp_path):
    """A state that a reader has keeps its rows while the tables are rebuilt, merged and vacuumed within the grace."""
    store = RollupStore(spark, f"file://{tmp_path}/r")
    for k in range(3):
        store.append(posts(spark, [["x"], ["y", "y"]]).withColumn("rkey", F.concat("rkey", F.lit(f"-{k}"))), k)
    old = store.log.latest()
    store.compact(3)
    store.rebuild()
    store.log.vacuum(keep=1)
    assert total(store.read("emoji_total", old), "occurrences") == total(store.read("emoji_total"), "occurrences") == (9,)
    assert store.log.vacuum(keep=1, grace_s=-5) > 0 and total(store.read("emoji_total"), "occurrences") == (9,)


def test_swap(spark, tmp_path):
    """A batch between reading and swap counts once; a merge across the reading makes the swap fail."""
    store = RollupStore(spark, f"file://{tmp_path}/r")
    a, b, c = (posts(spark, [["x", "x"], []]).withColumn("did", F.lit(d)) for d in "abc")
    store.append(a, 0)
    store.append(a, "again")
    first, other = store.prepare_rebuild(), store.prepare_repair(None, T0)
    store.append(b, 1)
    assert store.commit(first) and total(store.read("posts_hourly"), "posts") == (4,)
    assert not store.commit(other)  # what it has read is gone
    late = store.prepare_rebuild()
    store.append(c, 2)
    store.compact(2)
    assert not store.commit(late)
    store.rebuild()
    assert total(store.read("posts_hourly"), "posts") == (6,) and total(store.read("emoji_total"), "occurrences") == (6,)
    assert not store.append(c, 2) and not store.append(a, "again")


def test_drift(spark, tmp_path):
    root, other = f"file://{tmp_path}/r", A.SPECS | {"lang_total": replace(A.SPECS["lang_total"], build=A.emoji_total)}
    other["lang_total"] = replace(other["lang_total"], build=lambda p: A.lang_total(p.where("src = 'live'")))
    store = RollupStore(spark, root, other)
    assert set(store.migrate().values()) == {"created"} and set(store.migrate().values()) == {"current"}
    assert total(store.read("lang_total"), "posts") == (0,) and store.posts().count() == 0
    store.append(posts(spark, [["x"]] * 4), 0)
    new = RollupStore(spark, root)
    assert new.drifted(A.SPECS["lang_total"]) and [n for n, f in new.migrate().items() if f == "drifted"] == ["lang_total"] == new.dirty()
    new.rebuild()
    assert new.dirty() == [] and total(new.read("lang_total"), "posts") == (6,)
