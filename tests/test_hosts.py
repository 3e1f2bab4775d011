"""Host streaks: slices of any number and micro-batches against the fold over single outcomes."""

import datetime as dt
from random import Random

import pytest
from pyspark.sql import functions as F

from tessella.streaming.hosts import runs, stitched, streak_step, summaries, trips, watch_hosts

T0 = dt.datetime(2024, 5, 1)
SCHEMA = "host string, ts timestamp_ntz, event_id long, kind string"
TRIP, STALL = (6, 40), (3, 90)


def outcomes(seed, n=700):
    """One host with most rows, hosts that fail for long, ties in time."""
    rng, rows, at, now = Random(seed), [], {}, {}
    for k in range(n):
        host = "hot" if rng.random() < 0.6 else f"h{rng.randint(0, 9)}"
        at[host] = at.get(host, 0) + rng.choice([0, 0, 1, 5, 20])
        if rng.random() < 0.25:
            now[host] = rng.choice(["ok", "dns", "legal", "stall"])
        rows.append((host, T0 + dt.timedelta(seconds=at[host]), k, now.get(host, "dns")))
    return rows


def fold(rows):
    states, out = {}, {}
    for host, ts, _, kind in rows:
        state = states.get(host, ("", 0, 0.0, False))
        states[host] = streak_step(state, kind, (ts - T0).total_seconds(), TRIP, STALL)
        if states[host][3] and not state[3]:
            out[host] = (states[host][0], ts, states[host][1])
    return out


def found(df):
    return {r.host: (r.kind, r.tripped_at, r.failures) for r in df.collect()}


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_slices(spark, slices):
    rows = outcomes(slices)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(trips(df, TRIP, STALL, slices)) == fold(sorted(rows, key=lambda r: r[:3]))
    assert trips(df.limit(0), TRIP, STALL).count() == 0


def test_no_task_has_a_whole_host(spark):
    """The largest slice shrinks with their number, and what is stitched is a row a slice."""
    df = spark.createDataFrame([("hot", T0 + dt.timedelta(seconds=k), k, "dns") for k in range(4000)], SCHEMA)
    for slices in (4, 16):
        cut = runs(df, slices)
        assert cut.groupBy("slice").count().agg(F.max("count")).first()[0] < 3 * 4000 / slices
        parts = stitched(summaries(cut, TRIP, STALL), TRIP, STALL)
        assert parts.count() == cut.select("slice").distinct().count() > slices / 2
        assert parts.agg(F.max("run_n")).first()[0] == 4000


def test_batches(spark, tmp_path):
    rows = outcomes(9, 500)
    source, root, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "cp"))
    for k in range(4):
        spark.createDataFrame(rows[k * 125 : (k + 1) * 125], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        watch_hosts(spark.readStream.schema(SCHEMA).parquet(source), root, checkpoint, TRIP, STALL, 3).awaitTermination()
    in_turn = [r for k in range(4) for r in sorted(rows[k * 125 : (k + 1) * 125], key=lambda r: r[:3])]
    assert found(spark.read.parquet(f"{root}/trips")) == fold(in_turn) and spark.read.parquet(f"{root}/state/batch=3").count() > 5
