import hashlib
import re

import pytest
from corpus import SCHEMA, corpus
from pyspark.sql import functions as F

from tessella.llm import mixing as M


def targets(sizes):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        per = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if per * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: capped.get(s, per * weight[s]) for s in names}
        for s in over:
            capped[s] = 2 * sizes[s]
            left -= capped[s]


def op3(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return M.op3(spark, str(folder)).collect()


def test_plan(spark, tmp_path):
    rows = corpus(3, 120)
    got = op3(spark, rows, tmp_path)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    assert {r.doc_id: r["size"] for r in got} == size
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size[r[0]]
    want = targets(total)
    taken, source = {}, {r[0]: r[3] for r in rows}
    for r in got:
        own = source[r.doc_id]
        assert r.source_size == total[own] and r.target == pytest.approx(want[own])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[own] = taken.get(own, 0) + r.taken
    biggest = {s: max(size[r[0]] for r in rows if r[3] == s) for s in total}
    assert all(abs(taken[s] - want[s]) <= biggest[s] / 2 + 1 for s in total)
    assert sorted(map(str, got)) == sorted(map(str, op3(spark, rows, tmp_path)))
    # brute force: sources in the order of a hash, pass after pass; the schedule's integral inverted by bisection
    order = lambda k: int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16)
    ramps, copies = {s: M.RAMPS[k % 3] for k, s in enumerate(sorted(total, key=lambda s: (s is None, s)))}, []
    for s in total:
        begin = 0
        for _ in range(2):
            for d in sorted((r[0] for r in rows if r[3] == s), key=order):
                if size[d] and begin + size[d] / 2 < want[s]:
                    copies.append((invert(begin / want[s], ramps[s]), d))
                begin += size[d]
    at, first, where = 0, {}, {}
    for p, d in sorted(copies):
        first.setdefault(d, at)
        where.setdefault(d, p)
        at += size[d]
    assert {r.doc_id: r.first_start for r in got if r.repeats} == first
    assert {r.doc_id: r.first_position for r in got if r.repeats} == pytest.approx(where, abs=1e-6)


def invert(done, ramp):
    rate = lambda t: ramp[0] + 2 * t * (ramp[1] - ramp[0]) if t < 0.5 else ramp[1] + (2 * t - 1) * (ramp[2] - ramp[1])
    area = lambda t: (ramp[0] + rate(t)) / 2 * t if t < 0.5 else (ramp[0] + ramp[1]) / 4 + (ramp[1] + rate(t)) / 2 * (t - 0.5)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if area(mid) < done * area(1.0) else (low, mid)
    return low


def test_positions_follow_the_schedule(spark):
    """Of a source whose weight falls, more than half of its tokens come in the first half; of a rising one, less."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    rows = M.plan(df).select("source", F.explode("positions").alias("p"))
    share = {r.source: r.x for r in rows.groupBy("source").agg(F.avg((F.col("p") < 0.5).cast("double")).alias("x")).collect()}
    # the integral of 1.5 to 0.5 over the first half is 0.625
    assert share["s0"] == pytest.approx(0.625, abs=0.03) and share["s1"] == pytest.approx(0.5, abs=0.03) and share["s2"] == pytest.approx(0.375, abs=0.03)


def test_mix_keeps_columns_and_repeats(spark):
    rows = corpus(3, 20)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", positions string")
    out = M.mix(df)
    assert out.columns == df.columns
    want = {r.doc_id: len(r.positions) for r in M.plan(df.drop("positions")).collect() if r.positions}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want
    assert M.mix(df.limit(0)).count() == 0 and M.plan(df.limit(0).drop("positions")).count() == 0


def test_mix_repeated_rows_and_clashing_names(spark):
    """Each of the rows that repeat id and text has its own place; columns of any name pass."""
    names = "_id, _key, _own, _at, _row, _doc, _tie, _part, _slice, _slice2, _base, _start, size, target, positions".split(", ")
    rows = [(1, "a b c d", "s", *names)] * 7
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    assert sum(len(r.positions) for r in M.plan(df.select("doc_id", "text", "source")).collect()) == 10
    out = M.mix(df)
    assert out.count() == 10 and out.columns == df.columns
    nulls = spark.createDataFrame([(None, None, None), (None, "a", None), (2, " ", "s")], "doc_id long, text string, source string")
    assert [r.text for r in M.mix(nulls).collect()] == ["a"] or [r.text for r in M.mix(nulls).collect()] == ["a", "a"]
