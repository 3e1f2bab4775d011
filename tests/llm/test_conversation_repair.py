"""Repair against brute force over single rows, for chunks of any length; costs of chunks; edge inputs."""

import hashlib
import re
import zlib
from random import Random

import pytest

from tessella.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
GOES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def cheapest(rows):
    """(cost, letters, output) by a forward pass over every state, ways kept as (cost, letters)."""
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(4):
            for state, (cost, letters, out) in list(best.items()):
                for name in ("user", "assistant"):
                    to = GOES.get((state, name[0]))
                    way = (cost + 2, letters + "I", (*out, (name, "")))
                    if to and (to not in best or way[:2] < best[to][:2]):
                        best[to] = way
        return best

    for role, text, must_go, cut in rows:
        best = insert(best)
        after = {}
        for state, (cost, letters, out) in best.items():
            ways = [(state, (cost + 3, letters + "D", out))]
            if not must_go:
                if (state, role[:1]) in GOES:
                    ways.append((GOES[state, role[:1]], (cost + cut, letters + "K", (*out, (role, text)))))
                ways += [(GOES[state, n[0]], (cost + 2 + cut, letters + "R", (*out, (n, text)))) for n in ("user", "assistant") if (state, n[0]) in GOES]
            for to, way in ways:
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        best = after
    best = insert(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])


def order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows, kept=None):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in (damaged(rows) if kept is None else kept) if r[0] == conv), key=order)
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            blank, again = not text.strip(SPACE), (role, text) in seen
            cut = not blank and not again and text.rstrip(SPACE)[-1] not in ".!?"
            seen.add((role, text))
            for k, fault in enumerate((blank, not blank and again, cut)):
                counts[k] += fault
            marked.append((role, text, blank or again, cut))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, letters, repaired = cheapest(marked)
        out[conv] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest(), repaired)
    return out


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


ROLES = ["user", "assistant", "system", "tool", "", "u", None]
TEXTS = ["", " \n", "Hi.", "Hi", "So it is!", "No", "What?", ".", "é.\n", None]
SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed, n=25, most=25):
    rng = Random(seed)
    rows = []
    for conv in range(n):
        roles = rng.choice([ROLES, ["user", "assistant"], ["tool"], ["system", "user"], ["assistant"]])
        for k in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.1 else k + rng.choice([0, 0, 0, 1, 5])
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"{rng.random()}" + rng.choice([".", ""])
            rows.append((conv, turn, rng.choice(roles), text))
    return rows


def test_costs_of_chunks():
    """Any vector of costs is a least of shifted speculative ones, and a chunk's matrix does what its rows do."""
    rng = Random(1)
    for _ in range(2000):
        behind, codes = ["".join(rng.choice("suatSUAT15") for _ in range(rng.randint(0, 12))) for _ in range(2)]
        end, total = cr._END, 0
        for code in reversed(behind):
            end, more = cr.before(code, end)
        now = end
        for code in reversed(codes):
            now, more = cr.before(code, now)
            total += more
        parts = cr.matrix(codes)
        assert [min(parts[q * 4 + k] + end[k] for k in range(4)) for q in range(4)] == [x + total for x in now]


@pytest.mark.parametrize("bits", [0, 2, 10])
def test_chunks_of_any_length(spark, bits):
    rows = conversations(bits) if bits < 10 else conversations(bits, 600, 5)  # many to a batch
    rows += [(9100, k, "tool", f"{k}.") for k in range(20)] + [(9101, k, "user", "same.") for k in range(20)] + [(None, k % 3, "user", f"{k}") for k in range(9)]
    rows += [(9102, 7, "user", "again.")] * 40 + [(9103, k, ["user", "assistant"][k % 2], f"{k}.") for k in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = results(cr.repair(cr.damage(df), df, bits))
    want = brute(rows)
    assert {k: v[:8] for k, v in want.items()} == got
    out = {}
    for r in sorted(cr.repaired_rows(cr.damage(df), bits).collect(), key=lambda r: r.place):
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(list(want[k][8]) == out.get(k, []) for k in want)


def test_edges(spark):
    """No rows left, nulls everywhere, a long text, repeated rows, clashing names, an empty table."""
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x."), (5, None, None, None), (None, None, None, None), (6, 1, "user", "long " * 50_000 + "."), (6, 1, "user", "long " * 50_000 + "."), (7, 2**62, "a", "x."), (7, -(2**62), "u", "y.")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", n int, at int")
    got = results(cr.repair(cr.damage(df), df))
    assert got == {k: v[:8] for k, v in brute(rows).items()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert cr.repair(cr.damage(df.limit(0)), df.limit(0)).count() == 0
    kept = [(1, 2, "user", "Hi."), (1, 3, "user", "Ho.")]
    plain = cr.repair(cr.plain_rows(spark.createDataFrame(kept, SCHEMA)))
    assert results(plain) == {k: v[:8] for k, v in brute(kept, kept).items()}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(cr.op11(spark, sf)) == {k: v[:8] for k, v in brute(rows).items()}
