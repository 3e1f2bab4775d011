from random import Random

import numpy as np
import pytest
from corpus import SCHEMA, corpus, sentence

from tessella.llm import ngram_join as N


def sets_of(rows, k):
    out = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))})
    return out


def brute(rows, k, num, den=100):
    sets, root = sets_of(rows, k), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and den * o >= num * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(rows[i][0]), find(rows[j][0])
                root[max(a, b)] = min(a, b)
    return {r[0]: (len(s), find(r[0])) for r, s in zip(rows, sets, strict=True)}


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("xyz") * 3
    return " ".join(words)


@pytest.mark.parametrize(("k", "num", "block"), [(4, 85, 2000), (5, 80, 2000), (4, 85, 3)])
def test_brute_force(spark, k, num, block):
    rng, rows = Random(12), corpus(12, 25)
    base = [sentence(rng, n) for n in (9, 14, 25, 60, 120, 300)]
    rows += [(1000 + i, near(rng, base[i % 6], i // 12), "en", "s", 1) for i in range(72)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.jaccard_groups(spark.createDataFrame(rows, SCHEMA), k, num, block=block).collect()}
    want = brute(rows, k, num)
    assert got == want and sum(v[1] != d for d, v in want.items()) > 25


def test_tree_finds_all_links():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
    sets = []
    for k in range(120):
        own = pool[(k % 20) * 100 : (k % 20) * 100 + 100].copy()
        own[rng.integers(0, 100, rng.integers(0, 14))] = rng.integers(0, 1 << 62, 1, dtype=np.uint64)
        sets.append(np.unique(own))
    for side in (np.zeros(120, int), np.arange(120) % 2):
        got = N.linked(sets, side, 85, 100)
        root = list(range(120))
        find = lambda x: x if root[x] == x else find(root[x])
        want = list(range(120))
        seek = lambda x: x if want[x] == x else seek(want[x])
        for i, j in got:
            root[max(find(i), find(j))] = min(find(i), find(j))
        for i in range(120):
            for j in range(i):
                o = N.overlap(sets[i], sets[j])
                if 100 * o >= 85 * (len(sets[i]) + len(sets[j]) - o) and (not side.any() or side[i] != side[j]):
                    want[max(seek(i), seek(j))] = min(seek(i), seek(j))
        assert [find(k) for k in range(120)] == [seek(k) for k in range(120)]


def test_keys_meet():
    """Every pair at the limit shares a key, whatever the sizes."""
    rng = np.random.default_rng(5)
    for n in [*range(7, 40), 75, 100, 171, 400]:
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        for drop in range(n):
            if 100 * (n - drop) < 85 * n:
                break
            assert np.intersect1d(N.part_keys(a, 85, 100), N.part_keys(a[drop:], 85, 100)).size or not drop


def test_keep_one_and_empty(spark):
    rows = corpus(12, 25)
    df = spark.createDataFrame([(*r, 5) for r in rows + rows[:1]], SCHEMA + ", k1 int")
    out = N.keep_one(df)
    want = sorted(d for d, v in brute(rows, 5, 80).items() if v[1] == d)
    assert sorted(r.doc_id for r in out.collect()) == want and out.columns == df.columns
    assert N.keep_one(df.limit(0)).count() == 0


def test_keep_one_null_and_repeated_ids(spark):
    """Unlinked documents stay whatever their ids; of each group one row stays."""
    rng = Random(3)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, b), (None, b + " more"), (7, c), (7, d), (9, d + " more"), (5, e), (None, e + " more"), (None, None), (None, " "), (3, "")]
    got = [(r.doc_id, r.text) for r in N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    texts = [t for _, t in got]
    assert {(None, a), (7, c), (7, d), (5, e), (None, None), (None, " "), (3, "")} <= set(got)
    assert sum(t in (b, b + " more") for t in texts) == 1 and len(got) == 8
