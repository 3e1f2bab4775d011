import random
import zlib

import numpy as np
from corpus import text

from tessella.llm import quality_model as Q


def labelled(n=600):
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.6
        t = text(rng, 4, 20) if good else rng.choice([" ".join(["buy", "now!!"] * 30), "| # $ % " * 20, "\n".join(["same words again"] * 15)])
        docs.append((k, t))
        labels.append((k, int(good)))
    return docs + [(n, None), (n + 1, ""), (n + 2, "w " * 50_000)], labels + [(n, None), (10_000, 1)]


def test_held_out_accuracy(spark, tmp_path):
    docs, labels = labelled()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.doc_id: r for r in Q.op2(spark, str(tmp_path)).collect()}
    assert len(rows) == len(docs)
    known = dict(labels)
    held = [r for r in rows.values() if r.held_out and known.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.values())
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_interaction_and_no_labels():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # seen only by a pair
    model = Q.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs and ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert (Q.fit(np.zeros((0, 3)), np.zeros(0)).score(x[:2]) == 0.5).all()


def best_cut(g, h):
    """The two-leaf tree by trying each cut; one leaf where no cut gains."""
    value = lambda s: g[s].sum() / (h[s].sum() + 1)
    worth = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    every = slice(0, len(g))
    cuts = [(worth(slice(0, k)) + worth(slice(k, len(g))) - worth(every), -k) for k in range(1, len(g))]
    out = np.full(len(g), value(every))
    if cuts and max(cuts)[0] > 1e-9:
        k = -max(cuts)[1]
        out[:k], out[k:] = value(slice(0, k)), value(slice(k, len(g)))
    return out


def test_trees_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h = rng.standard_normal(rng.integers(1, 9)), rng.random(9) + 0.1
        assert np.allclose(Q._tree(g, h[: len(g)], 2), best_cut(g, h[: len(g)]))
        gg, hh = rng.standard_normal((4, 5)), rng.random((4, 5)) + 0.1
        both = []
        for a, b in ((gg, hh), (gg.T, hh.T)):
            first = best_cut(a.sum(1), b.sum(1))
            out = np.zeros(a.shape)
            for v in np.unique(first):
                out[first == v] = best_cut(a[first == v].sum(0), b[first == v].sum(0))
            both.append(out)
        worth = [(both[0] * gg).sum(), (both[1].T * gg).sum()]
        assert np.allclose(Q._pair_tree(gg, hh), both[0] if worth[0] >= worth[1] else both[1].T)


def test_fit_by_brute_force():
    """The first rounds of boosting and every score again in plain loops over rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (200, 2)).astype(float)
    y = (rng.random(200) < 0.2 + 0.15 * x[:, 0]).astype(float)
    model = Q.fit(x, y)
    mean = y.mean()
    z, tables = np.full(200, np.log(mean / (1 - mean))), [np.zeros(len(e) + 1) for e in model.edges]
    where = [[sum(v >= c for c in e) for v in x[:, j]] for j, e in enumerate(model.edges)]
    for _ in range(Q.ROUNDS):
        for j, table in enumerate(tables):
            p = 1 / (1 + np.exp(-z))
            g, h = np.zeros(len(table)), np.zeros(len(table))
            for k, b in enumerate(where[j]):
                g[b] += y[k] - p[k]
                h[b] += p[k] * (1 - p[k])
            step = Q.RATE * Q._tree(g, h, Q.LEAVES)
            table += step
            z += step[where[j]]
    assert all(np.allclose(a, b) for a, b in zip(tables, model.tables, strict=True))
    pair = [[sum(v >= c for c in e) for v in x[:, j]] for j, e in enumerate(model.pair_edges)]
    for k, score in enumerate(model.score(x)):
        total = model.intercept + sum(t[where[j][k]] for j, t in enumerate(tables))
        total += sum(t[pair[i][k]][pair[j][k]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_empty_tables(spark, tmp_path):
    docs, labels = "doc_id long, text string", "doc_id long, quality int"
    spark.createDataFrame([], docs).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], labels).write.parquet(f"{tmp_path}/a/labels.parquet")
    assert Q.op2(spark, f"{tmp_path}/a").count() == 0
    spark.createDataFrame([(1, "a"), (None, None), (1, "")], docs).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([(1, None)], labels).write.parquet(f"{tmp_path}/b/labels.parquet")
    assert [r.score for r in Q.op2(spark, f"{tmp_path}/b").collect()] == [0.5] * 3
