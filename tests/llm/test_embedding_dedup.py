import numpy as np

from tessella.llm import embedding_dedup as E


def vectors(n=150, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        rows.append((k, rng.standard_normal(16).astype(np.float32).tolist(), k % 2))
    for k in range(40):  # near and exact copies
        base = np.array(rows[k % 12][1])
        rows.append((n + k, (base * 2 + (k % 3) * 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), rows[k % 12][2]))
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [None] + [1.0] * 15, 1), (903, [float("nan")] + [1.0] * 15, 1), (904, [float("inf")] + [1.0] * 15, 1), (905, rows[0][1], None), (906, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (908, [], 0)]
    return rows


def brute(rows, limit):
    good = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= limit:
                    links[a[0]].add(b[0])
    out = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[k] = (len(links[k]), min(seen))
    return out


def test_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute(rows, 0.93)
    assert sum(v[0] for v in want.values()) > 50
    for block in (1024, 4):
        got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df, block=block).collect()}
        assert got == want
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_and_names(spark):
    """Every row has its own vector's links; columns of any name are of no account."""
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 2), (7, [1.0, 0.01], 1), (6, [0.01, 1.0], 2), (8, [1.0, 1.0], 1), (8, [1.0, 1.0], 1), (None, [1.0, 1.01], 1)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, copies int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (6, 1, 5, False), (8, 2, 8, True), (8, 2, 8, True), (None, 2, 8, False)], key=str)


def test_shape_keeps_recall():
    for rows in (0, 1, 500, 51_282, 10**7, 10**10):
        bits, tables = E.shape_of(rows)
        assert (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** tables <= E.MISSED and (2**bits * E.BUCKET >= rows or bits == E.MOST_BITS)
