import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import SCHEMA, corpus

from tessella.llm import class_model as C


@pytest.mark.parametrize("looked_up", [200_000, 20])
def test_base_score(spark, monkeypatch, looked_up):
    monkeypatch.setattr(C, "LOOKED_UP", looked_up)
    rows = corpus(6, 80)
    got = {r.doc_id: r for r in C.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    train = Counter(w for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1 for w in tokens(r[1]))
    n, v = sum(train.values()), len(train)
    for r in rows:
        own, g = tokens(r[1]), got[r[0]]
        want = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(own), sum(train[w] > 0 for w in own), n)
        assert g.base_score == pytest.approx(want) and g.held_out == (zlib.crc32(str(r[0]).encode()) % 5 == 1)
        assert g.score < 0


@pytest.mark.parametrize("looked_up", [200_000, 20])
def test_score_by_brute_force(spark, monkeypatch, looked_up):
    """From the learned classes alone: class bigrams and words counted in plain Python, each text's path summed."""
    monkeypatch.setattr(C, "LOOKED_UP", looked_up)
    kept = {}
    learn = C.learn_classes
    monkeypatch.setattr(C, "learn_classes", lambda *a: kept.setdefault("x", learn(*a)))
    rows = corpus(6, 80)
    got = {r.doc_id: r.score for r in C.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    cls = {r["hash"]: r.cls for r in kept["x"][0].collect()}
    words = {r[0]: (r[1] or "").encode().lower().split() for r in rows}
    key = {w: (int(C.hashed(w)[0].view(np.int64)[0]), int(C.hashed(w)[1][0]) + C.CLASSES) for ws in words.values() for w in ws}
    kind = lambda w: cls.get(key[w][0], key[w][1])
    path = lambda ws: [C.START, *map(kind, ws), C.STOP]
    train = [words[r[0]] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 1]
    seen = Counter(w for ws in train for w in ws)
    kinds = lambda w: [kind(w), key[w][1]] if seen[w] == 1 else [kind(w)]
    paths = [[[C.START], *map(kinds, ws), [C.STOP]] for ws in train]
    pair = Counter((a, b) for p in paths for x, y in zip(p, p[1:]) for a in x for b in y)
    left, right, n = Counter(), Counter(), sum(pair.values())
    for (a, b), c in pair.items():
        left[a] += c
        right[b] += c
    mass, types = Counter(), Counter(map(kind, seen))
    for w, c in seen.items():
        mass[kind(w)] += c
    share = lambda b: (right[b] + 0.5) / (n + 0.5 * C.SYMBOLS)
    move = lambda a, b: 0.95 * (pair[a, b] / left[a] if left[a] else share(b)) + 0.05 * share(b)
    emit = lambda w: (seen[w] + 0.5) / max(mass[kind(w)] + 0.5 * (types[kind(w)] + (kind(w) >= C.CLASSES)), 0.5)
    for r in rows:
        ws = words[r[0]]
        want = sum(math.log10(move(a, b)) for a, b in zip(path(ws), path(ws)[1:])) + sum(math.log10(emit(w)) for w in ws)
        assert got[r[0]] == pytest.approx(want), r[0]


def test_probabilities_sum_to_one():
    """Transitions over classes, and emissions of a class over its words and one unknown."""
    size = C.STOP + 1
    counts = np.random.default_rng(0).integers(0, 5, (size, size)).astype(float)
    counts[7] = 0
    mass, types = np.full(size, 30.0), np.full(size, 4.0)
    m = C.Model(np.arange(C.SYMBOLS), counts, mass, types)
    assert (10**m.transition).sum(axis=1) == pytest.approx(1.0)
    words = np.array([15.0, 10, 4, 1])
    tail = np.full(4, C.CLASSES)
    assert (10 ** m.emission(words, tail)).sum() + 10 ** m.emission(np.zeros(1), tail[:1])[0] == pytest.approx(1.0)
    assert (10 ** m.emission(words, tail - 1)).sum() == pytest.approx(1.0)


def test_classes_help_and_empty(spark):
    """Words that alternate between two kinds: the class bigram beats the words' own shares."""
    import random

    rng = random.Random(0)
    text = lambda: " ".join(rng.choice("abcdefgh") + "x" if k % 2 else rng.choice("ijklmnop") + "y" for k in range(60))
    df = spark.createDataFrame([(k, text()) for k in range(200)], "doc_id long, text string")
    rows = [r for r in C.score_documents(df).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.85
    assert C.score_documents(df.limit(0)).count() == 0


def test_every_training_word_is_clustered(spark):
    """Rare words too: 5,000 words of two kinds, each seen four times after a word of its kind, get classes that tell the kinds apart."""
    import random

    rng = random.Random(1)
    x, y = ([f"{rng.randrange(10**9)}{k}" for k in range(2500)] for _ in "xy")
    bags = [rng.sample(kind * 4, 10_000) for kind in (x, y)]
    texts = [" ".join(w for a, b in zip(bags[0][k : k + 50], bags[1][k : k + 50], strict=True) for w in ("the", a, "to", b)) for k in range(0, 10_000, 50)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select(C.F.col("text").cast("binary").alias("raw"))
    trace = []
    learned, _, counts, _ = C.learn_classes(docs, 4, trace)
    assert len(trace) > 2 and all(a < b for a, b in zip(trace, trace[1:], strict=False))
    cls = {r["hash"]: r.cls for r in learned.collect()}
    assert len(cls) == len({*x, *y}) + 2 and counts.sum() == 40_000 + len(texts)
    of = [{cls[int(h)] for h in C.hashed(" ".join(kind).encode())[0].view(np.int64)} for kind in (x, y)]
    assert max(max(s) for s in of) < C.CLASSES and not of[0] & of[1]


def test_endings_of_unknown_words(spark):
    """Words seen once end in -ing after `is` and in -ed after `was`: an unknown word of either kind is likelier in its place."""
    rows = [(k, f"is w{k}xing now and was w{k}yed then") for k in range(400)]
    rows += [(1000 + k, " ".join((["is", f"q{k}ing"] if k % 2 else ["is", f"q{k}xed"]) + ["now"])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in C.score_documents(docs, C.F.col("doc_id") >= 1000).collect()}
    right, wrong = ([got[1000 + k] for k in range(40) if k % 2 == odd] for odd in (1, 0))
    assert min(right) > max(wrong)
    assert C.hashed(b"aing")[1] == C.hashed(b"bing")[1] != C.hashed(b"xed")[1]


def test_texts_are_hashed_together():
    """Words of 1 to 200 bytes, blank and odd texts: a text's hashes do not follow from what stands beside it, and no two words share one."""
    import random

    rng = random.Random(2)
    words = list({bytes(rng.choice(b"ab\xc3\x00\x85") for _ in range(rng.randint(1, 200))) for _ in range(3000)} | {b"x" * k for k in range(1, 200)})
    texts = [b"", b" \t\x0b", b"\x0cone\r\n", *(b" \n".join(rng.choices(words, k=rng.randint(0, 90))) + b"\t" * rng.randint(0, 2) for _ in range(200)), b"AbC " * 3]
    hashes, kinds, n = C.hashed_texts(texts)
    assert list(n) == [len(t.split()) for t in texts] and len(hashes) == sum(n)
    for t, own, kind in zip(texts, np.split(hashes, np.cumsum(n)[:-1]), np.split(kinds, np.cumsum(n)[:-1]), strict=True):
        assert (own == C.hashed(t)[0]).all() and (kind == C.hashed(t)[1]).all()
    assert len({int(C.hashed(w)[0][0]) for w in words}) == len(words)
    assert C.hashed(b"AbC")[0] == C.hashed(b"abc")[0] != C.hashed("äbc".encode())[0]
    assert b"".join(b"".join(g) for g in C.groups_of(texts)) == b"".join(texts)


def sides_of(spark, rows, parts=3):
    docs = C.raw_text(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text"))
    pairs = C.materialize(C.words_and_pairs(docs, parts), "pairs")
    sizes = {r.part: len(r.other) // 8 for r in pairs.where("dst is null").collect()}
    first = np.cumsum([0, *(sizes.get(k, 0) for k in range(parts))])
    return C.word_sides(pairs, first, parts), int(first[-1])


def test_exchange_by_whole_grids(spark):
    """The class of each word, seen once or often, is the best by the counts of all its neighbours' classes."""
    sides, total = sides_of(spark, corpus(3, 30))
    rng = np.random.default_rng(0)
    classes = np.append(rng.integers(0, C.CLASSES, total), (C.START, C.STOP)).astype(np.uint8)
    counts = rng.integers(0, 50, (C.SYMBOLS, C.SYMBOLS)).astype(float)
    log_in = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * C.SYMBOLS)[None, :])[:, : C.CLASSES]
    log_out = np.log((counts + 0.1) / (counts.sum(axis=1) + 0.1 * C.SYMBOLS)[:, None])[: C.CLASSES].T
    gain, seen = np.zeros((total, C.CLASSES)), np.zeros(total, int)
    for r in sides.where("chunk >= 0").collect():
        for log, own, other, n in ((log_in, r.own0, r.other0, r.n0), (log_out, r.own1, r.other1, r.n1)):
            own, other, n = np.frombuffer(own, "<u2"), np.frombuffer(other, "<u4"), np.frombuffer(n, "<i8")
            n = np.append(n, np.ones(len(own) - len(n), np.int64))
            np.add.at(gain, r.first + own, log[classes[other]] * n[:, None])
            np.add.at(seen, r.first + own, n)
    moves = [m for parity in (0, 1) for m in C.exchange(sides, spark.sparkContext.broadcast(classes), counts, parity)]
    got = np.full(total, 255)
    for r in moves:
        got[r.first : r.first + len(r.cls)] = np.frombuffer(r.cls, np.uint8)
    assert (seen == 2).any() and (seen > 2).any()  # once on either side
    assert gain[np.arange(total), got] == pytest.approx(gain.max(axis=1))


def test_shuffle_files_go_when_tables_are_written(spark, monkeypatch):
    """No wait for the driver's garbage: what dealt out pairs and scores is gone once these are written."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in (lambda s: [s.apply(k).getName() for k in range(s.length())])(files.getAllFiles().toList()) if f.startswith("shuffle_") and f.endswith(".data")}
    write, left = C.materialize, {}

    def watched(df, name):
        before = held()
        out = write(df, name)
        left[name] = held() - before
        return out

    monkeypatch.setattr(C, "materialize", watched)
    C.score_documents(spark.createDataFrame(corpus(4, 20), SCHEMA)).count()
    assert {"word-pairs", "word-sides", "partial-scores"} <= set(left) and not left["word-pairs"] and not left["word-sides"]
