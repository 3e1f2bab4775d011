"""Near words, forms and roots against brute force; lists cut to any length; edge inputs."""

import re
import zlib
from collections import Counter
from random import Random

import pytest

from tessella.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(counts, ratio=10):
    out, form = {}, {}
    by = {}
    for w in counts:  # words that share a stretch with one code point less
        for k in range(len(w)):
            by.setdefault(w[:k] + w[k + 1 :], set()).add(w)
        by.setdefault(w, set()).add(w)
    for w, n in counts.items():
        maybe = set().union(*[by[w[:k] + w[k + 1 :]] for k in range(len(w))], by[w])
        own = [v for v in maybe if near(w, v)]
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
        out[w] = (n, len(own))
    rows = []
    for w, (n, k) in out.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, k, counts.get(form.get(w))))
    return sorted(rows, key=lambda r: r[0])


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda r: r[0])


def test_pairs_of_a_list():
    rng = Random(3)
    for _ in range(300):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 40))})
        want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])}
        got = list(spelling.near_in_list(words))
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("long", [2, 5, 128])
def test_every_pair_once(spark, long):
    """Few letters, so that words repeat themselves and agree at both ends; chains of forms."""
    rng = Random(long)
    words = {"".join(rng.choice("aabÿ") for _ in range(rng.randint(7, 10))): 10 ** rng.randint(0, 5) for _ in range(700)}
    words |= {"nnnnnnn": 1, "nnnnnnm": 10, "nnnnnmm": 100, "nnnnmmm": 1000, "nnnmmmm": 10_000, "nnmmmmm": 10_000}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(df, long=long)) == brute(words)


def test_documents(spark):
    """Nulls, blanks, capitals, long texts, repeated rows, clashing names, an empty table."""
    rng = Random(7)
    pool = ["Wahrheit", "wahrheit", "WAHRHEITEN", "libertés", "LIBERTÉS", "Àpropos", "kurz", "straenge", "strange1x"]
    docs = [(k, " ".join(rng.choice(pool) for _ in range(200))) for k in range(40)]
    docs += [(None, docs[0][1]), (None, docs[0][1]), (3, docs[3][1]), (50, None), (51, ""), (52, " \n"), (53, "Wahrheit," * 20_000), (54, "ab" * 30_000)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, word string")
    counted = spelling.vocabulary(spelling.damaged_runs(df))
    assert {r.word: r.n for r in counted.collect()} == brute_words(docs)
    assert rows_of(spelling.variants(counted)) == brute(brute_words(docs))
    assert spelling.variants(spelling.vocabulary(spelling.damaged_runs(df.limit(0)))).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(brute_words(docs))
    assert rows_of(spelling.op12(spark, sf)) == want and any(r[1] for r in want)
