import hashlib
from collections import Counter

import numpy as np
import pytest
from random import Random

from corpus import SCHEMA, corpus, sentence

from tessella.llm import suffix_dedup as S


def brute(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "window", "group"), [(60, 32, 10_000), (60, 32, 1), (40, 16, 10_000)])
def test_brute_force(spark, length, window, group):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df, length, window, group).collect()}
    want = brute([(r[1] or "").encode() for r in rows], length)
    assert got == {r[0]: w for r, w in zip(rows, want, strict=True)}
    assert sum(w[1] > 0 for w in want) > 10


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", k1 string, marks string, bytes int")
    assert S.remove_repeats(df).count() == 0
    one = spark.createDataFrame([(None, "z" * 500, "en", "s", 1, "a", "b", 2), (None, "z" * 500, "en", "s", 1, "a", "b", 2)], SCHEMA + ", k1 string, marks string, bytes int")
    assert [r.n_removed for r in S.remove_repeats(one).collect()] == [500, 500]


def test_passages_of_words(spark):
    """A passage of 50 words that another document holds is found, whatever the white space; fewer than 25 are none."""
    rng = Random(4)
    passage, short = sentence(rng, 50), sentence(rng, 24)
    texts = [sentence(rng, 90) + " " + passage + " " + sentence(rng, 30), passage.replace(" ", "\n  "), sentence(rng, 40) + " " + short + " " + sentence(rng, 40)]
    texts += [sentence(rng, 40) + " " + short + " " + sentence(rng, 40), sentence(rng, 200), passage + " " + passage + " x", None, "", sentence(rng, 49)]
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id for r in S.remove_repeats(df).collect() if r.n_passages}
    assert found == {0, 1, 5}
