import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import SCHEMA, sentence
from random import Random
from test_line_dedup import brute as line_brute
from test_mixing import targets
from test_ngram_join import brute as join_brute
from test_token_files import ids_of

from tessella.llm.common import materialize

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def mixed_by_brute_force(kept, source):
    """How often each document is taken: sources in the order of a hash, twice, until their targets."""
    size, copies = {k: len(t.split()) for k, t in kept.items()}, Counter()
    total = Counter()
    for k in kept:
        total[source[k]] += size[k]
    want = targets(total)
    for s in total:
        begin = 0
        for _ in range(2):
            for k in sorted((k for k in kept if source[k] == s), key=lambda k: hashlib.md5(str(k).encode()).hexdigest()[:15]):
                copies[k] += begin + size[k] / 2 < want[s]
                begin += size[k]
    return +copies


def test_stages_against_brute_force(spark, tmp_path):
    rng = Random(3)
    docs = [(k, "\n".join(sentence(rng, 30) for _ in range(4)), "en", f"s{k % 3}", 1) for k in range(40)]
    docs += [(100 + k, docs[k][1], "en", "s0", 1) for k in range(5)]
    docs += [(200 + k, docs[10 + k][1].replace(docs[10 + k][1].split()[70], "edit", 1).replace("\n", " "), "en", "s1", 1) for k in range(5)]
    docs += [(300, None, None, None, None), (301, "short", "en", "s0", 5), (302, "spam spam spam " * 40, "en", "s0", 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "ngram_join", "mixing", "packing"]
    good = materialize(stages["quality_rules"](spark, df, ""), "a")
    assert sorted(r.doc_id for r in good.collect()) == [d[0] for d in docs[:-3]]
    lines = materialize(stages["line_dedup"](spark, good, ""), "b")
    want = {k: t for k, t in line_brute([(d[0], d[1]) for d in docs[:-3]], 50).items() if t.split()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    one = materialize(stages["ngram_join"](spark, lines, ""), "c")
    groups = join_brute(sorted(want.items()), 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(k for k, v in groups.items() if v[1] == k)
    mixed = materialize(stages["mixing"](spark, one, ""), "d")
    kept = {k: want[k] for k, v in groups.items() if v[1] == k}
    assert mixed.columns == df.columns and all(r.text == kept[r.doc_id] for r in mixed.collect())
    assert Counter(r.doc_id for r in mixed.collect()) == mixed_by_brute_force(kept, {d[0]: d[3] for d in docs})
    packed = stages["packing"](spark, mixed, "").collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    ids = dict(zip(texts, ids_of(texts.values(), "byte_bpe_50k.json"), strict=True))
    assert sum(r.length for r in packed) == sum(len(ids[r.doc_id]) for r in mixed.collect())
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) for r in packed)
    # the whole run, as it is registered
    df.write.parquet(f"{tmp_path}/documents.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = lambda rows: Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    assert pieces(whole) == pieces(packed)
    used = {}
    for r in sorted(whole, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 2048
