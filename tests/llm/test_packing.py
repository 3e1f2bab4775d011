import zlib

import numpy as np
from corpus import SCHEMA, corpus
from hypothesis import given
from hypothesis import strategies as st
from test_token_files import ids_of

from tessella.llm import packing as P
from tessella.llm.tokens import public_path


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=20))
def test_patterns_hold_every_length_once(histogram):
    found = P.patterns(histogram, 64)
    placed = {}
    for lengths, n in found:
        assert sum(lengths) <= 64 and n > 0
        for x in lengths:
            placed[x] = placed.get(x, 0) + n
    assert placed == histogram


def test_pack(spark):
    rows = corpus(8, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    size = 128
    got = P.pack(P.materialize(P.cut(df, public_path("byte_bpe_50k.json"), size), "p"), size).collect()
    ids = dict(zip([r[0] for r in rows], ids_of([r[1] for r in rows], "byte_bpe_50k.json"), strict=True))
    by_doc, by_sequence = {}, {}
    for r in got:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, parts in by_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[doc_id])
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(map(len, ids.values())) / (len(by_sequence) * size) > 0.9
    assert P.pack_documents(df.limit(0)).count() == 0
