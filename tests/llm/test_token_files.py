import zlib
from functools import cache

import numpy as np
from corpus import SCHEMA, corpus
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import token_files as T
from tessella.llm.tokens import encoder, public_path
from tessella.storage import new_path


@cache
def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path(name))


def ids_of(texts, name):
    t = library(name)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_encoder_equals_library():
    odd = ["<|endoftext|> a", "  lead", "tab\t\tend\n\n x", "Don't  STOP'LL", "naïve Éa, ümlaut; ς Σ", "\xa0\xa0x \x85y", "a\x01b", "123abc_!?", "é combining", ""]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        got = [np.frombuffer(b, "<u2").tolist() for b in encoder(public_path(name)).many(odd)]
        assert got == [x[:-1] for x in ids_of(odd, name)]


PARTS = ["<|endoftext|>", "<|startoftext|>", "MERKEZ\u0130", "\u0130", "gaz\u0131", "Stra\u00dfe", "\u03a3\u03b1\u03c2", "e\u0301", "\u0307", "\u0338", "\u200d", "don't", "we'LL", "o'clock", "a", "Bc", "123", "4\u00bd", "\u4e2d\u6587", "\U0001f600", "\x01", "\x85", "\xa0", "\u3000", "\r\n", "\t", " ", "  ", ".", ",", "...", "!?", "-", "_", "#", "'", "\"", "<|", "|>", "="]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=12).map("".join))
def test_any_text_equals_library(text):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        assert [*np.frombuffer(encoder(public_path(name)).many([text])[0], "<u2").tolist(), 1] == ids_of([text], name)[0]


def test_round_trip(spark):
    rows = corpus(7)
    docs = spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)
    file = public_path("word_bpe_49k.json")
    dictionary = T.train_dictionary(docs, file)
    shards = T.write_files(docs, new_path(spark, "t"), file, dictionary)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.read_files(shards, dictionary).collect()}
    start = 0
    for (doc_id, *_), ids in zip(rows, ids_of([r[1] for r in rows], "word_bpe_49k.json"), strict=True):
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    shard = shards.first()
    store, path = T.filesystem(shard.path)
    entry = T.read_index(store, path, dictionary)[2]
    assert len(T.read_document(store, path, entry, dictionary)) == entry[4]


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([], SCHEMA)
    file = public_path("word_bpe_49k.json")
    dictionary = T.train_dictionary(docs, file)
    assert T.read_files(T.write_files(docs, new_path(spark, "t"), file, dictionary), dictionary).count() == 0
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    rows = T.read_files(T.write_files(docs, new_path(spark, "t"), file, dictionary), dictionary).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1] and [r.start for r in rows] == [0, 2, 4]
