"""Every operator and stage on one set of odd inputs: no rows, nulls, empty and long texts, ties, repeated rows, clashing names."""

import pytest
from corpus import SCHEMA, sentence
from random import Random

from tessella.llm import class_model, embedding_dedup, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules, suffix_dedup, token_files
from tessella.llm.tokens import public_path
from tessella.storage import new_path

corpus_pipeline = pytest.importorskip("corpus_pipeline")

#: Columns named as inner ones are.
INNER = "_id _key _k _k1 _k2 _doc _row _own _at _tie _host _left _removed _lines _slice k1 k2 raw node n keys bits component group root hub bucket side own bytes marks first whole found runs kept_text size target positions held_out x words line kept ids length".split()


def odd(n=12):
    rng = Random(n)
    long = "\n".join(sentence(rng, 12) for _ in range(1500))
    same = sentence(rng, 80)
    rows = [(k, sentence(rng, 70), "en", f"s{k % 2}", 1) for k in range(n)]
    rows += [(100, long, "en", "s0", 1), (100, long, "en", "s0", 1), (101, long + " end", "en", None, 1), (None, same, None, None, None), (None, same, None, None, None), (7, same, "en", "s1", 1)]
    return [*rows, (None, None, None, None, None), (102, "", "en", "s0", 0), (103, " \n\t\n", "en", "s1", 4), (104, "x" * 30_000, "en", "s0", 1)]


def tables(spark):
    full = spark.createDataFrame([(*r, *range(len(INNER))) for r in odd()], SCHEMA + "".join(f", {c} int" for c in INNER))
    return full, full.limit(0)


FILE = "word_bpe_49k.json"


def files(docs):
    dictionary = token_files.train_dictionary(docs, public_path(FILE))
    return token_files.read_files(token_files.write_files(docs, new_path(docs.sparkSession, "odd"), public_path(FILE), dictionary), dictionary)


def quality(docs):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(3, None)], "doc_id long, quality int")
    featured = quality_model.with_features(docs, ["doc_id"])
    return quality_model.score(featured, quality_model.train(featured, labels), ["doc_id"])


#: Operators that return a row a document.
OPERATORS = {
    "op1": suffix_dedup.remove_repeats, "op2": quality, "op3": mixing.plan, "op5": lambda d: quality_rules.verdicts(quality_rules.measure(d)), "op6": class_model.score_documents,
    "op7": line_dedup.with_runs, "op8": files, "op10": lambda d: ngram_join.jaccard_groups(d.select("doc_id", "text"), 4, 85),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, name):
    full, none = tables(spark)
    assert OPERATORS[name](full).count() == len(odd()) and OPERATORS[name](none).count() == 0


def test_packing(spark):
    full, none = tables(spark)
    rows = packing.pack_documents(full).collect()
    assert sum(r.start == 0 for r in rows) == len(odd()) and packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage(spark, name):
    """Stages keep the columns and clean documents, whatever the names; repeated clean rows meet defined ends."""
    full, none = tables(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, full, "")
    assert out.columns == full.columns and stage(spark, none, "").count() == 0
    kept = [r.doc_id for r in out.collect()]
    if name != "mixing":
        assert set(range(12)) <= set(kept)
    assert all(r.asDict()["_k1"] == INNER.index("_k1") for r in out.limit(3).collect())


def test_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (None, [0.0, 0.0], 1), (4, [], 1), (5, [1.0, 0.01], 1)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, label int, node int, unit int, signs int")
    got = sorted((str(r.vec_id), r.n_links) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [("1", 2), ("1", 2), ("2", 0), ("3", 0), ("4", 0), ("5", 2), ("None", 0)]


def test_labels_of_text(spark):
    rows = [(1, [1.0, 0.0], "cat"), (2, [1.0, 0.0], "cat"), (3, [1.0, 0.0], "dog"), (4, [1.0, 0.0], None), (5, [1.0, 0.0], "")]
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
