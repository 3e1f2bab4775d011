"""A corpus pipeline over `documents`: rules, line dedup, near-duplicate groups, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of documents: rejected documents are gone, texts lack deleted lines, one document of each group stays, and a
document that the mix takes twice is there twice. The last returns a row for each packed piece.

Defined cases: null and blank texts fail the rules; null ids and sources are values of their own; rows that repeat id and
text stay one at most after the near copies; a source may be short of its target only by half a document; columns of any
name pass; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tessella.llm.common import materialize
from tessella.shipping import ship


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    ship(spark)
    return ngram_join.keep_one(docs, 5, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("ngram_join", near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: Tokenizing and signature trees have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
