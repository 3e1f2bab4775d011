"""Packing documents into sequences by shortest-pack-first over the histogram of lengths.

A document's ids are cut into pieces of at most 2048. The histogram of piece lengths has 2048 bins whatever the input;
packing patterns with counts are found from it alone, longest length first, each length going onto the pattern with the
most room. Pieces are then ranked within their length and joined to the patterns' places by rank.

Defined cases: null text has the end id alone; rows that repeat an id are packed each; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, running_sum
from .tokens import encoder, public_path

SIZE, END = 2048, 1


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """(lengths, count) of packing patterns: lengths are placed longest first, on the shortest packs that have room."""
    open_packs: list[tuple[int, int, tuple[int, ...], int]] = []  # (-room, tie, lengths, count)
    done, tie = [], 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, lengths, count = heappop(open_packs)
                room = -room
            else:
                room, lengths, count = size, (), left
            used = min(left, count)
            left -= used
            for now, packs, n in ((room, lengths, count - used), (room - length, (*lengths, length), used)):
                if n and not packs:
                    continue
                if n and now:
                    heappush(open_packs, (-now, tie := tie + 1, packs, n))
                elif n:
                    done.append((packs, n))
    return [(list(p), n) for p, n in done] + [(list(p), n) for _, _, p, n in sorted(open_packs)]


def places(found: list[tuple[list[int], int]]) -> pd.DataFrame:
    """A row for each place of each pattern: its length, the ranks of the pieces that take it, first sequence, offset."""
    rows, ranks, sequence = [], {}, 0
    for lengths, count in found:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            rows.append((length, rank, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def cut(docs: DataFrame, file: str, size: int = SIZE) -> DataFrame:
    """Pieces of at most `size` ids: doc_id, start, length, ids_crc32, doc_tokens, ids (little-endian, unsigned 16 bit)."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        end = np.array([END], "<u2").tobytes()
        for pdf in batches:
            for k in range(0, len(pdf), 200):
                part, rows = pdf.iloc[k : k + 200], []
                for doc_id, ids in zip(part["doc_id"], encoder(file).many([x if isinstance(x, str) else None for x in part["text"]]), strict=True):
                    array = np.frombuffer(ids + end, "<u2")
                    for start in range(0, len(array), size):
                        own = array[start : start + size]
                        rows.append((doc_id, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), len(array)))
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to pieces, which are read more than once and so best materialized."""
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    table = places(patterns(histogram, size))
    keys, lengths = ((table["length"].to_numpy("int64") << 44) | table["rank"].to_numpy("int64")), table["rank"].to_numpy("int64")
    sequences, offsets = table["sequence"].to_numpy("int64"), table["offset"].to_numpy("int64")
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for pdf in batches:
            at = np.searchsorted(keys, (pdf["length"].to_numpy("int64") << 44) | pdf["_rank"].to_numpy("int64"), "right") - 1
            yield pdf[names].assign(sequence_id=sequences[at] + pdf["_rank"].to_numpy("int64") - lengths[at], offset=offsets[at])

    ordered = pieces.withColumn("_at", F.xxhash64("doc_id", "start", "ids_crc32")).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_sum(ordered, "length", "_at", ["doc_id", "start"], "_one", "_rank", pieces.count())
    return ranked.select(*names, "_rank").mapInPandas(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = SIZE, file: str | None = None) -> DataFrame:
    return pack(materialize(cut(docs, file or public_path("byte_bpe_50k.json"), size), "pieces"), size)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
