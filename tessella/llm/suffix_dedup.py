"""Exact repeated-substring removal by a depth-limited radix order of suffixes.

Suffixes are ordered only through `length` bytes, most significant digits first, and a digit is a block of bytes. The
suffixes that enter are those at the text's window minima: any two equal strings of `length` bytes hold a minimum at the
same place, so they are seen as two suffixes that agree from there on.

Pass 1: the digit is the block of bytes that all strings around a minimum share; suffixes alone in their group leave.
Pass 2: the digit is the whole surrounding (the `window` - 1 bytes before, `length` bytes after); suffixes that share
it have every string repeated. Pass 3: within the groups of pass 1, the last digits: each string of `length` bytes
around a minimum against those at the same distance; equal groups are exactly the repeated strings. A group is ordered
in memory up to `GROUP` surroundings; the last digits of larger groups are counted by Spark, a row a string.

Passages of words are found beside, by winnowing: of the hashes of all runs of RUN words the least of each RUN_WINDOW
neighbours is a fingerprint, so two texts that share RUN + RUN_WINDOW - 1 words in a row share one.

Bytes are compared by 64-bit hashes of digits. Every join is of written tables or plain rows on hashes, dealt out by Spark,
whose adaptive plans split the part of a hot one. Defined cases: null text is empty; texts shorter than `length` lose
nothing; rows that repeat an id are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, discard_since, mark, materialize, release

LENGTH, WINDOW, GRAM = 400, 256, 8
#: Words of a fingerprint, and runs of which one gives it: every passage of 50 words has one.
RUN, RUN_WINDOW = 25, 26
#: Surroundings of one group that are ordered in one task's memory (about 6 kB each).
GROUP = 10_000
_PLACE = np.uint64((1 << 28) - 1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0xD1342543DE82EF95

_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))

_powers: dict[str, np.ndarray] = {}


def _table() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, np.uint64(base))
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
        _powers["table"] = _table()
    return _powers["table"], _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C1
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def prefix_hashes(text: bytes) -> np.ndarray:
    table, up, _ = powers(len(text) + 1)
    prefix = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(table[np.frombuffer(text, np.uint8)] * up[: len(text)], out=prefix[1:])
    return prefix


def window_minima(value: np.ndarray, window: int) -> np.ndarray:
    """Places of the least value of each `window` neighbours; the lower bits of a value give way to its place."""
    value = (value & ~_PLACE) | np.arange(len(value), dtype=np.uint64)
    step = 1
    while step < window:
        near = min(step, window - step)
        value = np.minimum(value[:-near], value[near:])
        step *= 2
    return (value[np.concatenate(([True], value[1:] != value[:-1]))] & _PLACE).astype(np.int64)


def fingerprints(text: bytes, prefix: np.ndarray) -> np.ndarray:
    """Distinct hashes of the runs of RUN words that are least among RUN_WINDOW neighbours."""
    space = np.concatenate(([True], _SPACE[np.frombuffer(text, np.uint8)], [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, stop = edge[::2], edge[1::2]
    if len(start) < RUN + RUN_WINDOW - 1:
        return np.zeros(0, np.uint64)
    _, up, down = powers(len(text) + 1)
    word = mixed((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * up[: len(word)], out=sums[1:])
    runs = mixed((sums[RUN:] - sums[:-RUN]) * down[: len(word) - RUN + 1])
    return np.unique(runs[window_minima(runs, RUN_WINDOW)])


def anchors(text: bytes, length: int, window: int, prefix: np.ndarray | None = None) -> tuple[np.ndarray, ...] | None:
    """Places of the window minima; strings around each start `low` to `high` bytes before it; first digit, whole digit."""
    n = len(text)
    if n < length:
        return None
    _, _, down = powers(n + 1)
    grams = np.ndarray((n - GRAM + 1,), "<u8", buffer=text, strides=(1,))
    at = window_minima(mixed(grams * _C2)[: n - length + window], window)
    prefix = prefix_hashes(text) if prefix is None else prefix
    first = mixed((prefix[at + length - window + 1] - prefix[at]) * down[at])
    start, end = np.maximum(at - window + 1, 0), np.minimum(at + length, n)
    whole = mixed((prefix[end] - prefix[start]) * down[start] + mixed(((at - start) * 4096 + end - at).astype(np.uint64)))
    return at, np.maximum(at + length - n, 0), at - start, first, whole


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def suffixes(docs: DataFrame, length: int, window: int) -> DataFrame:
    """(k1, k2, first, whole, n): the digits of each text's suffixes, equal ones of a text counted; fingerprints of words
    as `first` with n = 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("k1", "k2", "first", "whole", "n")
        for pdf in batches:
            out, rows = [], 0
            for k1, k2, text in zip(pdf["k1"], pdf["k2"], pdf["bytes"], strict=True):
                prefix = prefix_hashes(text)
                parts = [(marks := _signed(fingerprints(text, prefix)), np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64))]
                if (found := anchors(text, length, window, prefix)) is not None:
                    whole, index, n = np.unique(found[4], return_index=True, return_counts=True)
                    parts.append((_signed(found[3][index]), _signed(whole), n))
                for first, whole, n in parts:
                    out.append((np.full(len(n), k1), np.full(len(n), k2), first, whole, n))
                    rows += len(n)
                if rows > 200_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))
                    out, rows = [], 0
            if out:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return docs.mapInPandas(run, "k1 long, k2 long, first long, whole long, n long")


def shared_passages(rows: DataFrame) -> DataFrame:
    """(k1, k2, n_passages): how many of a text's fingerprints other documents hold as well; exact copies count."""
    prints = rows.where("n = 0").select("k1", "k2", "first")
    shared = prints.groupBy("first").agg(F.count("*").alias("c")).where("c > 1").select("first")
    held = prints.join(materialize(shared, "shared-prints"), "first", "left_semi").distinct()
    return held.groupBy("k1", "k2").agg(F.count("*").alias("n_passages"))


def surroundings(asked: DataFrame, length: int, window: int) -> DataFrame:
    """(first, whole, low, high, around) for the asked suffixes of each text; `around` is padded to a fixed width."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, wanted in zip(pdf["bytes"], pdf["wanted"], strict=True):
                at, low, high, first, whole = anchors(text, length, window)
                whole = _signed(whole)
                padded = bytes(window) + text + bytes(length)
                _, index = np.unique(whole, return_index=True)
                for i in index[np.isin(whole[index], np.asarray(wanted, np.int64))]:
                    a = int(at[i])
                    rows.append((int(_signed(first)[i]), int(whole[i]), int(low[i]), int(high[i]), padded[a + 1 : a + window + length]))
                if len(rows) > 4000:
                    yield pd.DataFrame(rows, columns=["first", "whole", "low", "high", "around"])
                    rows = []
            yield pd.DataFrame(rows, columns=["first", "whole", "low", "high", "around"])

    return asked.mapInPandas(run, "first long, whole long, low int, high int, around binary")


def string_hashes(around: list[bytes], length: int, window: int) -> np.ndarray:
    """[row, d]: hash of the string that starts d bytes before the minimum."""
    table, up, down = powers(window + length)
    width = window + length - 1
    grid = np.frombuffer(b"".join(around), np.uint8).reshape(-1, width)
    prefix = np.zeros((len(around), width + 1), np.uint64)
    np.cumsum(table[grid] * up[:width], axis=1, out=prefix[:, 1:])
    start = np.arange(window - 1, -1, -1)
    return mixed((prefix[:, start + length] - prefix[:, start]) * down[start])


def last_digits(rows: DataFrame, length: int, window: int) -> DataFrame:
    """(first, whole, mask): bit d tells that the string d bytes before the minimum is held by another suffix as well.

    Rows come sorted by `first`; whole groups are ordered together, many small ones at a time.
    """

    def order(pdf: pd.DataFrame) -> pd.DataFrame:
        distance = np.arange(window)
        valid = (pdf["low"].to_numpy()[:, None] <= distance) & (distance <= pdf["high"].to_numpy()[:, None])
        marks = np.zeros((len(pdf), window), bool)
        hashes = np.asfortranarray(string_hashes(list(pdf["around"]), length, window))
        for d in range(window):
            own = np.flatnonzero(valid[:, d])
            column = hashes[own, d]
            s = np.sort(column)
            twice = s[1:][s[1:] == s[:-1]]
            if len(twice):
                k = np.minimum(np.searchsorted(twice, column), len(twice) - 1)
                marks[own, d] = twice[k] == column
        some = marks.any(axis=1)
        bits = np.packbits(marks[some], axis=1, bitorder="little")
        return pd.DataFrame({"first": pdf["first"].to_numpy()[some], "whole": pdf["whole"].to_numpy()[some], "mask": [b.tobytes() for b in bits]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, n = [], 0
        for pdf in batches:
            kept.append(pdf)
            n += len(pdf)
            if n >= 3000:
                every = pd.concat(kept, ignore_index=True)
                done = int(np.searchsorted(every["first"].to_numpy(), every["first"].iloc[-1], "left"))
                if done:
                    for piece in _whole_groups(every.iloc[:done]):
                        yield order(piece)
                kept, n = [every.iloc[done:]], len(every) - done
        if n:
            for piece in _whole_groups(pd.concat(kept, ignore_index=True)):
                yield order(piece)

    return rows.sortWithinPartitions("first").mapInPandas(run, "first long, whole long, mask binary")


def _whole_groups(pdf: pd.DataFrame, about: int = 3000) -> Iterator[pd.DataFrame]:
    first, at = pdf["first"].to_numpy(), 0
    while at < len(pdf):
        end = int(np.searchsorted(first, first[min(at + about, len(pdf)) - 1], "right"))
        yield pdf.iloc[at:end].reset_index(drop=True)
        at = end


def last_digits_large(rows: DataFrame, length: int, window: int) -> DataFrame:
    """As last_digits, for groups of any size: Spark counts a row a string, with partial counts before the shuffle."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 1000):
                part = pdf.iloc[k : k + 1000]
                hashes, d = string_hashes(list(part["around"]), length, window), np.arange(window)
                row, d = np.nonzero((part["low"].to_numpy()[:, None] <= d) & (d <= part["high"].to_numpy()[:, None]))
                yield pd.DataFrame({"first": part["first"].to_numpy()[row], "whole": part["whole"].to_numpy()[row], "d": d.astype(np.int32), "string": _signed(hashes[row, d])})

    def masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for places in pdf["places"]:
                marks = np.zeros(window, bool)
                marks[np.asarray(places)] = True
                out.append(np.packbits(marks, bitorder="little").tobytes())
            yield pd.DataFrame({"first": pdf["first"], "whole": pdf["whole"], "mask": out})

    strings = materialize(rows.mapInPandas(explode, "first long, whole long, d int, string long"), "large-groups")
    twice = strings.groupBy("d", "string").agg(F.count("*").alias("n")).where("n > 1").select("d", "string")
    found = strings.join(twice, ["d", "string"]).groupBy("first", "whole").agg(F.collect_set("d").alias("places"))  # at most `window`
    return found.mapInPandas(masks, "first long, whole long, mask binary")


def cover(text: bytes, marks: dict[int, bytes | None], length: int, window: int) -> np.ndarray:
    """Which bytes lie in a repeated string; `marks`: by whole digit a mask, or None where all strings are repeated."""
    edge = np.zeros(len(text) + 1, np.int64)
    at, low, high, _, whole = anchors(text, length, window)
    for i, w in enumerate(_signed(whole).tolist()):
        if w in marks:
            if marks[w] is None:
                edge[at[i] - high[i]] += 1
                edge[at[i] - low[i] + length] -= 1
            else:
                d = np.flatnonzero(np.unpackbits(np.frombuffer(marks[w], np.uint8), bitorder="little"))
                np.add.at(edge, at[i] - d, 1)
                np.add.at(edge, at[i] - d + length, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_marks(keyed: DataFrame, rows: DataFrame, length: int = LENGTH, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(k1, k2, digits, masks): for each text with repeated strings, its suffixes' whole digits and masks (null: all)."""
    rows = rows.where("n > 0")
    # pass 2 is counted before pass 1, so that copies shrink to a row before groups meet
    counted = materialize(rows.groupBy("first", "whole").agg(F.sum("n").alias("c")), "suffix-counts")
    groups = materialize(counted.groupBy("first").agg(F.count("*").alias("m")).where("m > 1"), "suffix-groups")
    status = counted.join(groups, "first", "left").withColumn("m", F.coalesce("m", F.lit(1).cast("long"))).where("c > 1 or m > 1")
    status = materialize(status, "suffix-status")
    discard(counted)
    held = materialize(rows.select("k1", "k2", "first", "whole").join(status, ["first", "whole"]), "suffixes-held")
    release(keyed.sparkSession)
    # pass 3: one text shows each surrounding
    shown = held.where("m > 1").groupBy("first", "whole").agg(F.min(F.struct("k1", "k2")).alias("k"), F.first("m").alias("m"))
    asked = shown.groupBy("k.k1", "k.k2").agg(F.collect_set("whole").alias("wanted"))  # at most a text's suffixes
    texts = keyed.where(F.length("bytes") >= length).join(materialize(asked, "surroundings-asked"), ["k1", "k2"])
    around = materialize(surroundings(texts.select("bytes", "wanted"), length, window).dropDuplicates(["first", "whole"]), "surroundings")
    large = materialize(groups.where(F.col("m") > group).select("first"), "large-firsts")
    masks = last_digits(around.join(large, "first", "left_anti").repartition("first"), length, window)
    if large.limit(1).count():
        masks = masks.unionByName(last_digits_large(around.join(large, "first", "left_semi"), length, window))
    masks = materialize(masks, "suffix-masks")
    discard(around, status, groups)
    release(keyed.sparkSession)
    marks = held.join(masks, ["first", "whole"], "left").where("c > 1 or mask is not null")
    marks = marks.select("k1", "k2", "whole", F.when(F.col("c") == 1, F.col("mask")).alias("mask")).distinct()
    return marks.groupBy("k1", "k2").agg(F.collect_list(F.struct("whole", "mask")).alias("marks"))  # at most a text's suffixes


def keyed_texts(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.withColumn("bytes", raw).withColumn("k1", F.xxhash64("bytes")).withColumn("k2", F.xxhash64(F.lit(2), "bytes"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, kept_bytes (null where the whole text is kept)."""
    keyed = keyed_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    point, texts = mark(), keyed.select("k1", "k2", "bytes")
    rows = materialize(suffixes(texts, length, window), "suffix-digits")
    passages = materialize(shared_passages(rows), "shared-passages")
    marks = materialize(repeated_marks(texts, rows, length, window, group), "repeat-marks")
    discard(rows)
    found = materialize(marks.join(passages, ["k1", "k2"], "full"), "text-findings")
    discard_since(point, found)
    release(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 500):
                rows, part = [], pdf.iloc[k : k + 500]
                for doc_id, text, passages, found in zip(part["doc_id"], part["bytes"], part["n_passages"], part["marks"], strict=True):
                    kept, spans = text, 0
                    if found is not None and len(found):
                        gone = cover(text, {m["whole"]: m["mask"] for m in found}, length, window)
                        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + bool(gone[0])
                    rows.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), passages, kept if spans else None))
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "kept_bytes"]).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, kept_bytes binary"
    out = keyed.join(found, ["k1", "k2"], "left").withColumn("n_passages", F.coalesce("n_passages", F.lit(0).cast("long")))
    return out.select("doc_id", "bytes", "n_passages", "marks").mapInPandas(run, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_bytes")
