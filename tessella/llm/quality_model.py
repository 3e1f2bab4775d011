"""Quality classifier: a generalised additive model with pairwise interactions, fitted by cyclic boosting.

Features of a text are cut into bins at quantiles. Rounds of boosting go through the features in turn; each turn fits a
shallow tree (up to four leaves over one feature's bins) to the logistic gradient and adds it, shrunk, to the feature's
lookup table. The residual then ranks pairs of features, and the best pairs get two-way tables by the same cycle. A
score is a sum of table entries, one gather a table for a whole batch.

Labels are learned from a bounded sample: at most TRAIN_ROWS labelled rows, those whose id's
hash falls in a share of its range.
Defined cases: null text is empty and scored as such; rows that repeat an id are scored each; without any labelled row
the score is 1/2; labels that are null do not count; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, materialize

#: The bound of the training sample.
TRAIN_ROWS = 40_000
THRESHOLD = 0.3
BINS, ROUNDS, RATE, PAIRS, PAIR_BINS, LEAVES = 64, 120, 0.15, 6, 12, 4
FEATURES = [
    "log_words", "mean_word", "distinct_words", "top_word", "top_bigram_repeat", "dup_lines", "log_lines", "line_words",
    "symbols", "marks", "digits", "upper", "non_ascii", "compression", "long_words", "short_words", "doubled", "ends",
]
_SYMBOLS, _MARKS, _DIGITS = b"#*$%&|<>{}[]\\^~_=+@/", b"!?.,;:", b"0123456789"
_UPPER = bytes(range(65, 91))
_ASCII = bytes(range(128))


def features(raw: bytes) -> list[float]:
    n = max(len(raw), 1)
    words = raw.split()
    w = max(len(words), 1)
    count = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    return [
        np.log1p(len(words)), float(lengths.mean()), len(count) / w, max(count.values(), default=0) / w,
        1 - pairs / max(w - 1, 1), 1 - len(set(lines)) / max(len(lines), 1), np.log1p(len(lines)), np.log1p(w / max(len(lines), 1)),
        share(_SYMBOLS), share(_MARKS), share(_DIGITS), share(_UPPER), len(raw.translate(None, _ASCII)) / n,
        len(zlib.compress(raw, 1)) / n, float((lengths > 15).mean()), float((lengths <= 2).mean()),
        sum(map(bytes.__eq__, words, words[1:])) / w, sum(x.rstrip()[-1:] in b".!?" for x in lines) / max(len(lines), 1),
    ]


@dataclass
class Model:
    """Cut points of each feature, its table, and tables of pairs over coarser bins."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self.bins(x, self.edges), strict=True):
            z += table[b]
        coarse = self.bins(x, self.pair_edges)
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-z))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values for each bin of the best tree of `leaves` leaves, grown best split first."""
    parts, g, h = [(0, len(gradient))], np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(hessian))
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                if (m := int(gain.argmax())) >= 0 and gain[m] > best[0]:
                    best = (gain[m], (a, b), a + 1 + m)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Leaf values of a depth-two tree over two axes: one axis is cut first, each side then along the other; the axis that
    gains more comes first."""
    found = []
    for g, h in ((gradient, hessian), (gradient.T, hessian.T)):
        out, worth = np.zeros(g.shape), 0.0
        first = _tree(g.sum(1), h.sum(1), 2)
        cut = int(np.argmax(first != first[0])) or len(first)
        for side in (slice(0, cut), slice(cut, len(first))):
            if g[side].size:
                out[side] = _tree(g[side].sum(0), h[side].sum(0), 2)
                worth += float((out[side] * g[side]).sum())
        found.append((worth, out))
    return found[0][1] if found[0][0] >= found[1][0] else found[1][1].T


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    model = Model()
    if not len(y):
        return model
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.intercept = float(np.log(mean / (1 - mean)))
    model.edges = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = model.bins(x, model.edges)
    z = np.full(len(y), model.intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):  # in turn, so that related features share what they explain
            g, h = gradient()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), LEAVES)
            model.tables[j] += step
            z += step[b]
    coarse = model.bins(x, model.pair_edges)
    g, h = gradient()
    gains = []
    for i in range(len(coarse)):
        for j in range(i + 1, len(coarse)):
            ni, nj = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
            cell = coarse[i] * nj + coarse[j]
            gains.append((float((np.bincount(cell, g, ni * nj) ** 2 / (np.bincount(cell, h, ni * nj) + 5.0)).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)) for i, j in model.pairs]
    for _ in range(ROUNDS // 4):
        for k, (i, j) in enumerate(model.pairs):
            g, h = gradient()
            ni, nj = model.pair_tables[k].shape
            cell = coarse[i] * nj + coarse[j]
            gg, hh = np.bincount(cell, g, ni * nj).reshape(ni, nj), np.bincount(cell, h, ni * nj).reshape(ni, nj)
            best = _pair_tree(gg, hh)
            model.pair_tables[k] += RATE * best
            z += RATE * best[coarse[i], coarse[j]]
    return model


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` and the array `x` of features of each whole text."""
    fields = docs.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[keep].assign(x=[features(t) for t in pdf["_raw"]])

    raw = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_raw"))
    return raw.mapInPandas(run, f"{schema}, x array<double>")


def train(featured: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Fit on rows out of the held-out fold. `labels` (doc_id, quality) may repeat an id: its labels' mean counts."""
    one = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))
    known = featured.where(fold() != 0).join(one, "doc_id").select("x", "y", F.xxhash64("doc_id", F.lit("train")).alias("o"))
    every = -(-known.count() // most) or 1  # a share of the hash's range, so that no task sends more than its part
    rows = known.where(F.pmod("o", F.lit(every)) == 0).orderBy("o").limit(most).toPandas()
    if not len(rows):
        return Model()
    return fit(np.array(rows["x"].tolist(), float).reshape(len(rows), -1), (rows["y"].to_numpy(float) > 0.5).astype(float))


def score(featured: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in featured.select(*keep).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = model.score(np.array(pdf["x"].tolist(), float).reshape(len(pdf), -1)) if len(pdf) else np.zeros(0)
            yield pdf[keep].assign(score=s)

    return featured.mapInPandas(run, f"{schema}, score double")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    featured = materialize(with_features(docs.withColumn("held_out", fold() == 0), ["doc_id", "held_out"]), "quality-features")
    scored = score(featured, train(featured, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
