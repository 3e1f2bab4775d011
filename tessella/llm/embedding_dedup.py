"""Near duplicates of embeddings: sign hashing by random hyperplanes in several tables, then exact cosines.

Vectors of one label and dimension meet in a table's bucket if their signs on its hyperplanes agree. Equal vectors are
first made one. A bucket's cosines are taken in double precision, blockwise, and no pair leaves the task: each vector
gets a count of links, where a pair counts in the first table in which it meets, and a bucket's links leave as a
spanning forest. Buckets of more than BLOCK vectors are dealt out as pairs of blocks.

The number of signs follows the counted rows of the largest label, so that a bucket of unlike vectors stays small at any
size, and the number of tables follows the signs: a pair at the limit meets in a table with probability p ** signs, p = 1 -
angle / pi, and misses all tables with probability MISSED at most.

Defined cases: null, zero, null-holding and non-finite vectors, and those of a null label, link with nothing; vectors of
unlike dimension are never compared; rows that repeat an id are counted each, every row by its own vector's links; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, discard_since, mark, materialize
from .components import components

LIMIT, BLOCK, SEED = 0.93, 1024, 7
#: Vectors of one label that a bucket should hold; chance that a pair at the limit is missed; signs at least and at most.
BUCKET, MISSED, LEAST_BITS, MOST_BITS = 256, 1e-5, 4, 24


def shape_of(rows: int, limit: float = LIMIT) -> tuple[int, int]:
    """(signs, tables) for a label of so many vectors."""
    bits = min(max((-(-rows // BUCKET)).bit_length(), LEAST_BITS), MOST_BITS)
    meets = (1 - np.arccos(limit) / np.pi) ** bits
    return bits, int(np.ceil(np.log(MISSED) / np.log1p(-meets)))


def valid(label: str = "label", vector: str = "embedding"):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(label).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def signatures(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(node, label, size, copies, unit, signs): the unit vector (doubles) and each table's sign bits as one number (32 bit)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(bits)
        for pdf in batches:
            unit, signs = np.empty(len(pdf), object), np.empty(len(pdf), object)
            sizes = pdf["embedding"].map(len).to_numpy()
            for size in np.unique(sizes):
                planes = np.random.default_rng(seed + int(size)).standard_normal((int(size), tables * bits))
                at = np.flatnonzero(sizes == size)
                x = np.array(pdf["embedding"].iloc[at].tolist(), np.float64)
                found = ((x @ planes) >= 0).reshape(len(at), tables, bits) @ weights
                x /= np.sqrt((x * x).sum(axis=1))[:, None]
                for k, row, own in zip(at, found.astype(np.int32), x, strict=True):
                    unit[k], signs[k] = own.tobytes(), row.tobytes()
            yield pdf[["node", "label", "copies"]].assign(size=sizes, unit=unit, signs=signs)

    return vectors.mapInPandas(run, "node long, label long, copies long, size int, unit binary, signs binary")


def in_tables(signed: DataFrame) -> DataFrame:
    """(node, label, size, tbl, sign): a row for each table of each vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 2000):
                part = pdf.iloc[k : k + 2000]
                signs = np.stack([np.frombuffer(x, np.int32) for x in part["signs"]])
                n = signs.shape[1]
                rows = part[["node", "label", "size"]].loc[part.index.repeat(n)]
                yield rows.assign(tbl=np.tile(np.arange(n), len(part)), sign=signs.ravel())

    return signed.select("node", "label", "size", "signs").mapInPandas(run, "node long, label long, size int, tbl int, sign int")


def _links(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, table: int, same: bool, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows (i, j) that did not meet in an earlier table; i < j where both sides are the same block."""
    i, j = np.nonzero(x @ y.T >= limit)
    if same:
        i, j = i[i < j], j[i < j]
    if len(i) and table:
        new = np.empty(len(i), bool)
        for k in range(0, len(i), 100_000):
            s = slice(k, k + 100_000)
            new[s] = ~(sx[i[s], :table] == sy[j[s], :table]).any(axis=1)
        i, j = i[new], j[new]
    return i, j


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 and edges a, b: the least node of each one's component."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def meet(rows: DataFrame, limit: float) -> DataFrame:
    """(node, other, links): a bucket's forest as (node, its root) and counts of new links, from rows sorted by bucket."""

    def bucket(g: pd.DataFrame) -> pd.DataFrame | None:
        x = np.stack([np.frombuffer(u, np.float64) for u in g["unit"]])
        signs, table = np.stack([np.frombuffer(u, np.int32) for u in g["signs"]]), int(g["tbl"].iloc[0])
        side, one = g["side"].to_numpy(), len(g)
        if side.any():
            p, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            i, j = _links(x[p], x[q], signs[p], signs[q], table, False, limit)
            i, j = p[i], q[j]
        else:
            i, j = _links(x, x, signs, signs, table, True, limit)
        if not len(i):
            return None
        copies, node = g["copies"].to_numpy(), g["node"].to_numpy()
        links = np.bincount(i, copies[j], one) + np.bincount(j, copies[i], one)
        root, own = forest(i, j, one), links > 0
        return pd.DataFrame({"node": node[own], "other": node[root[own]], "links": links[own].astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for pdf in batches:
            pdf = pd.concat([left, pdf], ignore_index=True) if left is not None else pdf
            key = pdf["bucket"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            for a, b in zip(np.append(0, cut), cut, strict=False):
                if b - a > 1 and (out := bucket(pdf.iloc[a:b])) is not None:
                    yield out
            left = pdf.iloc[cut[-1] if len(cut) else 0 :]
        if left is not None and len(left) > 1 and (out := bucket(left)) is not None:
            yield out

    return rows.mapInPandas(run, "node long, other long, links long")


def near_duplicates(vectors: DataFrame, limit: float = LIMIT, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label). Equal vectors of a label are
    one node, named by a hash of both; ids come in at the end."""
    # labels of any type: whole numbers as they are, others by a hash
    whole = dict(vectors.dtypes)["label"] in ("tinyint", "smallint", "int", "bigint")
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64("label"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    # -0.0 and 0.0 are equal
    node = F.xxhash64("label", F.size("embedding"), F.transform("embedding", lambda x: x + F.lit(0.0)))
    point = mark()
    rows = materialize(rows.withColumn("node", F.when(valid(), node)), "vectors")
    same = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    same = materialize(same, "distinct-vectors")
    largest = same.groupBy("label").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first().n
    bits, tables = shape_of(largest, limit)
    signed = materialize(signatures(same.select("node", "label", "embedding", "copies"), bits, tables, seed), "signed-vectors")
    met = materialize(in_tables(signed), "vector-buckets")
    sizes = met.groupBy("label", "size", "tbl", "sign").agg(F.count("*").alias("n")).where("n > 1")
    full = met.join(materialize(sizes, "bucket-sizes"), ["label", "size", "tbl", "sign"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    full = full.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = full.withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.withColumn("side", (F.col("own") > F.col("peer")).cast("int"))
    full = full.withColumn("bucket", F.xxhash64("label", "size", "tbl", "sign", F.least("own", "peer"), F.greatest("own", "peer")))
    places = materialize(full.select("bucket", "tbl", "side", "node"), "bucket-places")
    # two blocks: side 0 has the lesser, side 1 the greater; a block with itself: side 0 alone
    dealt = places.join(signed.select("node", "copies", "unit", "signs"), "node").repartition("bucket").sortWithinPartitions("bucket", "node")
    found = materialize(meet(dealt, limit), "bucket-links")
    discard(met, places)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = same.select("node", "least", "copies").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("component", "node"))
    known = materialize(known.select("node", "least", "copies", "links", "root"), "linked-vectors")
    least = materialize(known.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    known = materialize(known.join(least, "root").select("node", "copies", "links", "component_id"), "vector-groups")
    discard_since(point, rows, known)
    out = rows.select("vec_id", "node").join(known, "node", "left")
    linked = F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))
    out = out.select("vec_id", linked.cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93
), reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.root FROM reach JOIN links ON reach.vec_id = links.a
), r AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN r ON r.vec_id = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
"""
