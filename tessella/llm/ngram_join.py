"""N-gram Jaccard join by signature trees.

A document is the set of its distinct word n-grams, hashed to 64 bits; equal sets become one node. Documents that can
link first meet by keys, without loss: two sets with Jaccard similarity of at least J differ in at most D members, so of
the D + 1 + s parts into which a hash deals the members at least one is equal and not empty in both, unless both leave
more than s parts empty; such sets are dealt out by further hashes, at last by one key for all of them. D depends on a
band of set sizes; a set near its band's lower end has keys of the band below as well.

Sets that share a key are tested against the least one of them, its hub: first by bitmaps and sizes, which leave few pairs,
then by whole sets. Keys whose other sets do not all belong together by then are joined by signature trees: leaves are the
bitmaps of the sets by rising size; a node holds the OR of its children, their range of sizes and their least number of
bits. Two trees are descended together, and a pair of nodes is dropped when the most overlap that its bitmaps and sizes
allow is too little. The sets that are left are joined by trees again, now with an exact count of each pair left, best
first, unless other links already join the two sets. More than BLOCK sets of a key are dealt out as pairs of blocks, a
hub's sets as slices.

Defined cases: texts without words (null, blank) have no n-gram and link with nothing; with fewer words than n the whole
sequence is the one n-gram; rows that repeat an id count each, and their groups report the least id; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, discard, discard_since, mark, materialize, release
from .components import components
from .suffix_dedup import mixed, powers

SPARE, DEALS, RATIO, FAN, BLOCK = 2, 8, 1.5, 8, 2000
#: Bitmaps have 8 to 16 bits a member, but no more than this; trees fold theirs to the narrowest.
WIDEST = 1 << 20
#: Bytes of a key on its way; keys that agree by chance give candidates, which are tested like any other.
KEY_BYTES = 5
_SET, _PART, _KEY, _TWO = (np.uint64(x) for x in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165))


def shingles(raw: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text, A-Z lower-cased."""
    words = (raw or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    table, up, down = powers(len(joined) + 1)
    prefix = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(table[joined] * up[: len(joined)], out=prefix[1:])
    stop = np.flatnonzero(joined == 32)
    start = np.concatenate(([0], stop[:-1] + 1))
    k = min(k, len(words))
    start, stop = start[: len(words) - k + 1], stop[k - 1 :]
    return np.unique(mixed((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64)))


def band_of(n: int) -> int:
    b = int(np.log(n) / np.log(RATIO))
    while RATIO ** (b + 1) <= n:
        b += 1
    while b and RATIO**b > n:
        b -= 1
    return b


def band_top(b: int) -> int:
    """The largest size of a band."""
    return int(np.ceil(RATIO ** (b + 1))) - 1


def differences(b: int, num: int, den: int) -> int:
    """Most members in which two linked sets differ, the smaller one of band b."""
    top = band_top(b)
    return (top + top * den // num) * (den - num) // (den + num)


@cache
def parts_of(b: int, num: int, den: int) -> tuple[int, int] | None:
    """(parts, spare) of a band: spare is how many parts a set of its least size may leave empty, as good as always.

    None where linked sets are equal.
    """
    most = differences(b, num, den)
    if not most:
        return None
    spare, n = SPARE, -(-(RATIO**b) // 1)
    while True:
        parts = most + 1 + spare
        empty = parts * np.exp(-n / parts)
        if spare >= empty + 3 * np.sqrt(empty) or spare > most // 3 + SPARE:
            return parts, spare
        spare += 1


def part_keys(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes of a set's parts. A set with more empty parts than its band spares is dealt out by another hash as well:
    two such sets may share empty parts only, while one of any other kind shares a part that holds something."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    b, out = band_of(n), []
    for band in (b, b - 1):
        if band < 0 or (band < b and -(-n * num // den) > band_top(band)) or not (found := parts_of(band, num, den)):
            continue
        parts, spare = found
        for deal in range(DEALS):
            part = (mixed(tokens ^ (_PART + np.uint64(deal))) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            own, at = np.unique(part[order], return_index=True)
            sums = np.add.reduceat(mixed(tokens ^ _KEY)[order], at)
            out.append(mixed(sums + ((own * DEALS + deal) * 64 + band + 1).astype(np.uint64) * _TWO))
            if parts - len(own) <= spare:
                break
        else:
            out.append(mixed(np.array([(parts * 64 + band + 1) * 3], np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def with_text_keys(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw"))
    return rows.withColumn("k1", F.xxhash64("raw")).withColumn("k2", F.xxhash64(F.lit(2), "raw"))


def bitmap(tokens: np.ndarray) -> bytes:
    width = min(max(64, 1 << (8 * len(tokens) - 1).bit_length()), WIDEST)
    marks = np.zeros(width, bool)
    marks[(tokens % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all as wide as the narrowest: a wider one's halves are put over each other."""
    words = min(map(len, maps)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, words), axis=0) for m in maps])


def sketch(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, k1, k2, n, node (hash of the whole set), keys (KEY_BYTES each), bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, node, keys, bits = [], [], [], []
            for raw in pdf["raw"]:
                tokens = shingles(raw, k)
                n.append(len(tokens))
                whole = mixed(tokens ^ _SET).sum(keepdims=True) + np.array([len(tokens)], np.uint64) * _TWO
                node.append(int(mixed(whole).view(np.int64)[0]))
                keys.append(part_keys(tokens, num, den).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes())
                bits.append(bitmap(tokens) if len(tokens) else b"")
            yield pdf[["doc_id", "k1", "k2"]].astype({"doc_id": "Int64"}).assign(n=n, node=node, keys=keys, bits=bits)

    return rows.mapInPandas(run, "doc_id long, k1 long, k2 long, n long, node long, keys binary, bits binary")


def key_groups(sketched: DataFrame, parts: int) -> DataFrame:
    """(hub, node, group): the nodes that share a key with a lesser node, the least one of all being the hub.

    Keys with the same nodes make one group (in a part). A shuffled row holds a task's keys of one part.
    """

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.drop_duplicates("node")
            five = np.frombuffer(b"".join(pdf["keys"]), np.uint8).reshape(-1, KEY_BYTES)
            key = np.pad(five, ((0, 0), (0, 8 - KEY_BYTES))).view("<u8").ravel()
            at = np.repeat(np.arange(len(pdf)), pdf["keys"].map(len).to_numpy(np.int64) // KEY_BYTES)
            node, part, short = pdf["node"].to_numpy(np.int64), key % np.uint64(parts), (key // np.uint64(parts)).astype("<u4")
            order = np.lexsort((at, part))
            at, part, short, rows = at[order], part[order], short[order], []
            cut = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
            for p in range(parts):
                if cut[p] < cut[p + 1]:
                    s = slice(cut[p], cut[p + 1])
                    own, count = np.unique(at[s], return_counts=True)
                    rows.append((p, short[s].tobytes(), node[own].tobytes(), count.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["part", "keys", "nodes", "counts"])

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(np.frombuffer(k, "<u4"), np.repeat(np.frombuffer(n, np.int64), np.frombuffer(c, "<u4"))) for pdf in batches for k, n, c in zip(pdf["keys"], pdf["nodes"], pdf["counts"], strict=True)]
        if not held:
            return
        keys, node = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((node, keys))
        keys, node = keys[order], node[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])))
        keys, node = keys[new], node[new]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(first, len(keys)))
        group = mixed(np.add.reduceat(mixed(node.view(np.uint64) ^ _SET), first) + size.astype(np.uint64) * _TWO).view(np.int64)
        several = np.flatnonzero(size > 1)
        several = several[np.unique(group[several], return_index=True)[1]]
        for k in range(0, len(several), 10_000):
            own = several[k : k + 10_000]
            n = size[own] - 1  # without the hub
            at = np.repeat(first[own] + 1 - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield pd.DataFrame({"hub": np.repeat(node[first[own]], n), "node": node[at], "group": np.repeat(group[own], n)})

    dealt = sketched.where("n > 0").select("node", "keys").mapInPandas(deal, "part int, keys binary, nodes binary, counts binary").repartition(parts, "part")
    return dealt.mapInPandas(meet, "hub long, node long, group long")


class Tree:
    """Levels of a signature tree, leaves first: OR bitmaps, least and most members, least number of bits."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        self.levels = [(bits, n, n, np.bitwise_count(bits).sum(axis=1, dtype=np.int64))]
        while len(self.levels[-1][1]) > FAN:
            bits, low, high, least = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(least, at)))


def possible(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which node pairs can hold a link, and the most overlap that they allow."""
    keep, most = np.empty(len(i), bool), np.empty(len(i), np.int64)
    for k in range(0, len(i), 4096):
        s = slice(k, k + 4096)
        a, b = i[s], j[s]
        shared = np.bitwise_count(x[0][a] & y[0][b]).sum(axis=1, dtype=np.int64)
        # a member's bits beyond the shared ones each stand for a shingle that the other side lacks
        top = np.minimum(x[2][a] - np.maximum(x[3][a] - shared, 0), y[2][b] - np.maximum(y[3][b] - shared, 0))
        least = np.minimum(x[1][a], y[1][b])
        keep[s] = ((den + num) * top >= num * (x[1][a] + y[1][b])) & (den * x[2][a] >= num * y[1][b]) & (den * y[2][b] >= num * x[1][a]) & (least > 0)
        most[s] = top
    return keep, most


def descend(x: Tree, y: Tree, same: bool, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaf pairs that both trees leave, with their bounds; each pair once where both are the same tree."""
    top = max(len(x.levels), len(y.levels)) - 1
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    i, j = (a.ravel() for a in np.meshgrid(np.arange(len(level(x, top)[1])), np.arange(len(level(y, top)[1])), indexing="ij"))
    while True:
        if same:
            i, j = (i[i <= j], j[i <= j]) if top else (i[i < j], j[i < j])
        keep, most = possible(level(x, top), level(y, top), i, j, num, den)
        i, j, most = i[keep], j[keep], most[keep]
        if not top:
            return i, j, most
        top -= 1
        for tree, which in ((x, 0), (y, 1)):
            if top < len(tree.levels) - 1:  # this tree has a level below
                own, n = (i, j)[which], len(tree.levels[top][1])
                child = (own[:, None] * FAN + np.arange(FAN)).ravel()
                i, j = (np.repeat(i, FAN), np.repeat(j, FAN))
                i, j = (child, j) if which == 0 else (i, child)
                i, j = i[child < n], j[child < n]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def possible_pairs(bits: np.ndarray, n: np.ndarray, side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (among all sets, or between the two sides) that signature trees leave, with their most overlap."""
    p = np.flatnonzero(side == 0)
    q = np.flatnonzero(side == 1) if side.any() else p
    if not len(p) or not len(q):
        return (np.zeros(0, np.int64),) * 3
    order = lambda part: part[np.lexsort((bits[part, 0], n[part]))]
    p, q = order(p), order(q)
    x = Tree(bits[p], n[p])
    i, j, most = descend(x, Tree(bits[q], n[q]) if side.any() else x, not side.any(), num, den)
    return p[i], q[j], most


def linked(sets: list[np.ndarray], side: np.ndarray, num: int, den: int, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join sets of unlike labels, a spanning forest of them, among all sets or between the two sides."""
    label = np.arange(len(sets)) if label is None else label.copy()
    n, out = np.array([len(s) for s in sets], np.int64), []
    i, j, most = possible_pairs(folded([bitmap(s) for s in sets]), n, side, num, den)
    best = np.argsort(-(most / (n[i] + n[j] - most)), kind="stable")
    for k in range(0, len(best), 2048):
        part = best[k : k + 2048]
        for t in part[label[i[part]] != label[j[part]]]:
            a, b = int(i[t]), int(j[t])
            if label[a] != label[b]:
                o = overlap(sets[a], sets[b])
                if den * o >= num * (n[a] + n[b] - o):
                    label[label == label[b]] = label[a]
                    out.append((a, b))
    return out


def near_pairs(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(hub, node) pairs whose bitmaps and sizes allow a link, from rows with both."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for n1, bits1, n2, bits2 in zip(pdf["n1"], pdf["bits1"], pdf["n2"], pdf["bits2"], strict=True):
                x = folded([bits1, bits2])
                shared, own = int(np.bitwise_count(x[0] & x[1]).sum()), np.bitwise_count(x).sum(axis=1)
                # bits beyond the shared ones each stand for a member that the other set lacks
                most = min(n1 - max(int(own[0]) - shared, 0), n2 - max(int(own[1]) - shared, 0))
                keep.append((den + num) * most >= num * (n1 + n2))
            yield pdf.loc[np.array(keep, bool), ["hub", "node"]]

    return pairs.mapInPandas(run, "hub long, node long")


def member_sets(texts: DataFrame, places: DataFrame, profiles: DataFrame, k: int) -> DataFrame:
    """(node, tokens) of the nodes of `places`, made again from one text each. Texts are dealt out to the nodes at any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in range(0, len(pdf), 1000):
                part = pdf.iloc[s : s + 1000]
                yield part[["node"]].assign(tokens=[shingles(raw, k).tobytes() for raw in part["raw"]])

    wanted = materialize(places.select("node").distinct().join(profiles.select("node", "rep.*"), "node"), "wanted-texts")
    wanted = wanted.hint("merge").alias("w")
    on = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.k1") == F.col("w.k1")) & (F.col("t.k2") == F.col("w.k2"))
    rows = texts.alias("t").join(wanted, on).select("node", "raw")
    sets = rows.mapInPandas(run, "node long, tokens binary")
    return sets.groupBy("node").agg(F.first("tokens").alias("tokens"))  # rows that repeat id and text give a set each


def in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Adds `own`, the block of a set in its group: by size, about `block` sets each.

    Places in the order of sizes come from the counts of each size, and within a size from a hash, so no task orders a group.
    """
    sizes = members.groupBy("group", "n").agg(F.count("*").alias("same"))
    upto = Window.partitionBy("group").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("below", F.coalesce(F.sum("same").over(upto), F.lit(0))).withColumn("size", F.sum("same").over(Window.partitionBy("group")))
    rows = members.join(materialize(sizes, "group-sizes"), ["group", "n"])
    place = F.col("below") + F.col("same") * F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / float(1 << 20)
    return rows.withColumn("own", F.floor(place / F.col("size") * F.ceil(F.col("size") / block)).cast("int")).drop("same", "below", "size")


def block_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """(group, own, side, bucket): the pairs of blocks of a group in which each block takes part, by size ranges."""
    blocks = members.groupBy("group", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    fits = (F.col("a.own") <= F.col("b.own")) & (F.col("a.high") * den >= F.col("b.low") * num)
    pairs = a.join(b, (F.col("a.group") == F.col("b.group")) & fits).select("a.group", F.col("a.own").alias("x"), F.col("b.own").alias("y"))
    pairs = pairs.withColumn("bucket", F.xxhash64("group", "x", "y"))
    first = pairs.select("group", F.col("x").alias("own"), F.lit(0).alias("side"), "bucket")
    return first.unionByName(pairs.where("x <> y").select("group", F.col("y").alias("own"), F.lit(1).alias("side"), "bucket"))


def tree_places(members: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(bucket, side, group, node, root): the pairs of blocks in which each member (group, node, n, root) meets the others."""
    members = materialize(in_blocks(members, block), "group-members")
    pairs = materialize(block_pairs(members, num, den), "block-pairs")
    return materialize(members.join(pairs, ["group", "own"]).select("bucket", "side", "group", "node", "root"), "tree-places")


def by_bucket(rows: DataFrame, parts: int, handle, schema: str) -> DataFrame:
    """Rows of each bucket in turn, sorted by side, given to `handle`, which returns a pandas frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for pdf in batches:
            pdf = pd.concat([left, pdf], ignore_index=True) if left is not None else pdf
            key = pdf["bucket"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1]) + 1
            found = [handle(pdf.iloc[a:b]) for a, b in zip(np.append(0, cut), cut, strict=False)]
            left = pdf.iloc[cut[-1] if len(cut) else 0 :]
            if found:
                yield pd.concat(found, ignore_index=True)
        if left is not None and len(left):
            yield handle(left)

    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "side", "node").mapInPandas(run, schema)


def verified_groups(sketched: DataFrame, texts: DataFrame, k: int, num: int, den: int, block: int) -> DataFrame:
    """(node, component) of all nodes that have a link."""
    parts = max(int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def spokes(g: pd.DataFrame) -> pd.DataFrame:
        """Links of a hub's slice; side 0 is the hub."""
        hub, tokens = g["node"].iloc[0], np.frombuffer(g["tokens"].iloc[0], np.uint64)
        out = []
        for node, raw in zip(g["node"].iloc[1:], g["tokens"].iloc[1:], strict=True):
            o = overlap(tokens, other := np.frombuffer(raw, np.uint64))
            if den * o >= num * (len(tokens) + len(other) - o):
                out.append((node, hub))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    def left_by_trees(g: pd.DataFrame) -> pd.DataFrame:
        i, j, _ = possible_pairs(folded(list(g["bits"])), g["n"].to_numpy(np.int64), g["side"].to_numpy(), num, den)
        root, some = g["root"].to_numpy(), np.zeros(len(g), bool)
        apart = root[i] != root[j]
        some[i[apart]] = some[j[apart]] = True
        return g.loc[some, ["group", "node", "n", "root"]]

    def exact(g: pd.DataFrame) -> pd.DataFrame:
        node, label = g["node"].to_numpy(), np.unique(g["root"].to_numpy(), return_inverse=True)[1]
        found = linked([np.frombuffer(t, np.uint64) for t in g["tokens"]], g["side"].to_numpy(), num, den, label)
        return pd.DataFrame([(node[i], node[j]) for i, j in found], columns=["a", "b"], dtype=np.int64)

    spark = sketched.sparkSession
    groups = materialize(key_groups(sketched, parts), "key-groups")
    release(spark)
    edges = materialize(groups.select("hub", "node").distinct(), "hub-pairs")
    candidates = edges.select("node").unionByName(edges.select(F.col("hub").alias("node"))).distinct()
    profiles = sketched.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct("doc_id", "k1", "k2")).alias("rep"), F.first("bits").alias("bits"))
    profiles = materialize(profiles.join(candidates, "node", "left_semi"), "profiles")
    release(spark)
    side = lambda name, k: profiles.select(F.col("node").alias(name), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    near = materialize(near_pairs(edges.join(side("node", 1), "node").join(side("hub", 2), "hub"), num, den), "near-pairs")
    slices = near.groupBy("hub").agg(F.ceil(F.count("*") / block).alias("slices"))
    leaves = near.join(materialize(slices, "hub-slices"), "hub").select("hub", "node", F.xxhash64("hub", F.pmod(F.xxhash64("node"), "slices")).alias("bucket"))
    leaves = materialize(leaves, "hub-leaves")
    hubs = leaves.select(F.col("hub").alias("node"), "bucket").distinct()
    places = hubs.select("bucket", F.lit(0).alias("side"), "node").unionByName(leaves.select("bucket", F.lit(1).alias("side"), "node"))
    links = materialize(by_bucket(places.join(member_sets(texts, places, profiles, k), "node"), parts, spokes, "a long, b long"), "hub-links")
    discard(edges, near, leaves)
    release(spark)
    # groups whose nodes, the hub aside, do not all belong together yet
    roots = materialize(components(links), "hub-components")
    rest = groups.select("group", "node").join(roots, "node", "left").select("group", "node", F.coalesce("component", "node").alias("root")).distinct()
    rest = materialize(rest, "key-groups")
    apart = materialize(rest.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("group"), "groups-apart")
    if not apart.limit(1).count():
        return roots
    members = rest.join(apart, "group").join(profiles.select("node", "n"), "node")
    places = tree_places(members, num, den, block)
    discard(groups, rest, apart)
    left = by_bucket(places.join(profiles.select("node", "n", "bits"), "node"), parts, left_by_trees, "group long, node long, n long, root long")
    left = materialize(left.distinct(), "left-by-trees")
    if not left.limit(1).count():
        return roots
    places = tree_places(left, num, den, block)
    more = by_bucket(places.join(member_sets(texts, places, profiles, k), "node"), parts, exact, "a long, b long")
    return components(links.unionByName(more))


def jaccard_groups(docs: DataFrame, k: int, num: int, den: int = 100, block: int = BLOCK) -> DataFrame:
    """doc_id, k1, k2 (of the text), n_shingles, component_id, group for each row of docs (doc_id, text).

    `group` is a node of the component, the same for all of its rows whatever their ids; null for texts without words.
    """
    point, texts = mark(), with_text_keys(docs)
    sketched = materialize(sketch(texts, k, num, den), "shingle-sketches")
    groups = materialize(verified_groups(sketched, texts, k, num, den, block), "shingle-groups")
    # the least id of each group, by way of its nodes; only groups of several rows are joined back
    meta = sketched.select("doc_id", "k1", "k2", "n", "node")
    known = meta.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).join(groups, "node", "left")
    known = materialize(known.withColumn("component", F.coalesce("component", "node")), "known-nodes")
    roots = materialize(known.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("all")).where(F.col("all") > 1), "group-roots")
    several = known.join(roots, "component").select("node", F.col("component").alias("group"), F.col("component_id").alias("group_id"))
    several = materialize(several, "grouped-nodes")
    discard_since(point, sketched, several)
    out = meta.join(several, "node", "left")
    own = F.when(F.col("n") > 0, F.coalesce("group_id", "doc_id")).otherwise(F.col("doc_id"))
    group = F.when(F.col("n") > 0, F.coalesce("group", "node"))
    return out.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), own.alias("component_id"), group.alias("group"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group: the row of the least id, then of the least text key; a null id comes last.

    Groups go by their nodes, so null and repeated ids are no reason to drop a row. Texts without words all stay.
    Columns as they were.
    """
    point = mark()
    groups = jaccard_groups(docs.select("doc_id", "text"), k, num, den).where("n_shingles > 0")
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("_k"))
    place = lambda doc, k1, k2: [F.xxhash64(F.lit(k), doc, doc.isNull(), k1, k2).alias(f"_h{k}") for k in (1, 2)]
    first = materialize(first.select(*place(F.col("_k.doc_id"), F.col("_k.k1"), F.col("_k.k2"))), "kept-documents")
    discard_since(point, first)
    release(docs.sparkSession)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    textless = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACES)) == ""
    own = place(F.col("doc_id").cast("long"), F.xxhash64(raw), F.xxhash64(F.lit(2), raw))
    # both keys are hashes and never null, so texts are dealt out once, for the join and for rows that repeat id and text
    kept = docs.where(~textless).select(F.struct("*").alias("_row"), *own).join(first.hint("merge"), ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"])
    return kept.select("_row.*").unionByName(docs.where(textless))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_groups(docs, 4, 85).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 3], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.root FROM reach JOIN links ON reach.doc_id = links.a),
r AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT r.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id
"""
