"""Language-model scores by a Brown class bigram model.

Every training word is clustered by exchange: it moves to the class that raises the class-bigram likelihood most, from
counts of its neighbours' classes. Words move in batches, half of the chunks at a time; after each batch the class pairs
are counted anew over the whole corpus, and a batch that does not raise the likelihood is halved, at last taken back. Words
that training lacks get a class of their last characters, whose neighbours are learned from the words that training has once:
each counts in its own class and, as the unknown word that it nearly was, in the class of its ending.
P(text) is the product over its tokens of P(class | class before) * P(word | class), each smoothed, the end included.

All counts are over every training text. Words go by 64-bit hashes, dealt into parts, then by their places in these; the
driver holds a byte a distinct word (its class) and counts of class pairs. LOOKED_UP words are looked up in memory while
scoring; rarer words meet their counts and classes by a join.

Defined cases: null text is the end token alone; rows that repeat an id are scored each; an empty table gives an empty
result, and with no training text all counts are 0 and every token is unknown.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fold, materialize, shuffles_dropped
from .suffix_dedup import mixed

CLASSES, TAIL_CLASSES, LOOKED_UP, ROUNDS = 64, 64, 100_000, 6
#: Class symbols: learned classes, tail classes, start, end.
START, STOP, SYMBOLS = CLASSES + TAIL_CLASSES, CLASSES + TAIL_CLASSES + 1, CLASSES + TAIL_CLASSES + 2
#: Weight of the class bigram against the class's own share; floor of unseen events.
BIGRAM_WEIGHT, FLOOR = 0.95, 0.5
#: Words whose neighbours are held together; place of a rare word in a text.
CHUNK, RARE = 1024, 255
#: Tokens of which a task holds the pairs at once; how often a batch of moves is halved.
HELD, HALVED = 1_000_000, 2
#: Texts, and rows of neighbours (some MB each), that a worker is sent at once.
TEXTS, BLOCKS = 1000, 16
#: Bytes of text that are hashed at once; words of more bytes are digested one by one.
AT_ONCE, LONG = 1 << 20, 64
#: Bytes of training text for each part that words are dealt into.
PART_BYTES = 4_000_000
#: Hashes of start and end; the last bits of a word's hash are the class of its ending.
_START, _STOP, _TAILS = np.uint64(1), np.uint64(2), np.uint64(TAIL_CLASSES)


_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\f\r", np.uint8))
#: The bytes of an 8-byte block that belong to a word of which so many bytes are left.
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hashed_texts(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words and the tail class of each, by its last three bytes; a hash's last bits are that class.
    Then the number of words of each text.

    bytes.lower folds A-Z alone. Words are taken in by blocks of 8 bytes.
    """
    text = b" ".join(raws).lower() + b" "
    held = text + bytes(8)
    joined, block = np.frombuffer(text, np.uint8), np.ndarray(len(text), "<u8", held, strides=(1,))
    space = _SPACE[joined]
    edge = np.flatnonzero(space != np.concatenate(([True], space[:-1])))
    start, stop = edge[::2], edge[1::2]
    n = np.diff(np.searchsorted(start, np.cumsum([0, *(len(x) + 1 for x in raws)])))
    size = stop - start
    hashes = mixed((block[start] & _KEPT[np.minimum(size, 8)]) + mixed(size.astype(np.uint64)))
    more, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(more):
        hashes[more] = mixed(hashes[more] ^ (block[start[more] + done] & _KEPT[np.minimum(size[more] - done, 8)]))
        done += 8
        more = more[size[more] > done]
    for k in np.flatnonzero(size > LONG):
        hashes[k] = int.from_bytes(hashlib.blake2b(text[start[k] : stop[k]], digest_size=8).digest(), "little")
    tail = np.zeros(len(stop), np.uint64)
    for k in (1, 2, 3):
        tail = tail * np.uint64(256) + np.where(size >= k, joined[np.maximum(stop - k, 0)], 0)
    kind = mixed(tail) % _TAILS
    return hashes // _TAILS * _TAILS + kind, kind.astype(np.uint8), n


def hashed(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and tail classes of one text's words."""
    return hashed_texts([raw or b""])[:2]


def groups_of(raws: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Texts that follow each other, of AT_ONCE bytes together or one more text."""
    group, size = [], 0
    for raw in raws:
        group.append(raw)
        size += len(raw)
        if size >= AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def framed(inner: np.ndarray, n: np.ndarray, start, stop) -> np.ndarray:
    """The texts' values, n of each, each text's between a start and a stop."""
    last = np.cumsum(n + 2) - 1
    out, inside = np.empty(len(inner) + 2 * len(n), inner.dtype), np.ones(len(inner) + 2 * len(n), bool)
    out[last - n - 1], out[last] = start, stop
    inside[last - n - 1] = inside[last] = False
    out[inside] = inner
    return out


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return hashes // _TAILS % np.uint64(parts)


def raw_text(df: DataFrame) -> DataFrame:
    return df.withColumn("raw", F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def words_and_pairs(train: DataFrame, parts: int) -> DataFrame:
    """(part, dst, own, other, n): neighbours (a, b) dealt by a, then b. `own` is a's place among the part's words, `other`
    the hash of b; of each part, a row without dst holds its words' hashes, and as `n` their counts."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(held: list[np.ndarray]) -> pd.DataFrame:
            word, at = np.unique(np.concatenate(held), return_inverse=True)
            pair = at[:-1] * len(word) + at[1:]
            pair = pair[at[:-1] != np.searchsorted(word, _STOP)]
            pair, n = np.unique(pair, return_counts=True)
            a, b = word[pair // len(word)], word[pair % len(word)]
            part = part_of(a, parts)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            keep = [k for k in range(parts) if cut[k] < cut[k + 1]]
            slices = [order[cut[k] : cut[k + 1]] for k in keep]
            return pd.DataFrame({"part": keep, "a": [a[x].tobytes() for x in slices], "b": [b[x].tobytes() for x in slices], "n": [n[x].astype("<u4").tobytes() for x in slices]})

        held, size = [], 0
        for pdf in batches:
            for raws in groups_of(pdf["raw"]):
                words, _, n = hashed_texts(raws)
                held.append(framed(words, n, _START, _STOP))
                size += len(held[-1])
                if size > HELD:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, n = (np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in (("a", "<u8"), ("b", "<u8"), ("n", "<u4")))
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order]
        new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        a, b, n = a[new], b[new], np.add.reduceat(n.astype(np.int64), new)
        word = np.unique(a[a != _START])
        own = np.where(a == _START, -1, np.searchsorted(word, a)).astype("<i4")
        seen = np.bincount(own[own >= 0], n[own >= 0], len(word)).astype("<i8")  # each token has one follower
        part = part_of(b, parts)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
        out = [(int(pdf["part"].iloc[0]), k, own[x].tobytes(), b[x].tobytes(), n[x].astype("<i8").tobytes()) for k in range(parts) if len(x := order[cut[k] : cut[k + 1]])]
        out.append((int(pdf["part"].iloc[0]), None, None, word.tobytes(), seen.tobytes()))
        return pd.DataFrame(out, columns=["part", "dst", "own", "other", "n"]).astype({"dst": "Int32"})

    shuffled = train.select("raw").mapInPandas(partial, "part int, a binary, b binary, n binary")
    return shuffled.groupBy("part").applyInPandas(whole, "part int, dst int, own binary, other binary, n binary")


def word_sides(pairs: DataFrame, first: np.ndarray, parts: int) -> DataFrame:
    """(chunk, first, words, own0, other0, n0, own1, other1, n1): neighbours of each word, all of a word's in one row.

    0 is what stands before a word, 1 what follows. A word's id is first[part] and its place in the part; start and end
    follow all words. `own` is the word's place in the chunk, `other` the neighbour's id; `n` is given for the first of
    them, the rest are pairs seen once. A chunk of -1 holds what stands before the end.
    """
    total = int(first[-1])
    if total > (1 << 32) - 3:
        raise ValueError(f"{total} distinct words; ids have 32 bits")

    def numbered(pdf: pd.DataFrame) -> pd.DataFrame:
        """Blocks of one dst, with ids, for the parts of either word."""
        dst, out = int(pdf["dst"].iloc[0]), []
        blocks = [(int(p), np.frombuffer(o, "<i4").astype(np.int64), np.frombuffer(b, "<u8"), n) for p, o, b, n in zip(pdf["part"], pdf["own"], pdf["other"], pdf["n"], strict=True)]
        # each word has a neighbour on either side, so the words that follow are the part's words
        word = np.unique(np.concatenate([b for _, _, b, _ in blocks]))
        word = word[word != _STOP]
        for part, own, b, n in blocks:
            x = np.where(own < 0, total, own + first[part]).astype("<u4").tobytes()
            y = np.where(b == _STOP, total + 1, np.searchsorted(word, b) + first[dst]).astype("<u4").tobytes()
            out += [(dst, 0, y, x, n), (part, 1, x, y, n)]
        return pd.DataFrame(out, columns=["part", "ahead", "own", "other", "n"])

    def sorted_side(held: list[tuple], low: int) -> tuple[np.ndarray, ...]:
        own, other, n = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, "<u4"), np.zeros(0, "<u4"), np.zeros(0, "<i8"))
        held.clear()
        chunk = (own - np.uint32(low)) // np.uint32(CHUNK) * np.uint32(2) + (n == 1)
        order = np.argsort(chunk, kind="stable")
        return own[order], other[order], n[order], chunk[order]

    def chunks(pdf: pd.DataFrame) -> pd.DataFrame:
        part, word = int(pdf["part"].iloc[0]), np.zeros(0, np.uint64)
        held, end = ([], []), []
        for ahead, own, other, n in zip(pdf["ahead"], pdf["own"], pdf["other"], pdf["n"], strict=True):
            if ahead == 2:
                word = np.frombuffer(other, "<u8")
                continue
            own, other, n = np.frombuffer(own, "<u4"), np.frombuffer(other, "<u4"), np.frombuffer(n, "<i8")
            if ahead == 0 and (last := own == total + 1).any():
                end.append((own[last], other[last], n[last]))
            inside = own < total
            held[ahead].append((own[inside], other[inside], n[inside]))
        low, count = int(first[part]), -(-len(word) // CHUNK)
        sides, out = [sorted_side(held[k], low) for k in (0, 1)], []
        cuts = [np.searchsorted(side[3], np.arange(2 * count + 1, dtype=np.uint32)) for side in sides]
        for k in range(count):
            row = [part + k, low + k * CHUNK, word[k * CHUNK : (k + 1) * CHUNK].tobytes()]
            for (own, other, n, _), cut in zip(sides, cuts, strict=True):
                a, b, c = cut[2 * k : 2 * k + 3]
                row += [(own[a:c] - np.uint32(low + k * CHUNK)).astype("<u2").tobytes(), other[a:c].tobytes(), n[a:b].tobytes()]
            out.append(tuple(row))
        if end:
            own, other, n = (np.concatenate(x) for x in zip(*end, strict=True))
            out.append((-1, total + 1, b"", np.zeros(len(own), "<u2").tobytes(), other.tobytes(), n.tobytes(), b"", b"", b""))
        return pd.DataFrame(out, columns=["chunk", "first", "words", "own0", "other0", "n0", "own1", "other1", "n1"])

    both = pairs.where("dst is not null").groupBy("dst").applyInPandas(numbered, "part int, ahead int, own binary, other binary, n binary")
    names = pairs.where("dst is null").select("part", F.lit(2).alias("ahead"), "own", "other", "n")
    return both.unionByName(names).groupBy("part").applyInPandas(chunks, "chunk int, first long, words binary, own0 binary, other0 binary, n0 binary, own1 binary, other1 binary, n1 binary")


def weighted(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Counts of places: the first ones weigh `n`, the others 1."""
    return np.bincount(place[: len(n)], n, size) + np.bincount(place[len(n) :], minlength=size)


def _pair_sums(sides: DataFrame, columns: list[str], add) -> np.ndarray:
    """SYMBOLS x SYMBOLS counts that `add` puts together from rows: partial sums in arrays, then by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS * SYMBOLS)
        for pdf in batches:
            for row in zip(*(pdf[c] for c in columns), strict=True):
                for pair, n in add(*row):
                    total += weighted(pair, n, SYMBOLS * SYMBOLS)
        own = np.flatnonzero(total)
        yield pd.DataFrame({"pair": own, "n": total[own].astype(np.int64)})

    rows = sides.select(*columns).mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most SYMBOLS^2
    out = np.zeros(SYMBOLS * SYMBOLS)
    out[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out.reshape(SYMBOLS, SYMBOLS)


def class_counts(sides: DataFrame, classes) -> np.ndarray:
    """Counts of class pairs under a class (of a broadcast array) for each word."""

    def add(first: int, own: bytes, other: bytes, n: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        b = classes.value[first : first + CHUNK][np.frombuffer(own, "<u2")]
        yield classes.value[np.frombuffer(other, "<u4")].astype(np.int64) * SYMBOLS + b, np.frombuffer(n, "<i8")

    return _pair_sums(sides, ["first", "own0", "other0", "n0"], add)


def once(words: bytes, own: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Which words of a chunk are seen once, and the class of each word's ending."""
    hashes = np.frombuffer(words, "<u8")
    seen = weighted(np.frombuffer(own, "<u2"), np.frombuffer(n, "<i8"), len(hashes))
    return seen == 1, (hashes % _TAILS).astype(np.int64) + CLASSES


def tail_counts(sides: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs in which a word seen once stands for its ending's class, beside or before any other."""
    spark, inner = sides.sparkSession, sides.where("chunk >= 0")

    def endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [once(*x) for x in zip(pdf["words"], pdf["own0"], pdf["n0"], strict=True)]
            yield pd.DataFrame({"first": pdf["first"], "kind": [np.where(single, kind, RARE).astype(np.uint8).tobytes() for single, kind in found]})

    second = np.full(len(classes), RARE, np.uint8)
    for r in inner.select("first", "words", "own0", "n0").mapInPandas(endings, "first long, kind binary").collect():  # a byte a word, as the classes
        second[r.first : r.first + len(r.kind)] = np.frombuffer(r.kind, np.uint8)
    sent, also = spark.sparkContext.broadcast(classes), spark.sparkContext.broadcast(second)

    def add(words: bytes, own0: bytes, other0: bytes, n0: bytes, own1: bytes, other1: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        single, kind = once(words, own0, n0)
        for ahead, own, other in ((0, own0, other0), (1, own1, other1)):
            own, other = np.frombuffer(own, "<u2"), np.frombuffer(other, "<u4")
            at = single[own]
            mine, other, none = kind[own[at]], other[at], np.zeros(0, np.int64)  # each pair of a word seen once is seen once
            theirs = sent.value[other].astype(np.int64)
            yield (mine * SYMBOLS + theirs if ahead else theirs * SYMBOLS + mine), none
            if not ahead:
                theirs = also.value[other].astype(np.int64)
                both = theirs != RARE
                yield theirs[both] * SYMBOLS + mine[both], none

    out = _pair_sums(inner, ["words", "own0", "other0", "n0", "own1", "other1"], add)
    sent.unpersist()
    also.unpersist()
    return out


def exchange(sides: DataFrame, classes, counts: np.ndarray, parity: int) -> list:
    """(first, cls): the best classes of the words of each chunk of one parity, a byte a word.

    A word's gain in a class is the likelihood of its neighbours' classes there. P(word | class) and the class's own share
    offset each other.
    """
    alpha = 0.1
    log_in = np.log((counts + alpha) / (counts.sum(axis=0) + alpha * SYMBOLS)[None, :])[:, :CLASSES]  # of what stands before, given the class
    log_out = np.log((counts + alpha) / (counts.sum(axis=1) + alpha * SYMBOLS)[:, None])[:CLASSES].T  # of what follows
    both = np.concatenate((log_in, log_out))
    # a word seen once has one neighbour on either side, whose classes tell its own
    alone = (log_in[:, None, :] + log_out[None, :, :]).argmax(axis=2).astype(np.uint8)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cls = classes.value
        for pdf in batches:
            best = []
            for size, *two in zip(pdf["size"], *(pdf[f"{c}{k}"] for k in (0, 1) for c in ("own", "other", "n")), strict=True):
                two = [(np.frombuffer(own, "<u2"), cls[np.frombuffer(other, "<u4")], np.frombuffer(n, "<i8")) for own, other, n in (two[:3], two[3:])]
                single = weighted(two[0][0], two[0][2], size) == 1
                rank, rest = np.cumsum(~single) - 1, size - int(single.sum())
                beside, grids = np.zeros((2, size), np.uint8), []
                for k, (own, theirs, n) in enumerate(two):
                    one = single[own]
                    beside[k][own[one]] = theirs[one]
                    place = rank[own[~one]] * SYMBOLS + theirs[~one]  # pairs seen more than once come first, and are none of a single word's
                    grids.append(weighted(place, n, rest * SYMBOLS).reshape(rest, SYMBOLS))
                found = alone[beside[0], beside[1]]
                found[~single] = (np.hstack(grids) @ both).argmax(axis=1)
                best.append(found.tobytes())
            yield pd.DataFrame({"first": pdf["first"], "cls": best})

    half = sides.where((F.col("chunk") >= 0) & (F.col("chunk") % 2 == parity)).withColumn("size", (F.length("words") / 8).cast("int"))
    return half.drop("chunk", "words").mapInPandas(run, "first long, cls binary").collect()  # a byte a word


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """So many rows at most are read at once and go to a Python worker, for what is run inside: texts and blocks take much memory."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    usual = [spark.conf.get(name) for name in names]
    for name in names:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        for name, value in zip(names, usual, strict=True):
            spark.conf.set(name, value)


def likelihood(counts: np.ndarray) -> float:
    """Log-likelihood of the class sequence and of the words in their classes, but for a term that no class changes."""
    f = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return f(counts) - f(counts.sum(axis=0)) - f(counts.sum(axis=1))


class Model:
    """Class of each symbol, and log10 probabilities."""

    def __init__(self, classes: np.ndarray, counts: np.ndarray, mass: np.ndarray, types: np.ndarray):
        self.classes = classes
        margin, share = counts.sum(axis=1), counts.sum(axis=0)
        self.mass, self.types = mass, types
        size = len(share)
        own = (share + FLOOR) / (share.sum() + FLOOR * size)
        seen = np.divide(counts, margin[:, None], out=np.tile(own, (size, 1)), where=margin[:, None] > 0)
        self.transition = np.log10(BIGRAM_WEIGHT * seen + (1 - BIGRAM_WEIGHT) * own[None, :])
        # tail classes leave room for one unknown word
        self.room = np.log10(np.maximum(mass + FLOOR * (types + (np.arange(len(mass)) >= CLASSES)), FLOOR))

    def emission(self, c: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return np.log10(c + FLOOR) - self.room[cls]


def learn_classes(train: DataFrame, parts: int, trace: list[float] | None = None) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, c, cls) of every training word, the class of each word id (then start and end), counts of class pairs, and
    of pairs with words seen once in the classes of their endings.

    `trace` gets the likelihood at the start and after each batch that is kept; it never falls.
    """
    spark = train.sparkSession
    with batches_of(spark, TEXTS), shuffles_dropped(spark):
        pairs = materialize(words_and_pairs(train, parts), "word-pairs")
    sizes = np.zeros(parts, np.int64)
    for r in pairs.where("dst is null").select("part", (F.length("other") / 8).cast("long").alias("n")).collect():  # a row a part
        sizes[r.part] = r.n
    first = np.concatenate(([0], np.cumsum(sizes)))
    with shuffles_dropped(spark):
        sides = materialize(word_sides(pairs, first, parts), "word-sides")
    classes = np.append(np.arange(first[-1]) % CLASSES, (START, STOP)).astype(np.uint8)
    still = 0

    def counted(classes: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(classes)
        counts = class_counts(sides, sent)
        sent.unpersist()
        return counts

    with batches_of(spark, BLOCKS):
        counts = counted(classes)
        best = likelihood(counts)
        trace = [] if trace is None else trace
        trace.append(best)
        for step in range(ROUNDS * 2):
            sent = spark.sparkContext.broadcast(classes)
            moves = exchange(sides, sent, counts, step % 2)
            sent.unpersist()
            for halved in range(HALVED + 1):
                new = classes.copy()
                for k, r in enumerate(moves):
                    if k % (1 << halved) == 0:
                        new[r.first : r.first + len(r.cls)] = np.frombuffer(r.cls, np.uint8)
                after = counted(new) if (new != classes).any() else counts
                if likelihood(after) > best:
                    break
            if likelihood(after) > best:
                classes, counts, best, still = new, after, likelihood(after), 0
                trace.append(best)
            elif (still := still + 1) == 2:  # neither half moves
                break
        tails = tail_counts(sides, classes)
    sent = spark.sparkContext.broadcast(classes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, words, n in zip(pdf["part"], pdf["other"], pdf["n"], strict=True):
                hashes = np.frombuffer(words, "<i8")
                yield pd.DataFrame({"hash": hashes, "c": np.frombuffer(n, "<i8"), "cls": sent.value[first[part] : first[part] + len(hashes)].astype(np.int32)})

    learned = pairs.where("dst is null").select("part", "other", "n").mapInPandas(run, "hash long, c long, cls int")
    learned = materialize(learned, "word-classes")
    discard(pairs, sides)
    return learned, classes, counts, tails


def class_mass(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class, over the whole vocabulary."""
    mass, types = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for r in vocabulary.groupBy("cls").agg(F.sum("c").alias("mass"), F.count("*").alias("types")).collect():  # a row a class
        mass[r.cls], types[r.cls] = r.mass, r.types
    return mass, types


def score(docs: DataFrame, model: Model, vocabulary: DataFrame, top: np.ndarray, ends: int, total: int, distinct: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for rows (doc_id, held_out, raw).

    `top` has (hash, c, cls) of the words that are looked up in memory, by rising hash.
    """
    index, c, cls = top["hash"].view(np.uint64), top["c"].astype(float), top["cls"].astype(np.int64)
    room = np.log10(total + 0.5 * (distinct + 1))
    base = np.log10(c + 0.5) - room
    emitted = model.emission(c, cls)
    end_base, transition = float(np.log10(ends + 0.5) - room), model.transition

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = 0
            for raws in groups_of(pdf["raw"]):
                part = pdf.iloc[done : done + len(raws)]
                done += len(raws)
                words, tail, n = hashed_texts(raws)
                size, text = len(n), np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(index, words), max(len(index) - 1, 0))
                met = index[at] == words if len(index) else np.zeros(len(words), bool)
                rare, at, of = np.flatnonzero(~met), at[met], text[met]
                kinds = np.full(len(words), RARE, np.int64)
                kinds[met] = cls[at]
                path = framed(kinds, n, START, STOP)
                x, y = path[:-1], path[1:]
                plain = np.flatnonzero((x != RARE) & (y != RARE) & (x != STOP))
                own = np.bincount(np.repeat(np.arange(size), n + 2)[plain], transition[x[plain], y[plain]], size) + np.bincount(of, emitted[at], size)
                # the distinct rare words of each text, and which of these each rare word is
                by = text[rare]
                order = np.lexsort((words[rare], by))
                names, owner = words[rare][order], by[order]
                new = np.concatenate(([True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])))[: len(names)]
                cut, cut_rare = (np.searchsorted(x, np.arange(size + 1)) for x in (owner[new], by))
                which = np.empty(len(rare), "<i4")
                which[order] = np.cumsum(new) - 1 - cut[owner]
                names, tails = names[new].view(np.int64), tail[rare][order][new]
                before, after = (path[rare + 2 * by + d].astype(np.uint8) for d in (0, 2))
                spans, spans_rare = ([slice(*x) for x in zip(c[:-1], c[1:], strict=True)] for c in (cut, cut_rare))
                out = part[["doc_id", "held_out"]].astype({"doc_id": "Int64"}).assign(n_tokens=n + 1, n_known=np.bincount(of, minlength=size) + (ends > 0), base_score=np.bincount(of, base[at], size) + end_base, score=own)
                yield out.assign(rare=[names[k] for k in spans], tails=[tails[k].tobytes() for k in spans], **{c: [v[k].tobytes() for k in spans_rare] for c, v in (("which", which), ("before", before), ("after", after))})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rare words of each row, at their places."""
        for pdf in batches:
            more = []
            for tails, which, before, after, place, seen, kind in zip(*(pdf[x] for x in ("tails", "which", "before", "after", "place", "seen", "kind")), strict=True):
                if not len(tails):
                    more.append((0, 0.0, 0.0))
                    continue
                c, k = np.zeros(len(tails)), np.frombuffer(tails, np.uint8).astype(np.int64) + CLASSES
                if place is not None:
                    c[np.asarray(place)], k[np.asarray(place)] = np.asarray(seen, float), np.asarray(kind, np.int64)
                at = np.frombuffer(which, "<i4")
                n, k = c[at], k[at]
                left, right = np.frombuffer(before, np.uint8).astype(np.int64), np.frombuffer(after, np.uint8)
                left = np.where(left == RARE, np.roll(k, 1), left)
                out = right != RARE
                moves = transition[left, k].sum() + transition[k[out], right[out]].sum()
                more.append((int((n > 0).sum()), float((np.log10(n + 0.5) - room).sum()), float(model.emission(n, k).sum() + moves)))
            known, b, s = (np.array(x) for x in zip(*more, strict=True)) if more else (0, 0.0, 0.0)
            out = pdf[["doc_id", "held_out", "n_tokens"]].astype({"doc_id": "Int64"})
            yield out.assign(n_known=pdf["n_known"] + known, base_score=pdf["base_score"] + b, score=pdf["score"] + s)

    scored = docs.select("doc_id", "held_out", "raw").mapInPandas(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>, tails binary, which binary, before binary, after binary")
    with batches_of(docs.sparkSession, TEXTS), shuffles_dropped(docs.sparkSession):
        scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "partial-scores")
    # words that are not looked up meet their counts and classes here
    rare = scored.select("row", F.posexplode("rare").alias("place", "hash"))
    met = rare.join(vocabulary, "hash").groupBy("row").agg(F.collect_list(F.struct("place", "c", "cls")).alias("x"))
    met = met.select("row", F.col("x.place").alias("place"), F.col("x.c").alias("seen"), F.col("x.cls").alias("kind"))
    out = scored.drop("rare").join(met, "row", "left").drop("row")
    out = out.mapInPandas(add, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def most_frequent(vocabulary: DataFrame, most: int) -> np.ndarray:
    """(hash, c, cls) of the most frequent words, at most `most`, by hash: a histogram of counts gives the least count that fits."""
    step = F.floor(F.log2("c") * 64)
    least, held = None, 0
    for r in sorted(vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):  # a few thousand rows
        held += r.n
        if held > most:
            break
        least = r.step
    rows = [] if least is None else [(r["hash"], r.c, r.cls) for r in vocabulary.where(step >= least).collect()]
    out = np.array(rows, dtype=[("hash", "<i8"), ("c", "<i8"), ("cls", "<i4")])
    return out[np.argsort(out["hash"].view(np.uint64))]


def score_documents(docs: DataFrame, held_out=None) -> DataFrame:
    spark = docs.sparkSession
    held = fold() == 1 if held_out is None else held_out
    docs = raw_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)).drop("text")
    train = docs.where(~F.col("held_out"))
    # a part for so many bytes of text, so that what a task holds does not grow with the corpus
    size = train.agg(F.coalesce(F.sum(F.length("raw")), F.lit(0)).alias("bytes"), F.count("*").alias("texts")).first()
    ends, parts = size.texts, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + size.bytes // PART_BYTES)
    vocabulary, classes, counts, tails = learn_classes(train, parts)
    sums = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums.n + ends, sums.v + (ends > 0)
    model = Model(classes, counts + tails, *class_mass(vocabulary))
    return score(docs, model, vocabulary, most_frequent(vocabulary, LOOKED_UP), ends, total, distinct)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
