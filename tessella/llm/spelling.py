"""Spelling variants: words one edit apart, grouped under their frequent forms, by dynamic programming over sorted lists.

A pair that differs by one inserted, deleted or replaced code point agrees in all that lies before or all that lies behind
the middle of the shorter word. So each word joins the lists of the words that begin with its first half and of those that
end with its second. A list that is long is cut again in the same way, at the middle of the stretch that is still open, as
often as need be; where one code point is open, the alphabet bounds a list. A list is sorted by words (or by words read
backwards), and each word is compared with those after it: a row of the edit matrix, three cells wide, for each code point
of the word compared; rows for the prefix that it shares with the word before it are kept, and where a row exceeds one edit
all words with that prefix are skipped. Every pair is counted in one list alone.

Defined cases: null and blank texts have no words; a null id counts as the empty text in the damage; texts of any length are
read whole; ties between forms go to the smallest word in code-point order; rows that repeat count as often as they occur;
other columns do not matter, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_sql, discard, materialize

#: Runs of letters that can hold a word, fewest code points and occurrences of a word, how much more frequent a form is.
RUN = r"[A-Za-zÀ-ÿ]"
FEWEST, RARE, RATIO = 7, 2, 10
#: Words in a list beyond which it is cut again.
LONG = 128


def runs_of(text: Column, fewest: int = FEWEST) -> Column:
    """Maximal runs of letters with `fewest` code points or more, A-Z in lower case."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(lower, F.lit("")), F.lit(f"{RUN}{{{fewest},}}"), F.lit(0))


def damaged_runs(docs: DataFrame) -> DataFrame:
    """(word): every run of a document's text, one code point deleted from one in 31 by the CRC-32 of id and run."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(runs_of(F.col("text"))).alias("_run"))
    rows = rows.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    cut = F.expr("concat(substring(_run, 1, cast(_h % length(_run) as int)), substring(_run, cast(_h % length(_run) as int) + 2))")
    return rows.select(F.when(F.col("_h") % 31 == 0, cut).otherwise(F.col("_run")).alias("word"))


def vocabulary(words: DataFrame, fewest: int = FEWEST, rare: int = RARE) -> DataFrame:
    """(word, n): distinct words that are long and frequent enough."""
    return words.where(F.length("word") >= fewest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rare)


#: A list: length of the shorter words in it, code points of prefix and suffix that all share, prefix whose pairs lie elsewhere.
_LIST = ["size", "front", "back", "out", "key"]


def _halves(rows: DataFrame) -> DataFrame:
    """Rows in the two lists that a list is cut into: the open stretch's first half agrees, or its second."""
    open_ = F.col("size") - F.col("front") - F.col("back")
    half = F.floor(open_ / 2).cast("int")
    one = F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back"), F.col("out").alias("out"))
    two = F.struct(F.col("front").alias("front"), (F.col("back") + open_ - half).alias("back"), (F.col("front") + half).alias("out"))
    rows = rows.select("word", "n", "size", F.explode(F.array(one, two)).alias("_part")).select("word", "n", "size", "_part.*")
    front, back = F.expr("substring(word, 1, front)"), F.expr("if(back = 0, '', right(word, back))")
    return rows.withColumn("key", F.concat(front, F.lit("|"), back))


def lists(words: DataFrame, long: int = LONG, fewest: int = FEWEST) -> DataFrame:
    """(size, front, back, out, key, word, n): words dealt to lists of at most `long`, or with one open code point."""
    sizes = F.filter(F.array(F.length("word") - 1, F.length("word")), lambda size: size >= fewest)
    rows = _halves(words.select("word", "n", F.explode(sizes).alias("size"), F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit(0).alias("out")))
    done = []
    for level in range(64):  # a cut halves what is open; no word has 2 ** 64 code points
        rows = materialize(rows, f"spelling-lists-{level}")
        counts = rows.groupBy(*_LIST).agg(F.count("*").alias("_members")).where("_members > 1")
        cut = (F.col("_members") > long) & (F.col("size") - F.col("front") - F.col("back") > 1)
        counts = materialize(counts.withColumn("_cut", cut), f"spelling-counts-{level}")
        done.append(rows.join(counts.where("not _cut").select(*_LIST), _LIST))
        if counts.where("_cut").isEmpty():
            break
        rows = _halves(rows.join(counts.where("_cut").select(*_LIST), _LIST))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    for k in range(most):
        if a[k] != b[k]:
            return k
    return most


def near_in_list(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places of distinct sorted words that are one edit apart."""
    count = len(words)
    common = [0, *map(shared, words, words[1:])]  # with the word before
    for i in range(count - 1):
        own = words[i]
        length = len(own)
        #: rows[d]: edits between d code points of the word compared and d-1, d, d+1 of this one; two stands for more than one
        rows: list[tuple[int, int, int]] = [(1, 0, 1)] * (common[i + 1] + 1)
        j = i + 1
        while j < count:
            other = words[j]
            size, depth = len(other), common[j]
            del rows[depth + 1 :]
            less, same, more = rows[depth]
            while depth < size:
                c = other[depth]
                at = min(less + (depth == 0 or depth - 1 >= length or c != own[depth - 1]), same + 1, 2)
                here = min(same + (depth >= length or c != own[depth]), more + 1, at + 1, 2)
                more = min(more + (depth + 1 >= length or c != own[depth + 1]), here + 1, 2)
                less, same = at, here
                depth += 1
                if less > 1 and same > 1 and more > 1:
                    break
                rows.append((less, same, more))
            else:
                gap = length - size
                if -2 < gap < 2 and (less, same, more)[gap + 1] == 1:
                    yield i, j
                j += 1
                continue
            j += 1
            while j < count and common[j] >= depth:
                j += 1


def compare(members: list[tuple[str, int]], size: int, front: int, back: int, out: int) -> dict[str, tuple[int, int, str]]:
    """For each word of one list that has near words: their number, the largest n, and the smallest word with it."""
    turned = back > front
    lines = sorted((word[::-1] if turned else word, word, n) for word, n in members)
    found: dict[str, tuple[int, int, str]] = {}
    for i, j in near_in_list([line[0] for line in lines]):
        (_, a, n), (_, b, m) = lines[i], lines[j]
        if (len(a) > size and len(b) > size) or (out and a[:out] == b[:out]):
            continue  # another list has this pair
        for word, near, k in ((a, b, m), (b, a, n)):
            have = found.get(word)
            if have is None:
                found[word] = (1, k, near)
            else:
                better = k > have[1] or (k == have[1] and near < have[2])
                found[word] = (have[0] + 1, k, near) if better else (have[0] + 1, have[1], have[2])
    return found


def near_words(listed: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): near words of each word that has any, and the most frequent of them."""
    import pyarrow as pa

    names = ["word", "n_near", "best_n", "best"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, found = None, [], []

        def flush():
            columns = list(zip(*found, strict=True)) or [[]] * 4
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=names)

        def close():
            found.extend((word, *row) for word, row in compare(members, *at[:4]).items())
            members.clear()

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for *own, word, n in zip(*columns, strict=True):
                if own != at:
                    if len(members) > 1:
                        close()
                    members.clear()
                    at = own
                members.append((word, n))
            if len(found) > 20_000:
                yield flush()
        if len(members) > 1:
            close()
        yield flush()

    rows = listed.select(*_LIST, "word", "n").repartition(*_LIST).sortWithinPartitions(*_LIST)
    part = rows.mapInArrow(scan, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("_first")).select("word", "n_near", (-F.col("_first.less")).alias("best_n"), F.col("_first.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms. Each pass doubles the steps taken; n grows tenfold a step."""
    jumps = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = jumps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        longer = jumps.join(ahead, F.col("root") == F.col("_at"), "left")
        after = materialize(longer.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        moved = not after.where("_moved").isEmpty()
        discard(jumps)
        jumps = after.drop("_moved")
        if not moved:
            return jumps


def variants(words: DataFrame, ratio: int = RATIO, long: int = LONG, fewest: int = FEWEST) -> DataFrame:
    """(word, n) to word, form, root, n, n_near, form_n: a word's form is its most frequent near word, if that is `ratio` times as frequent."""
    words = materialize(words.select("word", "n"), "spelling-words")
    near = materialize(near_words(lists(words, long, fewest)), "spelling-near")
    has = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    joined = materialize(joined, "spelling-forms")
    out = joined.join(roots(joined.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(damaged_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


ORACLE = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents
), each AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run
), crc AS (SELECT run, n, {crc32_sql("id || ':' || run")} AS h FROM each
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc
), v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM v)
), one AS (SELECT DISTINCT v.word AS a, cut.word AS b FROM v JOIN cut ON cut.less = v.word
), near AS (
  SELECT a, b FROM one UNION ALL SELECT b, a FROM one
  UNION ALL SELECT x.word, y.word FROM cut x JOIN cut y ON x.less = y.less AND x.p = y.p AND x.word <> y.word
), best AS (SELECT a, count(*) AS n_near, arg_min(b, (-v.n, b)) AS b, max(v.n) AS n FROM near JOIN v ON v.word = b GROUP BY a
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.n >= 10 * v.n THEN best.b END AS form, CASE WHEN best.n >= 10 * v.n THEN best.n END AS form_n FROM v LEFT JOIN best ON best.a = v.word
), walk AS (SELECT word, word AS reached, 0 AS steps FROM formed UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN formed ON formed.word = walk.reached WHERE form IS NOT NULL
), ends AS (SELECT word, arg_max(reached, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
