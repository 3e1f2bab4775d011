"""Quality rules: text rules of one document, and line frequency across documents. DataFrame functions only.

Lines are normalised (lower case, runs of space as one space, ends trimmed) and hashed; for each host (the source) the
distinct documents that hold a line are counted. A line in more documents than the host's limit is boilerplate; documents
left with less than half of their words without such lines are depleted.

Defined cases: null text has no words and fails the base rules; a null source is one host of its own; rows that repeat
an id and text are one document and get the same verdict; documents with null ids are told apart by their texts; an empty
table gives an empty result; columns that are not named pass through `apply_rules`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, discard_since, mark, materialize, release, words_of

MIN_WORDS = 50
#: A line is above its host's limit in more than this share of the host's documents, and in more than LEAST_DOCS.
LINE_SHARE = 0.05
LEAST_DOCS = 20
#: Least part of a document's words that must be left.
KEEP_PART = 0.5

#: Window hashes share a long with the window's place: so many bits of place, the rest of hash.
PLACE_BITS = 21
_EMPTY = "cast(array() as array<bigint>)"


def repeat_words(df: DataFrame, place_bits: int = PLACE_BITS) -> DataFrame:
    """Adds n_repeat_words, from `words`: those covered by 3-word windows that occur twice or more in the text.

    Sorting hashes brings equal windows together; hash and place are packed into one long, which sorts as a primitive
    array, and neighbours are compared by their whole hash. Where neighbours agree in the packed part of their hash but not
    in all of it, equal windows may lie apart: such texts sort (hash, place) pairs, as do texts with more windows than places.
    """
    _PLACE = (1 << place_bits) - 1
    df = df.withColumn("_h", F.expr(f"if(size(words) < 3, {_EMPTY}, transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))))"))
    df = df.withColumn("_s", F.expr(f"if(size(_h) > {_PLACE}, {_EMPTY}, sort_array(transform(_h, (h, i) -> (h & {~_PLACE}L) | i)))"))
    at, part = f"cast(_s[k] & {_PLACE} as int)", f"(_s[k] & {~_PLACE}L) = (_s[k - 1] & {~_PLACE}L)"
    same = f"_h[{at}] = _h[cast(_s[k - 1] & {_PLACE} as int)]"
    df = df.withColumn("_q", F.expr(f"if(size(_s) < 2, cast(array() as array<int>), filter(sequence(1, size(_s) - 1), k -> {part}))"))
    df = df.withColumn("_e", F.expr(f"filter(_q, k -> {same})"))
    df = df.withColumn("_l", F.expr(f"if(size(_h) > {_PLACE} or size(_e) < size(_q), array_sort(transform(_h, (h, i) -> struct(h, cast(i as bigint) as i))), cast(array() as array<struct<h: bigint, i: bigint>>))"))
    df = df.withColumn("_f", F.expr(f"if(size(_e) = 0, {_EMPTY}, sort_array(array_distinct(flatten(transform(_e, k -> array(_s[k - 1] & {_PLACE}, _s[k] & {_PLACE}))))))"))
    df = df.withColumn("_m", F.expr(f"if(size(_l) < 2, {_EMPTY}, sort_array(transform(filter(_l, (x, k) -> (k > 0 and _l[k - 1].h = x.h) or (k + 1 < size(_l) and _l[k + 1].h = x.h)), x -> x.i)))"))
    df = df.withColumn("_p", F.expr("if(size(_l) > 0, _m, _f)"))
    total = "aggregate(transform(_p, (q, k) -> if(k = 0, 3L, least(3L, q - _p[k - 1]))), 0L, (a, x) -> a + x)"
    return df.withColumn("n_repeat_words", F.expr(f"if(size(_p) = 0, 0L, {total})")).drop("_h", "_s", "_q", "_e", "_l", "_f", "_m", "_p")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def normal_line(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACES)), r"[\x20\x09-\x0D]+", " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, the base counts, `_text_key`, and `_lines`: hash and words of each line with a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", "source", "text").withColumn("_text", text).withColumn("words", words_of(F.col("text")))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.translate("_text", SPACES, "")).cast("long"))
    df = df.withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long"))
    df = repeat_words(df).drop("words")
    df = df.withColumn("_split", F.filter(F.split("_text", "\n"), has_word))
    df = df.withColumn("n_dup_lines", (F.size("_split") - F.size(F.array_distinct("_split"))).cast("long"))
    df = df.withColumn("_lines", F.transform("_split", lambda x: F.struct(line_hash(x).alias("line"), F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n"))))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return df.withColumn("_text_key", F.xxhash64("text")).drop("text", "_text", "_split")


def host_of() -> Column:
    """The source as a key that is never null: a null source is like no text."""
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))


def frequent_lines(measured: DataFrame, share: float = LINE_SHARE, least: int = LEAST_DOCS) -> DataFrame:
    """(host, line) above the host's limit. Rows that repeat a document go first; a document then names each line once, so
    lines and documents are counted by partial sums."""
    docs = measured.select(host_of().alias("host"), "doc_id", "_text_key", F.col("_lines.line").alias("lines")).dropDuplicates(["host", "doc_id", "_text_key"])
    held = docs.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("docs"))
    hosts = docs.groupBy("host").agg(F.count("*").alias("host_docs"))
    return held.where(F.col("docs") > least).join(hosts, "host").where(F.col("docs") > share * F.col("host_docs")).select("host", "line", "docs")


def verdicts(measured: DataFrame, share: float = LINE_SHARE, least: int = LEAST_DOCS, keep_part: float = KEEP_PART) -> DataFrame:
    """Adds removed_words, `_removed` (hashes of lines above their limit) and kept."""
    frequent = materialize(frequent_lines(measured, share, least), "line-limits")
    keys = ["doc_id", "_host", "_text_key"]
    rows = measured.withColumn("_host", host_of())
    lines = rows.dropDuplicates(keys).select(*keys, F.explode("_lines").alias("x")).select(*keys, F.col("x.line").alias("line"), F.col("x.n").alias("n"))
    lines = lines.join(frequent.select(F.col("host").alias("_host"), "line"), ["_host", "line"])
    hit = lines.groupBy(*keys).agg(F.sum("n").alias("removed_words"), F.collect_set("line").alias("_removed"))
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("_host").alias("_h2"), F.col("_text_key").alias("_k2"), "removed_words", "_removed")
    hit = materialize(hit, "line-hits")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_host") == F.col("_h2")) & (F.col("_text_key") == F.col("_k2"))
    rows = rows.drop("_lines").join(hit.hint("merge"), on, "left").drop("_id", "_h2", "_k2", "_host")
    rows = rows.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("removed_words") >= keep_part * F.col("n_words")))


def apply_rules(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without the lines above their host's limit; columns as they were, n_chars renewed."""
    # a short row a document is measured and judged; texts meet the verdicts once
    point = mark()
    short = materialize(measure(docs), "rules-measured")
    good = verdicts(short).where("kept").select(F.col("doc_id").alias("_id"), F.col("source").alias("_s2"), F.col("_text_key").alias("_k2"), "_removed")
    good = materialize(good.dropDuplicates(["_id", "_s2", "_k2"]), "rules-kept")
    discard_since(point, good)
    release(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("_doc"), "doc_id", "source", F.xxhash64("text").alias("_text_key"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_text_key") == F.col("_k2"))
    text = F.col("_doc.text")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~has_word(x) | ~F.array_contains(F.col("_removed"), line_hash(x))), "\n")
    out = rows.join(good.hint("merge"), on).select("_doc", F.when(F.col("_removed").isNotNull(), left).otherwise(text).alias("_left"))
    new = {"text": F.col("_left"), "n_chars": F.length("_left").cast("long")}
    return out.select(*[new.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    measured = materialize(measure(docs), "rules-measured")
    return verdicts(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS host, coalesce(text, '') AS text, CASE WHEN text IS NULL THEN 'n' ELSE md5(text) END AS tk,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, host, tk, text, w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), wins AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM wins
), covered AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE c >= 2) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, tk, lower(regexp_replace(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT doc_id, host, tk, unnest(ls) AS x FROM l)
), hosts AS (SELECT host, count(DISTINCT (doc_id, tk)) AS host_docs FROM d GROUP BY host),
frequent AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT (doc_id, tk)) AS docs FROM lines GROUP BY host, line) JOIN hosts USING (host)
  WHERE docs > 20 AND docs > 0.05 * host_docs
), removed AS (
  SELECT doc_id, sum(n)::BIGINT AS n FROM lines JOIN frequent USING (host, line) GROUP BY doc_id
), r AS (
  SELECT l.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM l LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed_words >= 0.5 * n_words AS kept, removed_words FROM b
"""
