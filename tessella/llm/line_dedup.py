"""Line dedup by winnowing over line hashes. DataFrame functions only.

Lines with a word are normalised and hashed. From each line starts a window: the fewest lines with `words` words. The
least line hash of a window is its fingerprint, so every repeated run of `words` words or more shares one. Windows whose
fingerprint stands at one place only leave; the others meet by the hash of all their lines. The first place of a window,
by document and line, stays; at every later place the match is extended both ways against the first place, and the run
of lines is deleted. (Backward extension is by windows that start earlier: a line before a match that matches as well
starts a matching window itself. Forward extension compares the lines after the window, of which up to `words` words can
be missed by windows.)

Documents are ordered by id (null first), then a hash of the text. Defined cases: null text stays null and has no line;
rows that repeat both id and text are one document and get the same result; blank lines inside a deleted run go with it;
an empty table gives an empty result; columns that are not named pass through `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_CLASS, discard_since, mark, materialize, release
from .quality_rules import has_word, line_hash

WORDS = 50


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64("text"))


def windows(docs: DataFrame, words: int) -> DataFrame:
    """A row for each line with a word: its place, whether a window starts there, that window's last line, fingerprint,
    the fingerprint's place (a hash) and the hash of its lines; and the lines after this one, within `words` words."""
    parts = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.struct(i.alias("i"), line_hash(x).alias("h"), F.regexp_count(x, F.lit(WORD_CLASS)).cast("long").alias("n")))
    lines = keyed(docs).select("doc_id", "k1", "k2", F.explode(F.filter(parts, lambda x: x.n > 0)).alias("x"))
    lines = lines.select("doc_id", "k1", "k2", "x.i", "x.h", "x.n").distinct()
    doc = Window.partitionBy("k1", "k2")
    lines = lines.withColumn("at", F.sum("n").over(doc.orderBy("i")) - F.col("n")).withColumn("total", F.sum("n").over(doc))
    after = F.collect_list(F.struct("i", "h", "at")).over(doc.orderBy("at").rowsBetween(1, words - 1))
    stop = F.col("at") + F.col("n") + words
    lines = lines.withColumn("after", F.transform(F.filter(after, lambda x: x.at < stop), lambda x: F.struct(x.i.alias("i"), x.h.alias("h"))))
    span = doc.orderBy("at").rangeBetween(0, words - 1)
    least = F.min(F.struct("h", "i")).over(span)
    out = lines.withColumn("least", least).withColumn("lines", F.xxhash64(F.collect_list("h").over(span))).withColumn("end", F.last("i").over(span))
    return out.select(
        "doc_id", "k1", "k2", F.col("i").alias("start"), "end", (F.col("at") + words <= F.col("total")).alias("whole"),
        F.col("least.h").alias("mark"), F.xxhash64("k1", "k2", "least.i").alias("mark_at"), "lines", "after",
    )


def repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(k1, k2, runs): runs of lines to delete, first and last line, for each document that has any.

    Every join is of two written tables on a hash, so Spark deals both out and splits the part of a hot key. What grows
    with the texts is never broadcast (the merge hints), so the plan is the same at every size. Windows travel without lines; the lines after a window are fetched for those that match.
    """
    every = materialize(windows(docs, words), "line-windows")
    own = every.where("whole").select("doc_id", "k1", "k2", "start", "end", "mark", "mark_at", "lines")
    marks = own.groupBy("mark").agg(F.min("mark_at").alias("low"), F.max("mark_at").alias("high")).where("low <> high").select("mark")
    met = own.drop("mark_at").join(materialize(marks, "line-marks").hint("merge"), "mark", "left_semi").drop("mark")
    met = materialize(met, "windows-met")
    place = F.struct("doc_id", "k2", "start")
    first = met.groupBy("lines").agg(F.min(F.struct("doc_id", "k2", "start", "k1", "end")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("lines", "first"), "first-windows")
    later = met.join(first, "lines").where(~place.eqNullSafe(F.struct("first.doc_id", "first.k2", "first.start")))
    later = materialize(later.select("lines", "k1", "k2", "start", "end"), "later-windows")
    ends = later.select("k1", "k2", "end").unionByName(first.select("first.k1", "first.k2", "first.end")).distinct()
    tails = every.select("k1", "k2", F.col("start").alias("end"), "after").join(materialize(ends, "line-ends").hint("merge"), ["k1", "k2", "end"], "left_semi")
    tails = materialize(tails, "line-tails")
    first = first.select("lines", "first.k1", "first.k2", "first.end").join(tails, ["k1", "k2", "end"]).select("lines", F.col("after.h").alias("h"))
    later = later.join(tails, ["k1", "k2", "end"]).join(materialize(first, "first-tails"), "lines")
    differs = F.array_position(F.zip_with("after", "h", lambda x, y: F.coalesce(x.h == y, F.lit(False))), False)
    more = F.when(differs > 0, differs - 1).otherwise(F.size("after")).cast("int")
    last = F.when(more > 0, F.element_at(F.col("after.i"), F.greatest(more, F.lit(1)))).otherwise(F.col("end"))
    runs = later.select("k1", "k2", "start", last.alias("last"))
    before = Window.partitionBy("k1", "k2").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("k1", "k2").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("new", F.coalesce(F.col("start") > F.max("last").over(before) + 1, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(upto)).groupBy("k1", "k2", "run").agg(F.min("start").alias("start"), F.max("last").alias("last"))
    return runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "last")).alias("runs"))  # at most half a text's lines


def with_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc (all columns of a row), runs (null where none) and kept_text."""
    point = mark()
    runs = materialize(repeated_runs(docs.select("doc_id", "text"), words), "line-runs")
    discard_since(point, runs)
    release(docs.sparkSession)
    keys = [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text").alias("k2")]
    rows = docs.select(F.struct("*").alias("doc"), *keys).join(runs.hint("merge"), ["k1", "k2"], "left").withColumn("text", F.col("doc.text"))
    inside = lambda i: F.exists("runs", lambda r: (i >= r.start) & (i <= r["last"]))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~inside(i)), "\n")
    return rows.select("doc", "runs", F.when(F.col("runs").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))


def dedup_lines(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents without later repeated runs; those of which no word is left go. Columns as they were, n_chars renewed."""
    out = with_runs(docs, words).where(F.col("runs").isNull() | has_word(F.col("kept_text")))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce("doc.text", F.lit(""))
    kept = F.coalesce("kept_text", F.lit(""))
    lines = lambda t: F.size(F.filter(F.split(t, "\n"), has_word)).cast("long")
    return with_runs(docs).select(
        "doc.doc_id", lines(text).alias("n_lines"), (lines(text) - F.when(F.col("runs").isNull(), lines(text)).otherwise(lines(kept))).alias("n_removed_lines"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
raw AS (SELECT doc_id, unnest(range(0, len(parts))) AS i, unnest(parts) AS x FROM d),
l AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) - n AS pos, sum(n) OVER (PARTITION BY doc_id) AS total FROM (
    SELECT doc_id, i, lower(regexp_replace(trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
           len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM raw) WHERE n > 0
), w AS (
  SELECT doc_id, i, pos, total, list(line) OVER f AS lines, last_value(i) OVER f AS e, last_value(pos + n) OVER f AS stop FROM l
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
), good AS (
  SELECT *, count(*) OVER (PARTITION BY lines) AS c FROM w WHERE pos + 50 <= total
), met AS (
  SELECT g.doc_id, g.i, g.lines, g.e, list(t.line ORDER BY t.i) FILTER (WHERE t.i IS NOT NULL) AS tail, list(t.i ORDER BY t.i) FILTER (WHERE t.i IS NOT NULL) AS tail_i
  FROM good g LEFT JOIN l t ON t.doc_id = g.doc_id AND t.i > g.e AND t.pos < g.stop + 50 WHERE g.c > 1 GROUP BY ALL
), ranked AS (
  SELECT *, first_value(coalesce(tail, [])) OVER o AS first_tail, row_number() OVER o AS r FROM met WINDOW o AS (PARTITION BY lines ORDER BY doc_id, i)
), later AS (
  SELECT *, len(list_filter(range(1, least(len(coalesce(tail, [])), len(first_tail)) + 1), lambda k: tail[1:k] = first_tail[1:k])) AS k FROM ranked WHERE r > 1
), runs AS (
  SELECT doc_id, i AS a, CASE WHEN k > 0 THEN tail_i[k] ELSE e END AS z FROM later
), merged AS (
  SELECT doc_id, a, z, coalesce(a > max(z) OVER (PARTITION BY doc_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) AS fresh FROM runs
), gone AS (
  SELECT DISTINCT raw.doc_id, raw.i FROM raw JOIN runs ON raw.doc_id = runs.doc_id AND raw.i BETWEEN a AND z
), kept AS (
  SELECT raw.doc_id, string_agg(x, chr(10) ORDER BY raw.i) FILTER (WHERE gone.i IS NULL) AS t, count(*) FILTER (WHERE regexp_matches(x, '[^\x20\x09-\x0D]')) AS n_lines,
         count(*) FILTER (WHERE regexp_matches(x, '[^\x20\x09-\x0D]') AND gone.i IS NOT NULL) AS n_removed_lines
  FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.i = gone.i GROUP BY raw.doc_id
)
SELECT kept.doc_id, n_lines::BIGINT AS n_lines, n_removed_lines::BIGINT AS n_removed_lines,
       coalesce(m.n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN (SELECT doc_id, count(*) FILTER (WHERE fresh) AS n_runs FROM merged GROUP BY doc_id) m ON m.doc_id = kept.doc_id
"""
