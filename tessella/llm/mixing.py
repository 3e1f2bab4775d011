"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]: its weight times piecewise-linear multipliers at
equally spaced knots. The integral of the schedule gives the source's share of all tokens; the cumulative integral,
inverted at a document's place in its source's token count, gives the document's training position; copies are then
range-sorted by position.

Defined cases: null text has size 0 and takes 0; a null source is a source of its own, last in order; repeated rows
count each on its own; an empty table gives an empty result; columns other than those named pass through `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, n_words_of, running_sum, slice_sums

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
#: Multipliers at t = 0, 1/2 and 1, dealt to the sources in turn: falling, even and rising weight.
RAMPS = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, ramps=RAMPS) -> DataFrame:
    """One row per source: source, source_size, target, ramp.

    The level L solves sum(min(most * size, L * weight)) = share * total: with sources by rising most * size / weight,
    it is the first (rest of demand) / (rest of weight) that does not exceed its own source's ratio. One row per
    source only, so the windows here order a table of sources, never documents.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.col("turn") % len(values) + 1).cast("int"))
    ramp_arrays = F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in ramps])
    by = by.withColumn("turn", turn).withColumn("weight", pick(weights, "double")).withColumn("ramp", F.element_at(ramp_arrays, (F.col("turn") % len(ramps) + 1).cast("int")))
    by = by.withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("turn"))
    everything = Window.partitionBy(F.lit(1))
    by = by.withColumn("demand", F.sum("source_size").over(everything) * F.lit(share))
    by = by.withColumn("left", F.col("demand") - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    by = by.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    by = by.withColumn("level", F.min(F.when(F.col("left") / F.col("rest") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("turn"), F.col("left") / F.col("rest")))).over(everything)["col3"])
    target = F.least("cap", F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return by.select("source", "source_size", "source_rows", target.alias("target"), "ramp")


def position(done: Column, ramp: Column, knots: int) -> Column:
    """The time at which the integral of the schedule reaches the share `done` of its whole.

    Between two knots the schedule is a line, its integral a quadratic; each segment's root is closed-form.
    """
    step = 1.0 / (knots - 1)
    area = [(ramp[k] + ramp[k + 1]) * (step / 2) for k in range(knots - 1)]
    whole = sum(area[1:], area[0])
    out, start = F.lit(1.0), [F.lit(0.0)]
    for a in area:
        start.append(start[-1] + a)
    for k in reversed(range(knots - 1)):
        need = F.greatest(done * whole - start[k], F.lit(0.0))
        slope = (ramp[k + 1] - ramp[k]) / step
        # the form 2c / (b + sqrt(b^2 + 2ac)) holds for slope 0 as well
        root = (2.0 * need) / (ramp[k] + F.sqrt(F.greatest(ramp[k] * ramp[k] + 2.0 * slope * need, F.lit(0.0))))
        t = F.lit(k * step) + F.least(F.when(need <= 0, F.lit(0.0)).otherwise(root), F.lit(step))
        out = F.when(done * whole < start[k + 1], t).otherwise(out)
    return out


def order_of(doc_id: Column) -> Column:
    """A uniform 64-bit order of documents: the first 60 bits of the id's MD5, spread over the signed range."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") - (1 << 59)) * 16


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS, ramps=RAMPS, extra: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, `_row`, positions, and columns `extra`.

    Documents follow a hash of their id; the m-th pass over a source is laid after the one before. A copy is taken if
    its middle lies before the source's target, so a source misses it by half a document at most. Sizes, targets and the
    sums of slices come from rows without `extra`, so columns of any width are dealt out once, by source and slice.
    """
    own = [n_words_of(F.col("text")).alias("size"), order_of(F.col("doc_id")).alias("_at")]
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("_tie"), *own)
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "mix-sizes")
    targets = source_targets(rows, weights, share, most, ramps).withColumnRenamed("source", "_source")
    targets = materialize(targets, "mix-targets")
    n, ties = rows.count(), ["doc_id", "size", "_tie"]
    base = materialize(slice_sums(rows, "source", "_at", "size", n), "mix-slices")
    if extra:
        rows = docs.select("doc_id", "source", F.xxhash64("text", *extra).alias("_tie"), *own, *extra)
    placed = running_sum(rows, "source", "_at", ties, "size", "_start", n, base)
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    copies = []
    for m in range(most):
        begin = F.lit(m) * F.col("source_size") + F.col("_start")
        taken = (F.col("size") > 0) & (begin + F.col("size") / 2 < F.col("target"))
        copies.append(F.when(taken, position(begin / F.col("target"), F.col("ramp"), len(ramps[0]))))
    placed = placed.withColumn("positions", F.array_compact(F.array(*copies)))
    return placed.select("doc_id", "source", "size", "source_size", "target", "positions", *(extra or ["_row"]))


def sequence(planned: DataFrame) -> DataFrame:
    """The mixture as a sequence: a row for each taken copy with its position and `start`, the words of all copies before
    it. Copies are ordered by position, then id and row; slices of positions are summed first, so no task sees them all."""
    copies = planned.select("_row", "doc_id", "size", F.explode("positions").alias("position"))
    copies = materialize(copies.withColumn("_all", F.lit(0)), "mix-copies")
    # positions fill [0, 1] at an even rate, as the schedules' total changes little over time
    copies = copies.withColumn("_at", F.floor((F.col("position") - 0.5) * 18446744073709551616.0).cast("long"))
    return running_sum(copies, "_all", "_at", ["position", "doc_id", "_row"], "size", "start", copies.count()).drop("_all", "_at")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: a row for each taken copy with all columns of `docs`, range-sorted by training position."""
    packed = docs.select("doc_id", "source", "text", F.struct("*").alias("_doc"))
    out = plan(packed, extra=["_doc"], **options).select("doc_id", "_doc", F.explode("positions").alias("_position"))
    return out.repartitionByRange("_position", "doc_id").sortWithinPartitions("_position", "doc_id").select("_doc.*")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's part in the mixture: words and copies taken, and where the first copy stands."""
    planned = materialize(plan(spark.read.parquet(f"{sf_dir}/documents.parquet")), "mix-plan")
    taken = sequence(planned).groupBy("_row").agg(
        F.sum("size").alias("taken"), F.count("*").alias("repeats"), F.min("position").alias("first_position"), F.min("start").alias("first_start")
    )
    none = F.lit(0).cast("long")
    return planned.join(taken, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), F.coalesce("repeats", none).alias("repeats"), F.round("first_position", 9).alias("first_position"), "first_start"
    )


ORACLE = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ord FROM documents
), src AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS turn FROM (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source)
), w AS (
  SELECT *, [3.0, 1.0, 2.0][(turn % 3 + 1)::INT]::DOUBLE AS weight, 2 * source_size::DOUBLE AS cap, turn % 3 AS kind FROM src
), o AS (
  SELECT *, 1.5 * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares FROM w
), lvl AS (SELECT min_by(rest / shares, (cap / weight, turn)) AS level FROM o WHERE rest / shares <= cap / weight),
t AS (SELECT source, source_size, kind, least(cap, coalesce(level, 'infinity'::DOUBLE) * weight) AS target FROM o, lvl),
d AS (
  SELECT s.*, t.source_size, t.target, t.kind, coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin0
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (m * source_size + begin0) / target AS done FROM d, (SELECT unnest([0, 1]) AS m) WHERE size > 0 AND m * source_size + begin0 + size / 2 < target
), p AS (
  SELECT *, CASE kind
    WHEN 1 THEN least(done, 1.0)
    WHEN 0 THEN CASE WHEN done < 0.625 THEN 2 * done / (1.5 + sqrt(greatest(2.25 - 2 * done, 0))) ELSE 0.5 + 2 * (done - 0.625) / (1 + sqrt(greatest(1 - 2 * (done - 0.625), 0))) END
    ELSE CASE WHEN done < 0.375 THEN 2 * done / (0.5 + sqrt(0.25 + 2 * done)) ELSE 0.5 + 2 * (done - 0.375) / (1 + sqrt(1 + 2 * (done - 0.375))) END END AS position FROM c
), q AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY position, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM p
)
SELECT d.doc_id, d.size, d.source_size, d.target, coalesce(sum(q.size), 0)::BIGINT AS taken, count(q.size) AS repeats,
       round(min(q.position), 9) AS first_position, min(q.start) AS first_start
FROM d LEFT JOIN q ON d.doc_id = q.doc_id GROUP BY ALL
"""
