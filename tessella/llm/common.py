"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import discard, discard_since, mark, materialize, new_path, release, shared_dir, shuffles_dropped

__all__ = ["SPACES", "SPACE_CLASS", "WORD_CLASS", "crc32_sql", "discard", "discard_since", "fold", "mark", "materialize", "n_words_of", "new_path", "release", "running_sum", "salt_bits", "shared_dir", "shuffles_dropped", "slice_sums", "words_of"]

#: The six characters that separate words, as a class for Java regular expressions and as text.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\u000b\f\r"

def words_of(text: Column) -> Column:
    """Array of words; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.expr("array()").cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def fold(doc_id: str = "doc_id", n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of a text: a fold over its bytes, and over the bits of each."""
    octets = f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    bits = "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), {bits}), 4294967295)"


def salt_bits(rows: int) -> int:
    """So many leading bits of a uniform hash that a group of all rows has as many slices as a slice has rows."""
    return max(rows, 1).bit_length() // 2


def _slice(order: str, rows: int) -> Column:
    return F.shiftright(order, 64 - salt_bits(rows)) if salt_bits(rows) else F.lit(0).cast("long")


def slice_sums(df: DataFrame, key: str, order: str, value: str, rows: int) -> DataFrame:
    """(_part, _slice2, _base): for each slice of each key, the sum of `value` over the key's slices before it."""
    before = Window.partitionBy("_part").orderBy("_slice2").rowsBetween(Window.unboundedPreceding, -1)
    base = df.groupBy(key, _slice(order, rows).alias("_slice2")).agg(F.sum(value).alias("_sum"))
    base = base.select(F.xxhash64(F.col(key), F.col(key).isNull()).alias("_part"), "_slice2", "_sum")
    return base.select("_part", "_slice2", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))


def running_sum(df: DataFrame, key: str, order: str, ties: list[str], value: str, out: str, rows: int, base: DataFrame | None = None) -> DataFrame:
    """`out`: sum of `value` over the rows of the same `key` before this one, by `order` (a uniform 64-bit hash), then `ties`.

    A key may hold any share of all rows: each is cut along its order into slices that grow in number with the
    rows; slice totals (`base`, by slice_sums) are summed first, then rows within their slice. No task sees a whole key.
    Keys go by a 64-bit hash, so that rows are dealt out once, by (hash, slice), for the join and the window.
    """
    base = slice_sums(df, key, order, value, rows) if base is None else base
    sliced = df.withColumn("_own", F.xxhash64(F.col(key), F.col(key).isNull())).withColumn("_slice", _slice(order, rows))
    within = Window.partitionBy("_own", "_slice").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(base, (F.col("_own") == F.col("_part")) & (F.col("_slice") == F.col("_slice2")))
    return joined.withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_own", "_slice", "_slice2", "_part", "_base")
