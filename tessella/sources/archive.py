"""Sources and sinks: Parquet archive with a manifest, lists of accounts, line, TSV and JSON reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ARCHIVE
from ..storage import hadoop, materialize


def write_archive(rows: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """zstd Parquet, files of at most `per_file` rows. Spark's committer renames whole files; nothing partial is read."""
    rows.write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path)


def read_archive(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of all versions by column name: columns that an older file lacks are null."""
    parts = [spark.read.option("mergeSchema", "true").parquet(p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    have = set(out.columns)
    return out.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in ARCHIVE])


def manifest(spark: SparkSession, path: str, time: str = "created_at") -> DataFrame:
    """A row for each file: name, bytes, rows, first and last time."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col(time).alias("t"))
    return rows.groupBy("file", "bytes").agg(F.count("*").alias("rows"), F.min("t").alias("min_time"), F.max("t").alias("max_time"))


def write_manifest(spark: SparkSession, path: str, out: str, time: str = "created_at") -> None:
    manifest(spark, path, time).coalesce(1).write.mode("overwrite").json(out)


def storage(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """Parts, bytes on disk and rows of each table's folder or file below `root`, from what a scan tells of its files."""
    file = lambda t: spark.read.parquet(f"{root}/{t}.parquet").select(F.lit(t).alias("table"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    files = reduce(DataFrame.unionByName, map(file, tables)).groupBy("table", "file", "bytes").agg(F.count("*").alias("rows"))
    return files.groupBy("table").agg(F.count("*").alias("parts"), F.sum("bytes").alias("bytes_on_disk"), F.sum("rows").alias("rows"))


def did_list(spark: SparkSession, path: str) -> DataFrame:
    """One account a line, or account and host by white space; blank and malformed lines are dropped."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("did"), F.try_element_at(parts, F.lit(2)).alias("host"), F.size(parts).alias("n"))
    return rows.where(F.col("did").startswith("did:") & (F.col("n") <= 2)).drop("n")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def write_report(df: DataFrame, by: str, path: str) -> None:
    """JSON lines, largest first."""
    df.orderBy(F.desc(by)).write.mode("overwrite").json(path)


def replay_last(pages: DataFrame, key: str = "did", seq: str = "seq") -> DataFrame:
    """Paged enumeration, replayed: the last operation of each account counts, and the cursor is the largest sequence."""
    return pages.groupBy(key).agg(F.max_by(F.struct(*[c for c in pages.columns if c != key]), seq).alias("_row")).select(key, "_row.*")


def write_sorted(df: DataFrame, key: str, path: str, per_file: int = 1_000_000) -> DataFrame:
    """Write a table in order of its key, and return its directory: file, low, high, rows of each."""
    spark = df.sparkSession
    df.repartitionByRange(key).sortWithinPartitions(key).write.option("maxRecordsPerFile", per_file).parquet(path)
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("k"))
    return materialize(rows.groupBy("file").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("rows")), "directory")


def page_after(directory: DataFrame, key: str, after, n: int) -> tuple[DataFrame, int]:
    """Keyset page: the next n rows after a key (None: from the start), and how many files it reads.

    The directory tells which files can hold them; files before the key and after the page are not opened.
    """
    spark, files, rows = directory.sparkSession, [], 0
    ahead = directory if after is None else directory.where(F.col("high") > F.lit(after))
    for f in ahead.orderBy("low").toLocalIterator():
        if rows >= n:
            break
        files.append(f.file)
        rows += f.rows if after is None or f.low > after else 0  # of a file that the key lies in, any number may be left
    if not files:
        first = directory.select("file").first()
        return spark.read.parquet(first.file).limit(0), 0
    found = spark.read.parquet(*files)
    return (found if after is None else found.where(F.col(key) > F.lit(after))).orderBy(key).limit(n), len(files)


def finalize(rows: DataFrame, root: str, prefix: str, sequence: int, per_file: int = 1_000_000, time: str = "created_at") -> str:
    """Archive rows as `<prefix>-<sequence>.parquet` below `root`/files: written under a .tmp name, renamed, then listed in
    `root`/manifest. What breaks off in between is found by sweep()."""
    spark, name = rows.sparkSession, f"{prefix}-{sequence:06d}.parquet"
    write_archive(rows, f"{root}/files/{name}.tmp", per_file)
    source, fs = hadoop(spark, f"{root}/files/{name}.tmp")
    fs.rename(source, hadoop(spark, f"{root}/files/{name}")[0])
    list_file(spark, root, name, time)
    return name


def list_file(spark: SparkSession, root: str, name: str, time: str = "created_at") -> None:
    """The manifest's entry of an archive file."""
    found = spark.read.parquet(f"{root}/files/{name}").agg(F.count("*").alias("rows"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))
    found.select(F.lit(name).alias("file"), "*").coalesce(1).write.mode("append").json(f"{root}/manifest")


_ENTRY = "file string, rows long, min_time timestamp_ntz, max_time timestamp_ntz"


def inventory(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """(file, sequence, bytes, listed_rows, state): the folder and the manifest held against each other.

    state: `whole` (there and listed), `unlisted` (there alone), `moved` (listed alone: it went on to another store), or
    `partial` (never renamed). Torn entries of the manifest name no file and drop out; other prefixes are left alone.
    """
    name = F.regexp_extract("path", rf"/({prefix}-[0-9]+\.parquet(?:\.tmp)?)/", 1)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{root}/files")
    there = listing.select(name.alias("file"), "length").where("file <> ''").groupBy("file").agg(F.sum("length").alias("bytes"))
    entries = spark.read.schema(_ENTRY).json(f"{root}/manifest").where(F.col("file").rlike(rf"^{prefix}-[0-9]+\.parquet$")).groupBy("file").agg(F.max("rows").alias("listed_rows"))
    state = F.when(F.col("file").endswith(".tmp"), "partial").when(F.col("listed_rows").isNull(), "unlisted").when(F.col("bytes").isNull(), "moved").otherwise("whole")
    return there.join(entries, "file", "full").select("file", F.regexp_extract("file", r"-([0-9]+)\.parquet", 1).cast("long").alias("sequence"), "bytes", "listed_rows", state.alias("state"))


def sweep(spark: SparkSession, root: str, prefix: str) -> tuple[DataFrame, int]:
    """Remove partial files and list unlisted ones; the inventory as found, and the next sequence that nothing has used.

    A sequence counts as used by a file or by the manifest, which outlives the files; a partial file's can be used again.
    """
    found = materialize(inventory(spark, root, prefix), "inventory")
    for row in found.where("state in ('partial', 'unlisted')").select("file", "state").toLocalIterator():  # what one crash leaves
        if row.state == "partial":
            p, fs = hadoop(spark, f"{root}/files/{row.file}")
            fs.delete(p, True)
        else:
            list_file(spark, root, row.file)
    used = found.where("state <> 'partial'").agg(F.max("sequence")).first()[0]
    return found, (used or 0) + 1
