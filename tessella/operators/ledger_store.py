"""The ledger as a stored table in buckets of accounts: batches of changes are merged without moving the ledger.

A bucketed table lies as a join by account wants it, so only the changes of a batch are shuffled. Each merge writes the next
table beside the last; readers stay with the one they have.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER, MAX_ATTEMPTS
from ..storage import new_path

COLUMNS = [f.name for f in LEDGER]
#: Kinds of change that also bring in accounts that the ledger lacks, with the status that these get.
BIRTHS = {"pending": "pending", "tombstoned": "tombstoned", "parked": "unreachable"}
#: States that clear the error of attempts before.
CLEAN = ("loaded", "verified", "empty")


def _held(c: str) -> Column:
    return F.col(f"l.{c}")


def _given(c: str) -> Column:
    return F.col(f"c.{c}")


def _allowed() -> Column:
    """Whether an account's state lets the change through."""
    status, kind = _held("status"), _given("kind")
    return (
        F.when(kind == "pending", (status == "pending") & (_held("pds_host") != _given("pds_host")))
        .when(kind == "tombstoned", ~status.isin("loaded", "verified"))
        .when(kind == "parked", status == "pending")
        .when(kind == "fetching", status.isin("pending", "unreachable"))
        .when(kind.isin("loaded", "retry", "throttled", "terminal"), True)
        .otherwise(False)
    )


def merged(ledger: DataFrame, changes: DataFrame) -> DataFrame:
    """The ledger after one batch. `changes` have did, kind, and what their kind sets; the last by `seq` counts for an account.

    pending: a new account, or the host of one that is still pending. tombstoned: unless its posts are in. parked: a new or
    pending account of a dead host, out of attempts. fetching: from pending or unreachable. loaded: counts and digest, error
    and retry time cleared. retry: unreachable, one attempt more. throttled: unreachable, no attempt. terminal: the status
    given; the last error stays where none is given, and goes where all is well.
    """
    want = {f.name: f.dataType for f in LEDGER} | {"kind": "string"}
    own = [F.col(c).cast(t).alias(c) if c in changes.columns else F.lit(None).cast(t).alias(c) for c, t in want.items()]
    last = changes.groupBy("did").agg(F.max_by(F.struct(*[c for c in changes.columns if c != "did"]), "seq").alias("_c")).select("did", "_c.*").select(*own)
    kind, go = F.col("c.kind"), F.coalesce(F.col("go"), F.lit(False))
    new = _held("did").isNull()
    moved = F.col("c.kind").isin("pending", "parked")
    status = F.when(kind == "terminal", _given("status")).when(kind.isin("retry", "throttled", "parked"), "unreachable").otherwise(kind)
    kept_error = F.when(status.isin(*CLEAN), None).when(kind.isin("retry", "throttled", "parked"), _given("error")).when(kind == "terminal", F.coalesce(_given("error"), _held("error"))).otherwise(_held("error"))
    then = {
        "pds_host": F.when(moved, _given("pds_host")).otherwise(_held("pds_host")),
        "status": status,
        "attempts": F.when(kind == "parked", MAX_ATTEMPTS).when(kind == "retry", _held("attempts") + 1).otherwise(_held("attempts")),
        "retry_after": F.when(kind.isin("retry", "throttled"), _given("retry_after")).when(kind.isin("parked", "tombstoned", "loaded"), None).otherwise(_held("retry_after")),
        "error": kept_error,
    } | {c: F.when(kind == "loaded", _given(c)).otherwise(_held(c)) for c in ("posts_total", "rkey_digest", "loaded_at")}
    first = {
        "pds_host": F.when(kind == "tombstoned", "").otherwise(_given("pds_host")), "status": F.when(kind == "parked", "unreachable").otherwise(kind),
        "attempts": F.when(kind == "parked", MAX_ATTEMPTS).otherwise(0), "error": F.when(kind == "parked", _given("error")), "bucket": _given("bucket"),
    }
    joined = ledger.alias("l").join(last.alias("c"), F.col("l.did") == F.col("c.did"), "full").withColumn("go", _allowed())
    joined = joined.where(~new | kind.isin(*BIRTHS))
    value = lambda c: F.when(new, first.get(c, F.lit(None))).when(go, then.get(c, _held(c))).otherwise(_held(c)).cast(LEDGER[c].dataType)
    return joined.select(F.coalesce("l.did", "c.did").alias("did"), *[value(c).alias(c) for c in COLUMNS if c != "did"])


class LedgerStore:
    """The table's name changes with each merge; `buckets` should grow with the ledger, not with the changes."""

    def __init__(self, spark: SparkSession, ledger: DataFrame, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = self._write(ledger.select(*COLUMNS).repartition(self.buckets, "did"))

    def _write(self, df: DataFrame) -> str:
        name = f"ledger_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "did").sortBy("did").option("path", new_path(self.spark, "ledger")).saveAsTable(name)
        return name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def after(self, changes: DataFrame) -> DataFrame:
        """The plan of the next table: the ledger is scanned by bucket, the changes are dealt to its buckets."""
        return merged(self.read(), changes.repartition(self.buckets, "did"))

    def merge(self, changes: DataFrame) -> None:
        old, self.name = self.name, self._write(self.after(changes))
        self.spark.sql(f"DROP TABLE {old}")
