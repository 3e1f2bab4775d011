"""Stored rollups: deltas appended by batch, read as sums, merged by level, rebuilt whole or from an hour on.

All tables, the posts among them, live in one snapshot log. A batch brings its posts and the deltas of every rollup in one
commit, and only once. A rebuild or repair reads one state, writes its parts at leisure, and in its commit replaces what
that state had: batches that came in meanwhile keep their own deltas, so none is lost and none counts twice. If parts from
before and after that state have been merged in the meantime, the work is done again from the newer state.
"""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hour_of
from ..schemas import POSTS, empty
from ..storage import discard, materialize
from .aggregates import SPECS, Spec
from .posts import posts_final
from .snapshots import Part, Snapshot, SnapshotLog, Table

#: Parts of one level that are merged into one of the next.
FANOUT = 8


@dataclass(frozen=True)
class Pending:
    """New parts that stand for everything up to commit `base`; `needs` are parts that must still be live."""

    base: int
    paths: dict[str, str]
    needs: frozenset[str] = frozenset()


class RollupStore:
    def __init__(self, spark: SparkSession, root: str, specs: dict[str, Spec] | None = None):
        self.spark, self.log, self.specs = spark, SnapshotLog(spark, root), SPECS if specs is None else specs

    # ---- reading

    def rows(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        paths = [part.path for part in (at or self.log.latest()).table(name).parts]
        return self.spark.read.parquet(*paths) if paths else None

    def posts(self, at: Snapshot | None = None) -> DataFrame:
        found = self.rows("posts", at)
        return empty(self.spark, POSTS) if found is None else found

    def read(self, name: str, at: Snapshot | None = None) -> DataFrame:
        spec, found = self.specs[name], self.rows(name, at)
        return spec.summed(spec.select(empty(self.spark, POSTS)) if found is None else found)

    def applied(self, batch: int | str) -> bool:
        return self.log.latest().has(batch)

    # ---- batches

    def _write(self, frames: dict[str, DataFrame]) -> dict[str, str]:
        """One folder each, several at a time: they are small and share no input but the posts."""
        with ThreadPoolExecutor(4) as pool:
            return dict(zip(frames, pool.map(lambda name: self.log.write(frames[name], name), frames), strict=True))

    def append(self, posts: DataFrame, batch: int | str, stored: str | None = None) -> bool:
        """Add a batch to the posts and its deltas to every rollup; False if it is there already.

        `stored` names a folder that holds the posts; else they are written here.
        """
        if self.applied(batch):
            return False
        paths = {"posts": stored or self.log.write(posts, "posts")}
        rows = self.spark.read.parquet(paths["posts"])
        paths |= self._write({name: spec.select(rows) for name, spec in self.specs.items()})

        def change(now: Snapshot) -> Snapshot | None:
            if now.has(batch):
                return None
            at = now.version + 1
            tables = {name: self._table(now, name, (*now.table(name).parts, Part(path, at, at))) for name, path in paths.items()}
            return now.with_tables(tables).with_batch(batch)

        return self.log.commit(change) is not None

    def _table(self, now: Snapshot, name: str, parts: tuple[Part, ...]) -> Table:
        """A table's next state. Rows of another definition make it dirty until it is rebuilt."""
        old, spec = now.table(name), self.specs[name].version() if name in self.specs else ""
        return Table(parts, spec, old.dirty or bool(old.parts) and old.spec != spec)

    # ---- definitions

    def drifted(self, spec: Spec) -> bool:
        """Whether the stored table was built by another definition."""
        stored = self.log.latest().table(spec.name).spec
        return bool(stored) and stored != spec.version()

    def migrate(self) -> dict[str, str]:
        """Bring every table to its definition: `created`, `current`, or `drifted`, which leaves it dirty until a rebuild."""
        found: dict[str, str] = {}

        def change(now: Snapshot) -> Snapshot:
            tables = {}
            for name, spec in self.specs.items():
                old = now.table(name)
                found[name] = "created" if name not in now.tables else "current" if old.spec == spec.version() else "drifted"
                tables[name] = self._table(now, name, old.parts)
            return now.with_tables(tables)

        self.log.commit(change)
        return found

    def dirty(self) -> list[str]:
        return sorted(name for name, table in self.log.latest().tables.items() if table.dirty)

    # ---- rebuild and repair

    def prepare_rebuild(self, posts: DataFrame | None = None) -> Pending:
        """Every rollup from the last versions of all posts of the newest state, or of those given."""
        base = self.log.latest()
        final = materialize(posts_final(self.posts(base) if posts is None else posts).drop("text"), "posts-final")
        paths = self._write({name: spec.select(final) for name, spec in self.specs.items()})
        discard(final)
        return Pending(base.version, paths)

    def prepare_repair(self, posts: DataFrame | None, cutoff) -> Pending:
        """Rollups by time from `cutoff` (hour-aligned) on; totals have no time and need a rebuild."""
        base = self.log.latest()
        final = materialize(posts_final(self.posts(base) if posts is None else posts).drop("text"), "posts-final")
        own = {name: spec for name, spec in self.specs.items() if spec.time}
        paths = self._write({name: repaired(spec, self.read(name, base), final, cutoff) for name, spec in own.items()})
        discard(final)
        return Pending(base.version, paths, frozenset(part.path for name in own for part in base.table(name).parts))

    def commit(self, pending: Pending) -> bool:
        """Put pending parts in place of what they stand for; False if the state has moved so that they no longer can."""

        def change(now: Snapshot) -> Snapshot | None:
            tables, live = {}, {part.path for t in now.tables.values() for part in t.parts}
            if not pending.needs <= live:
                return None
            for name, path in pending.paths.items():
                after = [part for part in now.table(name).parts if part.last > pending.base]
                if any(part.first <= pending.base for part in after):
                    return None
                whole = not pending.needs  # a rebuild leaves no row of an older definition
                table = self._table(now, name, (Part(path, 0, pending.base, 1), *after))
                tables[name] = Table(table.parts, table.spec, table.dirty and not whole)
            return now.with_tables(tables)

        return self.log.commit(change) is not None

    def rebuild(self, posts: DataFrame | None = None, tries: int = 10) -> None:
        self._until_in(lambda: self.prepare_rebuild(posts), tries)

    def repair(self, posts: DataFrame | None, cutoff, tries: int = 10) -> None:
        self._until_in(lambda: self.prepare_repair(posts, cutoff), tries)

    def _until_in(self, prepare, tries: int) -> None:
        for _ in range(tries):
            if self.commit(prepare()):
                return
        raise RuntimeError(f"parts were merged under {tries} attempts")

    # ---- merging

    def compact(self, fanout: int = FANOUT) -> int:
        """Merge `fanout` parts of a level into one of the next, as long as any level has so many; the number of merges.

        Each batch is merged once a level, and a table of n batches keeps fewer than `fanout` parts on each of log(n) levels.
        """
        merges = 0
        while True:
            now, due = self.log.latest(), {}
            for name in self.specs:
                parts = sorted(now.table(name).parts, key=lambda p: p.first)
                counts = Counter(p.level for p in parts)
                level = min((k for k, n in counts.items() if n >= fanout), default=None)
                if level is not None:
                    due[name] = [p for p in parts if p.level == level][:fanout]
            if not due:
                return merges
            paths = self._write({name: self.specs[name].summed(self.spark.read.parquet(*[p.path for p in parts])) for name, parts in due.items()})

            def change(now: Snapshot, due=due, paths=paths) -> Snapshot | None:
                tables = {}
                for name, parts in due.items():
                    table = now.table(name)
                    if set(parts) <= set(table.parts):  # else a rebuild has replaced them
                        merged = Part(paths[name], min(p.first for p in parts), max(p.last for p in parts), parts[0].level + 1)
                        tables[name] = Table((*[p for p in table.parts if p not in parts], merged), table.spec, table.dirty)
                return now.with_tables(tables) if tables else None

            merges += len(due) if self.log.commit(change) else 0

    def parts(self) -> dict[str, int]:
        return {name: len(table.parts) for name, table in self.log.latest().tables.items()}


def repaired(spec: Spec, stored: DataFrame, posts: DataFrame, cutoff) -> DataFrame:
    """Stored rows before the cutoff and fresh ones from it on."""
    at = F.date_trunc("hour", F.lit(cutoff) if not hasattr(cutoff, "alias") else cutoff).cast("timestamp_ntz")
    fresh = spec.select(posts).where(F.col(spec.time) >= at)
    return stored.where(F.col(spec.time) < at).unionByName(fresh)


def compare_measures(spec: Spec, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row a measure: its sum before, after, and the difference."""
    def sums(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in spec.measures])
        return row.unpivot([], list(spec.measures), "measure", name)

    joined = sums(before, "before").join(sums(after, "after"), "measure")
    return joined.withColumn("delta", F.col("after") - F.col("before"))


def aligned_cutoff(as_of, days: int):
    return hour_of(as_of - F.expr(f"INTERVAL {days} DAYS"))
