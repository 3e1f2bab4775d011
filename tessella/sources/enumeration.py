"""Paged enumeration with a cursor: a page and the cursor behind it are one commit, so a stop loses and doubles nothing.

Operations carry a sequence that grows. A run starts some way before the stored cursor, as sources may deliver late around a
stop; the overlap is read again and, like every repeated operation, counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.snapshots import Part, Snapshot, SnapshotLog, Table
from ..schemas import REWIND_SECONDS


def rewound(cursor: int | None, by: int = REWIND_SECONDS * 1_000_000) -> int | None:
    """Where to start again: some way before the cursor (microseconds by default), from the start without one."""
    return None if cursor is None else cursor - by


def enumerate_pages(log: SnapshotLog, page: Callable[[int | None], DataFrame], source: str, seq: str = "seq", overlap: int = 0, most: int | None = None) -> int:
    """Read pages until an empty one, or `most` of them; the number of pages committed.

    `page` gives the operations after a cursor, a bounded number of them. If another run moves the cursor meanwhile, its
    page stands and this one's is read again from there.
    """
    cursor, done = rewound(log.latest().cursors.get(source), overlap), 0
    while most is None or done < most:
        path = log.write(page(cursor), source)
        end = log.spark.read.parquet(path).agg(F.max(seq)).first()[0]
        if end is None:
            return done
        before = log.latest().cursors.get(source)

        def change(now: Snapshot, path=path, end=end, before=before) -> Snapshot | None:
            if now.cursors.get(source) != before:
                return None
            at = now.version + 1
            table = Table((*now.table(source).parts, Part(path, at, at)))
            return now.with_tables({source: table}).with_cursor(source, max(end, before) if before is not None else end)

        if log.commit(change) is None:
            cursor = log.latest().cursors.get(source)
            continue
        cursor, done = end, done + 1
    return done


def operations(log: SnapshotLog, source: str) -> DataFrame:
    """All operations of committed pages, overlaps included."""
    return log.spark.read.parquet(*[part.path for part in log.latest().table(source).parts])
