"""A paged source as a Spark data source: complete scans past a cap on rows a query returns.

A server answers a query of a time window in pages, in order of creation, and never with more than
``cap`` rows.  ``complete_scan`` asks again from the last time it saw, drops the rows of that instant it
already has, and refuses to go on when a window brings nothing new: an incomplete read must never look
like a complete one.  ``PagedSource`` runs one such scan per partition over disjoint windows.
"""

from __future__ import annotations

import random
import time
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Truncated(Exception):
    """The source holds rows that the scan could not reach."""


class Refused(Exception):
    """An answer that asking again will not change."""


class Busy(Exception):
    """An answer to wait for, with the seconds the server names, if any."""

    def __init__(self, after: float | None = None):
        super().__init__(after)
        self.after = after


def paced(call: Callable[[], object], attempts: int = 9, cap_s: float = 30.0, wait: Callable[[float], None] = time.sleep) -> object:
    """The answer of ``call``: waits as told, else 1, 2, 4... seconds with some noise, and gives up after ``attempts``."""
    for k in range(attempts):
        try:
            return call()
        except Busy as e:
            if k == attempts - 1:
                raise
            wait(e.after if e.after is not None else min(cap_s, 2.0**k) * random.uniform(0.9, 1.1))
    raise AssertionError


def pages(query: Callable[[str | None], tuple[list, str | None]]) -> Iterator:
    """Rows of a cursor-paged listing."""
    cursor = None
    while True:
        rows, cursor = query(cursor)
        yield from rows
        if cursor is None:
            return


class StaleCursor(Exception):
    """The server no longer knows the cursor it gave."""


def sweep(query: Callable[[str | None], tuple[list, str | None]]) -> Iterator:
    """A cursor-paged listing that begins once more from the top if the server refuses its own cursor.

    Rows may come twice then; whoever takes them de-duplicates by id.
    """
    try:
        yield from pages(query)
    except StaleCursor:
        yield from pages(query)


def in_batches(ids: Iterator, lookup: Callable[[list], dict], size: int = 90) -> Iterator[tuple]:
    """(id, record or None) of every id, looked up ``size`` at a time."""
    batch: list = []
    for i in ids:
        batch.append(i)
        if len(batch) == size:
            found = lookup(batch)
            yield from ((b, found.get(b)) for b in batch)
            batch = []
    if batch:
        found = lookup(batch)
        yield from ((b, found.get(b)) for b in batch)


def complete_scan(query: Callable[[object], list], cap: int, key: Callable, at: Callable) -> Iterator:
    """All rows of a listing that returns at most ``cap`` rows from a time on, in order of time."""
    since, edge = None, set()
    while True:
        rows = query(since)
        fresh = [r for r in rows if key(r) not in edge]
        yield from fresh
        if len(rows) < cap:
            return
        if not fresh or any(at(r) is None for r in rows):
            raise Truncated("a full window brought nothing new" if not fresh else "rows without a time cannot be windowed")
        last = at(rows[-1])
        edge = {key(r) for r in rows if at(r) == last} | (edge if last == since else set())
        since = last


class Window_(InputPartition):
    def __init__(self, lo: int, hi: int | None, fragments: list[str]):
        self.lo, self.hi, self.fragments = lo, hi, fragments


#: Rows that a window is to hold; the last one is open at its end.
WINDOW_ROWS = 1_000_000


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path, self.key, self.at = options["path"], options["key"], options["at"]
        self.cap, self.rows = int(options.get("cap", 10_000)), int(options.get("windowrows", WINDOW_ROWS))
        self.columns = [f.name for f in schema.fields]

    def _groups(self):
        """(low, high, rows, file) of every row group, from the files' footers alone; low is null without statistics."""
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq

        for file in ds.dataset(self.path).files:
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index(self.at)
            for k in range(meta.num_row_groups):
                group = meta.row_group(k)
                stats = group.column(at).statistics
                known = stats is not None and stats.has_min_max
                yield (_us(stats.min), _us(stats.max), group.num_rows, file) if known else (None, None, group.num_rows, file)

    def partitions(self):
        """Windows of time of about WINDOW_ROWS rows, cut where row groups begin and within wide ones; each knows the files it may find rows in."""
        groups = list(self._groups())
        timed = [g for g in groups if g[0] is not None]
        blind = sorted({g[3] for g in groups if g[0] is None and g[2]})
        # a row group is so many pieces of equal length in time; windows are runs of pieces
        pieces = []
        for low, high, rows, _ in timed:
            n = max(1, -(-rows // self.rows))
            pieces += [(low + (high - low) * k // n, rows // n) for k in range(n)]
        starts, held = [], 0
        for edge, rows in sorted(pieces):
            if not starts or (held + rows > self.rows and edge > starts[-1]):
                starts.append(edge)
                held = 0
            held += rows
        if not starts:
            return [Window_(-(2**63), None, blind)] if blind else []
        files: list[set[str]] = [set(blind) for _ in starts]
        for low, high, _, file in timed:
            for k in range(max(0, bisect_right(starts, low) - 1), bisect_right(starts, high)):
                files[k].add(file)
        ends = [*starts[1:], None]
        return [Window_(lo if k else -(2**63), hi, sorted(files[k])) for k, (lo, hi) in enumerate(zip(starts, ends, strict=True))]

    def read(self, partition: Window_):
        """One scan of a window, asking for at most ``cap`` rows at a time, as Arrow batches."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        if partition is None or not partition.fragments:  # Spark reads None where there are no partitions
            return
        data = ds.dataset(partition.fragments)
        type_ = data.schema.field(self.at).type
        stamp = lambda us: pa.scalar(us, pa.int64()).cast(pa.timestamp("us")).cast(type_) if pa.types.is_timestamp(type_) else pa.scalar(us, type_)
        inside = pc.field(self.at).is_valid()
        if partition.lo > -(2**63):
            inside = inside & (pc.field(self.at) >= stamp(partition.lo))
        if partition.hi is not None:
            inside = inside & (pc.field(self.at) < stamp(partition.hi))
        held = data.to_table(columns=list(dict.fromkeys([*self.columns, self.at, self.key])), filter=inside).sort_by([(self.at, "ascending"), (self.key, "ascending")])
        times = held.column(self.at).cast("int64").to_numpy()
        ids = held.column(self.key).to_pylist()

        def query(since):
            first = 0 if since is None else int(times.searchsorted(since, "left"))
            return list(range(first, min(len(ids), first + self.cap)))

        chosen = held.select(self.columns)
        some: list[int] = []
        for i in complete_scan(query, self.cap, lambda i: ids[i], lambda i: int(times[i])):
            some.append(i)
            if len(some) >= 10_000:
                yield from chosen.take(some).to_batches()
                some = []
        if some:
            yield from chosen.take(some).to_batches()


def _us(x) -> int:
    """Microseconds of a statistic of a time column."""
    import datetime as dt

    if isinstance(x, dt.datetime):
        x = x.replace(tzinfo=dt.timezone.utc) if x.tzinfo is None else x
        return round((x - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))
    return int(x)


class PagedSource(DataSource):
    """``spark.read.format("paged")`` with options path, key, at, cap, windowRows and a schema; a Parquet table stands in for the server.

    Rows without a time are in no window.
    """

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        raise ValueError("the paged source needs a schema")

    def reader(self, schema):
        return PagedReader(schema, self.options)
