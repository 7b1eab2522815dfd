"""A growing log of JSON lines as a stream: offsets are bytes, so lines appended to a file that was read are seen.

``spark.readStream.format("tail")`` with the option ``path`` (a file on a file system that all executors
mount) gives ``at`` (the byte a line begins at) and ``value``.  A last line without its end is held until it
has one.  Where reading stands is kept in the query's checkpoint: after a restart the batch that had not been
committed is read again, byte for byte.

A log is rotated by one rename, to the next number.  An offset names the number of renames before it, so
what was not read yet of a file that was put aside is read there, and the new file from its beginning.  An
offset beyond the end of its file is set to the end, and the jump is logged.

A batch is cut into partitions of ``split`` bytes; each begins at the first line that starts in it.
"""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

log = logging.getLogger(__name__)
SCHEMA = "at bigint, value string"
SPLIT = 64 << 20
#: A log is rotated from this size on, and so many segments are kept.
ROTATE_AT, SEGMENTS = 32 << 20, 3


class Span(InputPartition):
    def __init__(self, turn: int, low: int, high: int, start: int):
        self.turn, self.low, self.high, self.start = turn, low, high, start


def turns(path: str) -> list[int]:
    """Numbers of the segments that were put aside and are still there, ascending."""
    folder, name = os.path.split(path)
    try:
        names = os.listdir(folder or ".")
    except OSError:
        return []
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(re.escape(name) + r"\.(\d{6})", n)))


def file_of(path: str, turn: int) -> str | None:
    """The file that was the log after ``turn`` renames; None if it is gone."""
    aside = f"{path}.{turn + 1:06d}"
    if os.path.exists(aside):
        return aside
    there = turns(path)
    return path if not there or there[-1] <= turn else None


def whole_lines(path: str) -> int:
    """The offset behind the last line of a file that has its end; 0 if there is no file."""
    try:
        size = os.path.getsize(path)
    except OSError:
        return 0
    with open(path, "rb") as f:
        at = size
        while at:
            begin = max(0, at - 65_536)
            f.seek(begin)
            cut = f.read(at - begin).rfind(b"\n")
            if cut >= 0:
                return begin + cut + 1
            at = begin
    return 0


def read_span(path: str, low: int, high: int, start: int) -> Iterator[tuple[int, str]]:
    """(offset, line) of the lines that begin from ``low`` on and before ``high``; ``start`` is known to be a line's beginning."""
    with open(path, "rb") as f:
        if low > start:
            f.seek(low - 1)
            f.readline()  # what is left of a line that began before
        else:
            f.seek(low)
        at = f.tell()
        while at < high:
            line = f.readline()
            if not line.endswith(b"\n"):
                return
            yield at, line[:-1].decode("utf-8", "replace")
            at += len(line)


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("split", SPLIT))
        self.first = int(options.get("startat", 0))

    def initialOffset(self) -> dict:
        there = turns(self.path)
        return {"turn": there[0] - 1 if there else 0, "at": self.first}

    def latestOffset(self) -> dict:
        while True:
            turn = (turns(self.path) or [0])[-1]
            at = whole_lines(self.path)
            if (turns(self.path) or [0])[-1] == turn:  # else the log was rotated between the two looks
                return {"turn": turn, "at": at}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        out = []
        for turn in range(int(start["turn"]), int(end["turn"]) + 1):
            low = int(start["at"]) if turn == start["turn"] else 0
            file = file_of(self.path, turn)
            if file is None:
                log.warning("%s: segment %d is gone", self.path, turn + 1)
                continue
            high = int(end["at"]) if turn == end["turn"] else whole_lines(file)
            if low > high:
                log.warning("%s: offset %d lies beyond the end %d; going on from there", file, low, high)
            out += [Span(turn, a, min(high, a + self.split), low) for a in range(low, high, self.split)]
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        ats: list[int] = []
        values: list[str] = []
        file = file_of(self.path, partition.turn)
        for at, line in read_span(file, partition.low, partition.high, partition.start) if file else ():
            ats.append(at)
            values.append(line)
            if len(ats) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(values, pa.string())], ["at", "value"])
                ats, values = [], []
        if ats:
            yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(values, pa.string())], ["at", "value"])

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    """``spark.dataSource.register(TailSource)``; then ``format("tail")`` with the options path, split, startat."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def segments(path: str) -> list[str]:
    """The files of a rotated log, oldest first."""
    return [*(f"{path}.{n:06d}" for n in turns(path)), *([path] if os.path.exists(path) else [])]


def rotate(path: str, drained: int, limit: int = ROTATE_AT, keep: int = SEGMENTS) -> bool:
    """Put a log aside once it has ``limit`` bytes and was read to its end (``drained``); True if it was.

    A log that is behind, or whose last line has no end, stays.  The oldest segments beyond ``keep`` are removed.
    """
    if not os.path.exists(path) or os.path.getsize(path) < limit or drained != os.path.getsize(path) or whole_lines(path) != drained:
        return False
    there = turns(path)
    os.rename(path, f"{path}.{(there[-1] if there else 0) + 1:06d}")
    for n in turns(path)[:-keep]:
        os.remove(f"{path}.{n:06d}")
    return True
