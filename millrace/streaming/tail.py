"""A streaming source of the lines of files that grow and roll over.

``tail_growing`` reads complete lines as they are appended.  An offset is a
snapshot of the files: for each its place behind the last complete line, hashes of
its first bytes at several lengths, and one of the bytes before that place.  What a
micro-batch reads follows from two snapshots alone, so it is the same after a
restart from the checkpoint:

* a file whose first bytes, and those before the old place, are as before goes
  on from the old place;
* a file that is smaller, or begins otherwise, is new and read from its start;
* a new name whose first bytes are those of a file that has left its own name is
  that file, rolled over, and goes on from its place.

A partial last line is held back until its line end comes.  A file that rolled over
after it was planned is found by its first bytes.

Files are opened by path, so driver and executors have to mount the folder.
Known limits: a file that is cut and grows past its old place with the same bytes
between two looks is not told from one that only grew; of files that leave the
pattern unread lines are lost.  Lines are UTF-8; bytes that are not are replaced.
"""

from __future__ import annotations

import glob
import hashlib
import os
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Lengths of a file's beginning that are hashed, and bytes before a place.
HEADS = (16, 64, 256, 1024)
BEFORE = 256
#: Bytes of one task's part of a file, at most about.
PART_BYTES = 64 << 20
_LOOK = 1 << 16


def _hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()[:16]


def _line_end(file, size: int) -> int:
    """The place behind the last line end before ``size``."""
    at = size
    while at > 0:
        start = max(0, at - _LOOK)
        file.seek(start)
        found = file.read(at - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return 0


def _before(path: str, at: int) -> str | None:
    with open(path, "rb") as file:
        file.seek(max(0, at - BEFORE))
        data = file.read(min(at, BEFORE))
    return _hash(data) if len(data) == min(at, BEFORE) else None


def _look(path: str) -> dict | None:
    """A file's part of a snapshot, or None if it has no complete line."""
    try:
        with open(path, "rb") as file:
            end = _line_end(file, os.fstat(file.fileno()).st_size)
            if not end:
                return None
            file.seek(0)
            head = file.read(min(end, HEADS[-1]))
        return {"end": end, "heads": {str(n): _hash(head[:n]) for n in {*(h for h in HEADS if h <= end), min(end, HEADS[-1])}}, "before": _before(path, end)}
    except FileNotFoundError:
        return None


def _begins_like(path: str, old: dict) -> bool:
    """Whether the file begins as the old one did, at the greatest length that is known of it."""
    n = max(map(int, old["heads"]))
    try:
        with open(path, "rb") as file:
            head = file.read(n)
        return len(head) == n and _hash(head) == old["heads"][str(n)]
    except FileNotFoundError:
        return False


def _goes_on(path: str, now: dict, old: dict) -> bool:
    return now["end"] >= old["end"] and _begins_like(path, old) and _before(path, old["end"]) == old["before"]


class _Part(InputPartition):
    def __init__(self, path: str, pattern: str, look: dict, start: int, end: int):
        self.path, self.pattern, self.look, self.start, self.end = path, pattern, look, start, end


class _Reader(DataSourceStreamReader):
    def __init__(self, pattern: str):
        self.pattern = pattern

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {p: look for p in sorted(glob.glob(self.pattern)) if os.path.isfile(p) and (look := _look(p))}

    def _where(self, path: str, look: dict) -> str | None:
        """Where the file of a snapshot is by now."""
        for p in [path, *sorted(glob.glob(self.pattern))]:
            if _begins_like(p, look) and os.path.getsize(p) >= look["end"] and _before(p, look["end"]) == look["before"]:
                return p
        return None

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        parts: list[InputPartition] = []
        where = {p: self._where(p, look) or p for p, look in end.items()}
        stayed = {p for p in end if p in start and os.path.exists(where[p]) and _goes_on(where[p], end[p], start[p])}
        left = {p: old for p, old in start.items() if p not in stayed}
        for path, look in end.items():
            at = 0
            if path in stayed:
                at = start[path]["end"]
            elif os.path.exists(where[path]):
                rolled = next((p for p, old in left.items() if _goes_on(where[path], look, old)), None)
                at = left.pop(rolled)["end"] if rolled else 0
            parts += [_Part(path, self.pattern, look, a, min(a + PART_BYTES, look["end"])) for a in range(at, look["end"], PART_BYTES)]
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        """The lines that begin in the part."""
        path = self._where(partition.path, partition.look)
        if path is None:
            raise FileNotFoundError(f"{partition.path} is gone with lines that were not read")
        with open(path, "rb") as file:
            at = partition.start
            if at:
                file.seek(at - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(0)
            while at < partition.end:
                line = file.readline()
                yield partition.path, at, line.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace")
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    """``spark.readStream.format("growing_lines").option("path", a glob)``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "file string, offset long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"])


def tail_growing(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, offset, value): each complete line of the files once; ``file`` is the name under which it was seen, ``offset`` its first byte."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("growing_lines").option("path", pattern).load()
