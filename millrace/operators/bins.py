"""Greedy bins in order, as a fold that composes, so a key with all rows is many tasks.

In order within a key, a bin takes rows until the next one would exceed a limit:
rows, bytes, or age (seconds from its first row).  Which bins there are is a
fold over the whole key, but one that can be cut:

1. Rows are dealt in ranges of (key, order) and written, so a key of many rows
   lies in many neighbouring slices of about equal size.
2. For a slice whose key goes on from the slice before, a table is made in numpy:
   a bin that starts at row i ends before row ``after[i]``, found by binary search
   on running sums, and pointer doubling gives where the slice's last bin starts
   and how many bins start, for each row at which the first one may start.
   These are only the rows that the bin coming in can still take.
3. The tables of a key are met in order by one walk that holds one table at a
   time and carries the open bin: its rows, bytes, first time and number.
4. Each slice is folded with the bin that comes in, in batches.

A table has as many rows as the longest bin that reaches into its slice, so
the walk reads a small part of the rows if bins are short against slices; at
worst, when single bins are as long as slices, it reads two numbers of each row.

Defined cases: null keys of any type are one key; a null size is 0, as is a
negative one; a row larger than the limit is a bin of its own; rows that are equal in key
and order are put in order by a hash of all their columns but maps.  A row
without a time never closes a bin by age.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.scratch import written

#: Stands for no limit; sums stay far below it.
_FREE = 1 << 62


class _Limits:
    def __init__(self, rows: int | None, size: int | None, age: int | None):
        self.rows, self.size, self.age = rows or _FREE, size if size is not None else _FREE, age if age is not None else _FREE
        if min(self.rows, self.size + 1, self.age + 1) < 1:
            raise ValueError("a limit is negative")

    def after(self, total: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For a bin that starts at each row, the row before which it ends; ``total`` has the running sums from 0."""
        n = len(at)
        ends = np.searchsorted(total, total[:-1] + self.size, "right") - 1
        if self.rows < n:
            ends = np.minimum(ends, np.arange(n) + self.rows)
        if self.age < _FREE:
            ends = np.minimum(ends, np.searchsorted(at, at + self.age, "right"))
        return np.maximum(ends, np.arange(1, n + 1))

    def first_end(self, total: np.ndarray, at: np.ndarray, rows: int, size: int, since: int) -> int:
        """The row before which a bin that comes in with so many rows and bytes ends."""
        end = min(len(at), self.rows - rows, int(np.searchsorted(total, self.size - size, "right")) - 1)
        if self.age < _FREE:
            end = min(end, int(np.searchsorted(at, since + self.age, "right")))
        return max(end, 0)


def _last_starts(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a bin that starts at each row, where the last bin of the slice starts, and how many start."""
    n = len(after)
    last, count = np.arange(n), np.ones(n, np.int64)
    jump = after.copy()
    while (going := jump < n).any():
        to = jump[going]
        count[going] += count[to]
        last[going] = last[to]
        jump[going] = jump[to]
    return last, count


def _table(limits: _Limits):
    """A slice's table: (key and slice, sums and times of the rows that a bin coming in may take, and the state behind the slice for each of them)."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("__i")
        size, at = (group.column(c).to_numpy().astype(np.int64) for c in ("__size", "__at"))
        total = np.concatenate([[0], np.cumsum(size)])
        # a bin that comes in has a row at least
        most = limits.first_end(total, at, 1, 0, int(at[0]) if len(at) else 0)
        n = len(size)
        last, count = _last_starts(limits.after(total, at))
        last, count = last[: most + 1], count[: most + 1]
        lists = [total[: most + 2], at[: most + 1], n - last, total[n] - total[last], at[last], count]
        fields = [pa.array([int(k.as_py()) for k in key][i : i + 1], pa.int64()) for i in range(2)]
        return pa.Table.from_arrays([*fields, pa.array([n], pa.int64()), pa.array([int(total[n])], pa.int64()), *(pa.array([x], pa.list_(pa.int64())) for x in lists)], names=_TABLE)

    return run


_TABLE = ["__k", "__p", "n", "whole", "total", "at", "rows", "size", "since", "count"]


def _entries(limits: _Limits):
    """The bin that is open where each slice of a key begins, by one walk over the key's tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                k, p, n, whole = (batch.column(c)[r].as_py() for c in _TABLE[:4])
                total, at, rows, size, since, count = (batch.column(c).slice(r, 1).flatten().to_numpy() for c in _TABLE[4:])
                if k != key:
                    # the key's first slice starts a bin
                    key, e, number = k, 0, -1
                else:
                    out.append((k, p, *state))
                    number = state[3]
                    e = limits.first_end(total, at, *state[:3])
                if e >= n:
                    state = state[0] + n, state[1] + whole, state[2], number
                else:
                    state = int(rows[e]), int(size[e]), int(since[e]), number + int(count[e])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 6)], ["__k", "__q", "__rows", "__bytes", "__since", "__bin"])

    return run


def _fold(limits: _Limits, columns: list[str]):
    """Bin numbers of the rows of sorted slices, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_, state = None, None
        for batch in batches:
            n = batch.num_rows
            runs, parts, size, at = (batch.column(c).to_numpy().astype(np.int64) for c in ("__run", "__p", "__size", "__at"))
            bins = np.zeros(n, np.int64)
            cuts = np.flatnonzero((runs[1:] != runs[:-1]) | (parts[1:] != parts[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, n]):
                if n == 0:
                    break
                if (parts[a], runs[a]) != slice_:
                    slice_ = parts[a], runs[a]
                    entry = [batch.column(c)[int(a)].as_py() for c in ("__rows", "__bytes", "__since", "__bin")]
                    state = None if entry[0] is None else entry
                total, times = np.concatenate([[0], np.cumsum(size[a:b])]), at[a:b]
                e = limits.first_end(total, times, *state[:3]) if state else 0
                if state:
                    bins[a : a + e] = state[3]
                if e >= b - a:
                    state = [state[0] + e, state[1] + int(total[-1]), state[2], state[3]]
                    continue
                after, number, start = limits.after(total, times), state[3] if state else -1, e
                while start < b - a:
                    number, stop = number + 1, int(after[start])
                    bins[a + start : a + stop] = number
                    last, start = start, stop
                state = [b - a - last, int(total[-1] - total[last]), int(times[last]), number]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(bins)], [*columns, "bin"])

    return run


def merge_bins(df: DataFrame, key: str, order: Sequence[str], max_rows: int | None, max_bytes: int | None, size: Column, ts: str | None = None, max_age: float | None = None) -> DataFrame:
    """Adds ``bin``, from 0 in each key: in order, a bin closes before it would exceed a limit.

    With ``ts`` and ``max_age`` seconds, rows are in order of time first, and
    a bin closes before a row that comes later after its first row than that.
    """
    if (ts is None) != (max_age is None):
        raise ValueError("an age needs the column of times, and the column an age")
    limits = _Limits(max_rows, max_bytes, None if max_age is None else round(max_age * 1_000_000))
    columns = df.columns
    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(1 << 61))) if ts else F.lit(0).cast("long")
    tie = F.xxhash64(*(c for c, t in df.dtypes if "map<" not in t))
    sized = df.withColumns({"__size": F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)), "__at": at, "__tie": tie})
    by = [F.col(key), *(["__at"] if ts else []), *order, "__tie"]
    parts = sized.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__p": F.spark_partition_id().cast("long"), "__i": F.monotonically_increasing_id()}).drop("__tie")
    parts = written(parts, "bin-slices")
    # a key is named by its first row; one with a single slice needs no table
    slices = parts.groupBy(F.col(key).alias("__key"), "__p").agg(F.min("__i").alias("__run"))
    keys = slices.groupBy(F.col("__key").alias("__of")).agg(F.min("__run").alias("__k"), F.count("*").alias("__n")).filter("__n > 1")
    spans = written(slices.join(keys, F.col("__key").eqNullSafe(F.col("__of"))).select("__key", F.col("__p").alias("__q"), "__k"), "bin-spans")
    mine = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__p") == F.col("__q"))
    rows = parts.join(spans, mine).select("__k", "__p", "__i", "__size", "__at")
    tables = rows.groupBy("__k", "__p").applyInArrow(_table(limits), "__k long, __p long, n long, whole long, total array<long>, at array<long>, rows array<long>, size array<long>, since array<long>, count array<long>")
    walked = tables.repartition("__k").sortWithinPartitions("__k", "__p").mapInArrow(_entries(limits), "__k long, __q long, __rows long, __bytes long, __since long, __bin long")
    coming = spans.join(written(walked, "bin-entries"), ["__k", "__q"]).select("__key", "__q", "__rows", "__bytes", "__since", "__bin")
    runs = parts.join(coming, mine, "left").drop("__key", "__q")
    sorted_ = runs.repartition("__p").sortWithinPartitions("__p", "__i")
    # neighbours of one key have one hash, zeros of either sign too
    own = F.col(key) + F.lit(0.0) if dict(df.dtypes)[key] in ("float", "double") else F.col(key)
    keyed = sorted_.withColumn("__run", F.xxhash64(own, own.isNull()))
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return keyed.mapInArrow(_fold(limits, columns), f"{fields}, bin long")


def bin_states(binned: DataFrame, key: str, size: Column, min_rows: int = 1, min_bytes: int = 0, ts: str | None = None, max_age: float | None = None, now: Column | None = None) -> DataFrame:
    """(key, bin, n, bytes, state) of the bins of ``merge_bins``.

    ``closed`` if the key has a later bin; of each key's last one ``enough`` if it
    reaches both minima, ``expired`` if it does not and its first row is older than
    ``max_age`` seconds at ``now``, and ``waiting`` otherwise.
    """
    bins = binned.groupBy(F.col(key).alias("__key"), "bin").agg(F.count("*").alias("n"), F.sum(F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))).alias("bytes"), *([F.min(ts).alias("__first")] if ts else []))
    last = bins.groupBy(F.col("__key").alias("__of")).agg(F.max("bin").alias("__last"))
    old = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("__first").cast("timestamp")) > round(max_age * 1_000_000)) if ts and max_age is not None and now is not None else F.lit(False)
    state = F.when(F.col("bin") < F.col("__last"), "closed").when((F.col("n") >= min_rows) & (F.col("bytes") >= min_bytes), "enough").when(F.coalesce(old, F.lit(False)), "expired").otherwise("waiting")
    return bins.join(last, F.col("__key").eqNullSafe(F.col("__of"))).select(F.col("__key").alias(key), "bin", "n", "bytes", state.alias("state"))
