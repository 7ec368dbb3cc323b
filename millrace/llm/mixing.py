"""Mixing sources to target weights by Pfair scheduling.

The rows of every source are dealt in blocks.  Target weights are exact
fractions that sum to 1; block k of a source of weight w may run from slot
floor(k/w) on and must run before slot ceil((k+1)/w).  Earliest deadline first
over these windows gives each slot to one source, and after any number of
slots every source has had its weight's share to within less than one block,
however long the mixture is.

Nothing sequential grows with the data: the slots are cut in segments, and
each is scheduled by itself in a Spark task.  What every source has had at a
cut is found by running the schedule from as many slots before the cut as the
longest window has, from a start in which the blocks with the earliest
deadlines are done (so no later block can miss its own).  Between two cuts
windows end at the cuts; a window over a cut lies on the side that the cut's
state says.

When a source runs out its slots stay empty and the others go on in their
proportions.  Every row gets exactly one place: none is dropped or repeated.
The work grows with the slots up to which two sources have rows left; the rest
of the last source takes the last slot of each block's window.  A weight so
small that a block may wait more than ``LONGEST_WINDOW`` slots is an error, as the
state at a cut is found by a run of that length.

Plan: a row's rank in its source is an offset by (source, bucket) plus a
row number inside the bucket.  Buckets are slices of a hash of the row, as many
for each source as give about ``BUCKET_ROWS`` rows each, so that a source with a third of all rows is
dealt over many tasks; their offsets are sums by ``COARSE`` buckets, then inside
these.  The slots of a bucket's blocks ride along with its offset.  Only one
row for each source reaches the driver.

Defined cases: a null source is a source of its own; rows that are equal in
all columns get neighbouring places in either order, null and repeated ids
included; rows of a source of weight 0 or without a target weight get no slot
(nulls), and stand last in the mixed order; weights that are negative or not
finite, or all 0, are an error; an empty table gives an empty result; texts are
not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, written

BLOCK_ROWS = 32
BUCKET_ROWS = 512
COARSE = 1024
SEGMENT_SLOTS = 4096
MAX_SOURCES = 100_000
LONGEST_WINDOW = 1 << 22


def exact_shares(weights: list[float | Fraction]) -> list[int]:
    """Integers in the exact proportion of ``weights``; a float counts as the decimal that it is written as."""
    parts = [w if isinstance(w, (Fraction, int)) else Fraction(repr(float(w))) for w in weights]
    if any(p < 0 for p in parts):
        raise ValueError("a weight is negative")
    scale = math.lcm(*(Fraction(p).denominator for p in parts))
    whole = [int(p * scale) for p in parts]
    return [w // (math.gcd(*whole) or 1) for w in whole]


class Schedule:
    """Earliest deadline first over the Pfair windows of ``shares`` (all above 0) of their sum."""

    def __init__(self, shares: list[int]):
        self.shares, self.total = shares, sum(shares)
        #: No window is longer.
        self.longest = -(-self.total // min(shares)) + 2

    def deadline(self, source: int, block: int) -> int:
        return -(-(block + 1) * self.total // self.shares[source])

    def run(self, start: int, done: list[int], stop: int, last: list[int] | None = None) -> Iterator[tuple[int, int]]:
        """(source, block) of each slot from ``start`` to ``stop``; ``done`` counts the blocks before, and is kept up to date.

        With ``last``, the blocks up to these numbers are all done at ``stop``, and no others.
        """
        waiting = [(k * self.total // a, i) for i, (k, a) in enumerate(zip(done, self.shares)) if last is None or k < last[i]]  # (release, source)
        ready: list[tuple[int, int]] = []  # (deadline, source)
        heapq.heapify(waiting)
        for slot in range(start, stop):
            while waiting and waiting[0][0] <= slot:
                _, i = heapq.heappop(waiting)
                d = self.deadline(i, done[i])
                heapq.heappush(ready, (d if last is None else min(d, stop), i))
            d, i = heapq.heappop(ready)
            if slot >= d:
                raise AssertionError("a block missed its deadline")
            yield i, done[i]
            done[i] += 1
            if last is None or done[i] < last[i]:
                heapq.heappush(waiting, (done[i] * self.total // self.shares[i], i))

    def done_at(self, slot: int) -> list[int]:
        """Blocks that each source has had before ``slot``, the same wherever it is asked for."""
        start = max(0, slot - self.longest)
        done = [start * a // self.total for a in self.shares]
        begun = [i for i, (k, a) in enumerate(zip(done, self.shares)) if k * self.total != start * a]
        for i in sorted(begun, key=lambda i: (self.deadline(i, done[i]), i))[: start - sum(done)]:
            done[i] += 1
        for _ in self.run(start, done, slot):
            pass
        return done

    def segment(self, start: int, stop: int, final: bool) -> Iterator[tuple[int, int]]:
        """(source, block) of each slot of a segment; the final one ends at no cut."""
        return self.run(start, self.done_at(start), stop, None if final else self.done_at(stop))


def source_weights(counts: Mapping[str | None, int], target: Mapping[str, float | Fraction] | None, temperature: float) -> dict[str | None, float | Fraction]:
    """The target, or else counts to the power ``temperature``."""
    if target is not None:
        return {s: target.get(s, 0) for s in counts}
    return {s: n**temperature for s, n in counts.items()}


def block_slots(spark: SparkSession, shares: list[int], blocks: list[int], segment_slots: int = SEGMENT_SLOTS) -> DataFrame:
    """(key, block, slot) of the blocks that each source has; a task for each few segments."""
    schedule = Schedule(shares)
    if schedule.longest > LONGEST_WINDOW:
        raise ValueError(f"a source's weight is below 1/{LONGEST_WINDOW} of the sum; give it more, or 0")
    ends = sorted((schedule.deadline(i, n - 1), i) for i, n in enumerate(blocks))
    slots, slowest = ends[-1]
    rest = len(ends) > 1 and ends[-2][0] + SEGMENT_SLOTS < slots
    if rest:
        # only the slowest source has blocks from here on
        slots = ends[-2][0]
    # a segment is some times as long as the run that finds the state at its ends
    size = max(segment_slots, 4 * schedule.longest if segment_slots >= SEGMENT_SLOTS else 1)
    segments = -(-slots // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in batch.column(0).to_pylist():
                start, stop = j * size, min(slots, (j + 1) * size)
                found = [(i, k, slot) for slot, (i, k) in enumerate(schedule.segment(start, stop, j == segments - 1 and not rest), start) if k < blocks[i]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.int64()))], ["key", "block", "slot"])

    out = spark.range(0, segments, 1, min(segments, 10_000)).mapInArrow(run, "key int, block long, slot long")
    if not rest:
        return out

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = pa.array([schedule.deadline(slowest, k) - 1 for k in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([slowest] * batch.num_rows, pa.int32()), batch.column(0), places], ["key", "block", "slot"])

    first, last = schedule.done_at(slots)[slowest], blocks[slowest]
    return out.union(spark.range(first, last, 1, min(10_000, 1 + (last - first) // 100_000)).mapInArrow(alone, "key int, block long, slot long"))


def mix(df: DataFrame, target: Mapping[str, float | Fraction] | None = None, temperature: float = 0.5, source: str = "source", id_column: str = "doc_id", block_rows: int = BLOCK_ROWS, bucket_rows: int = BUCKET_ROWS, segment_slots: int = SEGMENT_SLOTS) -> DataFrame:
    """``df`` with three more columns, mix_block, mix_slot and mix_place (in the block); order by slot, then place.

    If ``df`` has a column of such a name, the new one gets an underscore after it.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    added = [free_name(df, n) for n in ("mix_block", "mix_slot", "mix_place")]
    rows = df.toDF(*names)
    s, i = (F.col(names[df.columns.index(c)]) for c in (source, id_column))
    counts = {r[0]: r[1] for r in rows.groupBy(s.cast("string")).agg(F.count("*")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    everyone = sorted(counts, key=lambda n: (n is None, n or ""))
    weights = source_weights(counts, target, temperature)
    shares = dict(zip(everyone, exact_shares([weights[n] for n in everyone])))
    sources = [n for n in everyone if shares[n]]
    unplaced = rows.select(*names, *(F.lit(None).cast("long").alias(n) for n in ("block", "slot", "place")))
    if everyone and not sources:
        raise ValueError("no source has a target weight")
    if not everyone:
        return unplaced.toDF(*df.columns, *added)
    spark = df.sparkSession
    # at most MAX_SOURCES rows
    of_source = F.broadcast(spark.createDataFrame([(n, k, -(-counts[n] // bucket_rows)) for k, n in enumerate(sources)], "name string, key int, buckets long"))
    slots = block_slots(spark, [shares[n] for n in sources], [-(-counts[n] // block_rows) for n in sources], segment_slots)
    own = rows.join(of_source, s.cast("string").eqNullSafe(F.col("name")))
    own = own.withColumn("bucket", F.pmod(F.xxhash64(*names, F.lit("mix")), F.col("buckets")))

    sizes = own.groupBy("key", "bucket").agg(F.count("*").alias("n")).withColumn("coarse", F.floor(F.col("bucket") / COARSE))
    upto = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    coarse = sizes.groupBy("key", "coarse").agg(F.sum("n").alias("m")).withColumn("base", F.coalesce(F.sum("m").over(upto("key").orderBy("coarse")), F.lit(0)))
    inner = F.coalesce(F.sum("n").over(upto("key", "coarse").orderBy("bucket")), F.lit(0))
    offsets = sizes.withColumn("inner", inner).join(coarse.select("key", "coarse", "base"), ["key", "coarse"]).select("key", "bucket", "n", (F.col("base") + F.col("inner")).alias("before"))
    touched = offsets.withColumn("block", F.explode(F.sequence(F.floor(F.col("before") / block_rows), F.floor((F.col("before") + F.col("n") - 1) / block_rows))))
    of_bucket = touched.join(slots, ["key", "block"]).groupBy("key", "bucket").agg(F.first("before").alias("before"), F.sort_array(F.collect_list(F.struct("block", "slot"))).alias("of_block"))

    inside = Window.partitionBy("key", "bucket").orderBy(F.xxhash64(i, F.lit("order")), i, F.xxhash64(*names))
    ranked = own.join(of_bucket, ["key", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    placed = ranked.withColumns({"block": F.floor(F.col("rank") / block_rows).cast("long"), "place": (F.col("rank") % block_rows).cast("long")})
    slot = F.get(F.col("of_block"), (F.col("block") - F.floor(F.col("before") / block_rows)).cast("int"))["slot"]
    out = placed.select(*names, "block", slot.alias("slot"), "place")
    if len(sources) < len(everyone):
        without = spark.createDataFrame([(n,) for n in everyone if not shares[n]], "name string")
        out = out.union(unplaced.join(F.broadcast(without), s.cast("string").eqNullSafe(F.col("name")), "left_semi"))
    return out.toDF(*df.columns, *added)


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` over range partitions in the order of the mixture, without the three columns."""
    slot, place = (F.col(f"`{c}`").asc_nulls_last() for c in mixed.columns[-2:])
    return mixed.repartitionByRange(slot, place).sortWithinPartitions(slot, place).drop(*mixed.columns[-3:])


def with_position(table: DataFrame) -> DataFrame:
    """``table`` with one more column, mix_position: each row's place from 0 on in a table of ``in_mixed_order`` that was written and read again.

    A scan gives the rows in no certain order, but Spark's writer numbers files
    by partition and keeps the order in each.  What is not the plain scan of a
    table is written first.
    """
    if table._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        table = written(table, "in-order")
    names, position = [f"c{i}" for i in range(len(table.columns))], free_name(table, "mix_position")
    at = table.metadataColumn("_metadata")
    rows = table.select(*(F.col(f"`{c.replace('`', '``')}`").alias(n) for c, n in zip(table.columns, names)), at["file_name"].alias("file"), at["row_index"].alias("row"))
    sizes = {r[0]: r[1] for r in rows.groupBy("file").agg(F.count("*")).collect()}
    starts, n = [], 0
    for file in sorted(sizes, key=lambda f: (int(re.match(r"part-(\d+)", f)[1]), f)):
        starts.append((file, n))
        n += sizes[file]
    # one row for each file
    of_file = table.sparkSession.createDataFrame(starts, "file string, start long")
    return rows.join(F.broadcast(of_file), "file").select(*names, (F.col("start") + F.col("row")).alias(position)).toDF(*table.columns, position)
