"""Rows that wait in a stream until their signal has been counted often enough.

State of each signal is its counter and the list of rows that wait, in Spark's
``transformWithState``; rows whose time is over leave by event-time timers.  The
rows of one signal may be dealt to several slices, each of which counts all of the
signal's deltas, so that one signal with a large share of the rows is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Waiting(StatefulProcessor):
    def __init__(self, target: int, expire_ms: int | None):
        self.target, self.expire_ms = target, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counter = handle.getValueState("counter", "n long")
        self.rows = handle.getListState("rows", "seq long, due long, content string")

    def _count(self) -> int:
        return self.counter.get()[0] if self.counter.exists() else 0

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.rows.get()] if self.rows.exists() else []

    def _out(self, rows: list[tuple], outcome: str) -> Iterator[Row]:
        for _, _, content in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
            yield Row(content=content, outcome=outcome)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        count, fresh = self._count(), []
        for r in rows:
            if r.content is None:
                count += r.delta
            else:
                fresh.append((r.seq, r.due, r.content))
        self.counter.update((count,))
        if count >= self.target:
            yield from self._out(self._held() + fresh, "released")
            self.rows.clear()
            return
        over = []
        if self.expire_ms is not None:
            now = timerValues.getCurrentWatermarkInMs()
            over = [r for r in fresh if r[1] is not None and r[1] <= now]
            fresh = [r for r in fresh if r[1] is None or r[1] > now]
            for due in {r[1] for r in fresh if r[1] is not None}:
                self.handle.registerTimer(due)
        if fresh:
            self.rows.appendList(fresh)
        yield from self._out(over, "expired")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = self._held()
        over = [r for r in held if r[1] is not None and r[1] <= now]
        left = [r for r in held if r[1] is None or r[1] > now]
        if not over:
            return
        if left:
            self.rows.put(left)
        else:
            self.rows.clear()
        yield from self._out(over, "expired")

    def close(self) -> None:
        pass


def wait_for_count(rows: DataFrame, signals: DataFrame, signal_id: str, target: int, order: str, delta: str | None = None, ts: str | None = None, expire: str | None = None, late: str = "0 seconds", slices: int = 1) -> DataFrame:
    """Rows with ``outcome``: ``released`` once their signal's deltas add up to ``target``, ``expired`` if that took too long.

    Released and expired rows of a signal (and slice) go out by ``order``, a whole
    number.  ``delta`` names the column of ``signals`` to add, else each counts 1; a
    null delta counts 0.  With ``ts``, a column of both, and ``expire``, a row leaves
    when the watermark, which trails the largest time by ``late``, has passed its
    time by that interval; a row without a time never does.  Rows and signals of a
    null id wait for each other.  Signals stay counted after a release, so later
    rows leave at once.  Rows travel as JSON: maps' keys come back as texts.
    """
    spark = rows.sparkSession
    if (ts is None) != (expire is None):
        raise ValueError("an expiry needs the column of times, and that column an expiry")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        # the only store that keeps lists and timers; a query that runs keeps its own
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = rows.schema[signal_id].dataType
    every = F.col(ts).cast("timestamp") if ts else F.lit(None).cast("timestamp")
    slice_ = F.pmod(F.xxhash64(F.to_json(F.struct("*"))), F.lit(slices)).cast("int")
    due = F.unix_millis(every + F.expr(f"INTERVAL {expire}")) if expire else F.lit(None).cast("long")
    content = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    own = rows.select(F.col(signal_id).alias("signal"), slice_.alias("slice"), F.col(order).cast("long").alias("seq"), due.alias("due"), F.lit(0).cast("long").alias("delta"), content.alias("content"), every.alias("at"))
    added = F.coalesce(F.col(delta).cast("long"), F.lit(0)) if delta else F.lit(1).cast("long")
    told = signals.select(F.col(signal_id).cast(kind).alias("signal"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(None).cast("long").alias("seq"), F.lit(None).cast("long").alias("due"), added.alias("delta"), F.lit(None).cast("string").alias("content"), every.alias("at"))
    both = own.unionByName(told)
    if ts:
        both = both.withWatermark("at", late)
    expire_ms = 0 if expire else None
    out = both.groupBy("signal", "slice").transformWithState(_Waiting(target, expire_ms), "content string, outcome string", "Append", "EventTime" if ts else "None")
    return out.select(F.from_json("content", rows.schema).alias("r"), "outcome").select("r.*", "outcome")
