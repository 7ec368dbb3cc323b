"""Structured Streaming forms of the stateful operators.

Each takes and returns streaming DataFrames, or drives one to its end with
``availableNow``; the batch forms are in ``operators.analytics``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.scratch import scratch_path


def read_files(spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """New files of a folder, each once; what was read is in the query's checkpoint."""
    reader = spark.readStream.schema(schema).format(kind)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(path)


def tail_files(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files that are complete when they appear, as rolling logs are."""
    return spark.readStream.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def run_to_end(df: DataFrame, mode: str = "append", sink: Callable[[DataFrame, int], None] | None = None, checkpoint: str | None = None) -> DataFrame | None:
    """Run all that is there, to a Parquet table in the shared folder or to a sink for each micro-batch."""
    spark = df.sparkSession
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state")).trigger(availableNow=True)
    if sink is not None:
        writer.foreachBatch(sink).start().awaitTermination()
        return None
    out = scratch_path(spark, "stream-out")
    writer.format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def drop_duplicates(df: DataFrame, keys: Sequence[str], ts: str, age_off: str) -> DataFrame:
    """The first row of each key within the time that keys are remembered."""
    return df.withWatermark(ts, age_off).dropDuplicatesWithinWatermark(list(keys))


def rolling_window(df: DataFrame, key: str, ts: str, value: str, size: str, slide: str, late: str) -> DataFrame:
    """Count, sum and mean in sliding windows of each key."""
    w = df.withWatermark(ts, late).groupBy(key, F.window(ts, size, slide).alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return w.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total", "mean")


def sessions(df: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """Bins that a pause closes."""
    s = df.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def wait_for_signals(rows: DataFrame, signals: DataFrame, signal_id: str, row_ts: str, signal_ts: str, most_wait: str) -> DataFrame:
    """Rows joined with the signal of their id if it comes within a time."""
    left = rows.withWatermark(row_ts, most_wait)
    right = signals.select(F.col(signal_id).alias("__s"), F.col(signal_ts).alias("__t")).withWatermark("__t", most_wait)
    inside = (F.col(signal_id) == F.col("__s")) & (F.col("__t") >= F.col(row_ts)) & (F.col("__t") <= F.col(row_ts) + F.expr(f"INTERVAL {most_wait}"))
    return left.join(right, inside, "inner").drop("__s", "__t")


def upsert_batches(df: DataFrame, keys: Sequence[str], sequence: str, write: Callable[[DataFrame], None]) -> None:
    """Hand the last event of each key of every micro-batch to a writer."""
    columns = [c for c in df.columns if c not in keys]

    def sink(batch: DataFrame, _: int) -> None:
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(sequence)).alias("__r"))
        write(last.select(*keys, *(F.col(f"__r.{c}") for c in columns)))

    run_to_end(df, sink=sink)


def route_batches(df: DataFrame, name: str, sinks: dict[str, Callable[[DataFrame], None]]) -> None:
    """Each row of every micro-batch to the sink that its column names."""

    def sink(batch: DataFrame, _: int) -> None:
        batch.persist()
        for value, write in sinks.items():
            write(batch.filter(F.col(name) == value))
        batch.unpersist()

    run_to_end(df, sink=sink)


def enforce_order(df: DataFrame, group: str, sequence: str, value: str, first: int = 0, overtake_ms: int | None = None) -> DataFrame:
    """(group, sequence, value, outcome): rows of a group go out in sequence.

    A row that is ahead waits in the group's state; one whose number has passed
    goes out as ``late``.  After ``overtake_ms`` without what is missing the
    waiting rows go out as ``overtook`` and the sequence goes on behind them.
    """
    schema = f"{group} {dict(df.dtypes)[group]}, {sequence} long, {value} string, outcome string"
    names = [group, sequence, value, "outcome"]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected, numbers, values = state.get if state.exists else (first, [], [])
        waiting = dict(zip(numbers, values))
        out = []
        if state.hasTimedOut:
            for n in sorted(waiting):
                out.append((key[0], n, waiting[n], "overtook"))
                expected = n + 1
            waiting = {}
        for frame in frames:
            for n, v in sorted(zip(frame[sequence].tolist(), frame[value].tolist())):
                if n < expected or n in waiting:
                    out.append((key[0], n, v, "late"))
                else:
                    waiting[n] = v
        while expected in waiting:
            out.append((key[0], expected, waiting.pop(expected), "released"))
            expected += 1
        state.update((expected, list(waiting), list(waiting.values())))
        if overtake_ms and waiting:
            state.setTimeoutDuration(overtake_ms)
        yield pd.DataFrame(out, columns=names)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if overtake_ms else GroupStateTimeout.NoTimeout
    rows = df.select(group, F.col(sequence).cast("long").alias(sequence), F.col(value).cast("string").alias(value))
    return rows.groupBy(group).applyInPandasWithState(step, schema, "expected long, numbers array<long>, vals array<string>", "append", timeout)


def merge_bins(df: DataFrame, key: str, value: str, max_rows: int, max_age_ms: int | None = None, demarcator: str = "\n") -> DataFrame:
    """(key, content, n): values of a key are joined when a bin has enough rows, or is too old.

    The last bins stay open; ``merge_bins_to_end`` gives them too.
    """
    schema = f"{key} {dict(df.dtypes)[key]}, content string, n long"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        out = []
        if state.hasTimedOut and held:
            out.append((k[0], demarcator.join(held), len(held)))
            held = []
        for frame in frames:
            held += frame[value].tolist()
        while len(held) >= max_rows:
            out.append((k[0], demarcator.join(held[:max_rows]), max_rows))
            held = held[max_rows:]
        state.update((held,))
        if max_age_ms and held:
            state.setTimeoutDuration(max_age_ms)
        yield pd.DataFrame(out, columns=[key, "content", "n"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if max_age_ms else GroupStateTimeout.NoTimeout
    return df.select(key, F.col(value).cast("string").alias(value)).groupBy(key).applyInPandasWithState(step, schema, "held array<string>", "append", timeout)


def merge_bins_to_end(df: DataFrame, key: str, value: str, max_rows: int, demarcator: str = "\n") -> DataFrame:
    """All bins of what is there, full ones first; then each key's rest, read from the state that the stream leaves."""
    spark = df.sparkSession
    checkpoint = scratch_path(spark, "stream-bins")
    full = run_to_end(merge_bins(df, key, value, max_rows, demarcator=demarcator), checkpoint=checkpoint)
    left = spark.read.format("statestore").load(checkpoint).select(F.col(f"key.{key}").alias(key), F.col("value.groupState.held").alias("held"))
    rest = left.filter(F.size("held") > 0).select(key, F.array_join("held", demarcator).alias("content"), F.size("held").cast("long").alias("n"))
    return full.unionByName(rest)


def monitor_activity(df: DataFrame, key: str, inactive_ms: int) -> DataFrame:
    """(key, event): ``inactive`` when no row of a key came for a time, ``restored`` when the next one does."""
    schema = f"{key} {dict(df.dtypes)[key]}, event string"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        was_inactive = state.exists and state.get[0]
        if state.hasTimedOut:
            state.update((True,))
            yield pd.DataFrame([(k[0], "inactive")], columns=[key, "event"])
            return
        for _ in frames:
            pass
        state.update((False,))
        state.setTimeoutDuration(inactive_ms)
        if was_inactive:
            yield pd.DataFrame([(k[0], "restored")], columns=[key, "event"])

    return df.select(key).groupBy(key).applyInPandasWithState(step, schema, "inactive boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)


def count_events(df: DataFrame, name: Column, delta: Column) -> DataFrame:
    """Running counters; for the complete output mode."""
    return df.groupBy(name.alias("counter")).agg(F.sum(delta).alias("value"))
