"""Aggregation, windows, history, trends, status facts, lineage, change tracking."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.links import group_status, lineage
from millrace.scratch import written

__all__ = ["group_status", "lineage"]


#: Rows up to which a page is the end of a sorted limit.
TOP_ROWS = 100_000


def _micros(c: Column) -> Column:
    """Microseconds of a time, with or without a zone."""
    return F.unix_micros(c.cast("timestamp"))


def group_aggregates(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], having: Column | None = None, how: str = "group") -> DataFrame:
    """``how``: group, rollup or cube."""
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[how](*keys)
    out = grouped.agg(*(c.alias(n) for n, c in aggregates.items()))
    return out.filter(having) if having is not None else out


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Row numbers from 1 within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def pages(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Adds page and place in the page, over a total order."""
    from millrace.operators.records import split_record

    return split_record(df, order, size).withColumnsRenamed({"fragment_index": "page", "row_in_fragment": "place"})


def page(df: DataFrame, order: Sequence[str], size: int, number: int) -> DataFrame:
    """One page, from 0.  Pages far from the start are found by row numbers, as a sorted limit meets in one task."""
    from millrace.operators.records import numbered

    if (number + 1) * size <= TOP_ROWS:
        return df.orderBy(*order).offset(number * size).limit(size)
    at = F.col("__place")
    return numbered(df, order, "__place").filter((at >= number * size) & (at < (number + 1) * size)).drop("__place")


def query_with_aggregations(df: DataFrame, predicate: Column, aggregations: dict[str, tuple[str, Column]], order: Sequence[str | Column], hits: int) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(first ``hits`` rows, a table for each named aggregation: key and value), all over one filter."""
    base = df.filter(predicate)
    return base.orderBy(*order).limit(hits), {n: base.groupBy(k).agg(c.alias(n)) for n, (k, c) in aggregations.items()}


def update_by_query(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({n: F.when(hit, v).otherwise(F.col(n)) for n, v in values.items()})


def delete_by_query(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    if n < 0:
        raise ValueError("the limit is negative")
    return df.limit(n)


def prioritized(df: DataFrame, kind: str, attribute: str | None = None, arrival: str = "ts", tie: str = "id") -> DataFrame:
    """Order of consumption: by ``attribute`` (whole numbers first, by value), ``oldest``, ``newest`` or ``arrival``."""
    if kind == "attribute":
        number = F.col(attribute).cast("string").try_cast("long")
        return df.orderBy(number.asc_nulls_last(), F.col(attribute).asc_nulls_last(), arrival, tie)
    return df.orderBy(F.col(arrival).desc() if kind == "newest" else F.col(arrival).asc(), tie)


def rolling_bins(df: DataFrame, key: str, ts: str, value: str, bin_seconds: int, bins: int) -> DataFrame:
    """Sums by time bin, and over the last ``bins`` bins up to each; empty bins count as 0."""
    start = (F.floor(F.unix_timestamp(ts) / bin_seconds) * bin_seconds).cast("long")
    sums = df.groupBy(key, start.alias("bin")).agg(F.sum(value).alias("total"), F.count("*").alias("n"))
    w = Window.partitionBy(key).orderBy("bin").rangeBetween(-(bins - 1) * bin_seconds, 0)
    return sums.withColumns({"rolling_total": F.sum("total").over(w), "rolling_n": F.sum("n").over(w)})


def snapshot_history(df: DataFrame, key: str, ts: str, most: int, not_before: str | None = None, tie: str | None = None) -> DataFrame:
    """The newest ``most`` snapshots of each key, none before a date; of those at one time the largest ``tie``, or any fixed one."""
    kept = df.filter(F.col(ts) >= F.lit(not_before).cast("timestamp")) if not_before else df
    return kept.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), F.desc(tie) if tie else F.xxhash64(*df.columns)))).filter(F.col("__n") <= most).drop("__n")


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least squares of each key: slope, intercept, r2, adjusted_r2, residual sum and mean square error."""
    n = F.count("*")
    rss = F.regr_syy(y, x) * (1 - F.regr_r2(y, x))
    return df.groupBy(*keys).agg(
        n.alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.when(n > 2, 1 - (1 - F.regr_r2(y, x)) * (n - 1) / (n - 2)).alias("adjusted_r2"), rss.alias("residual_sum"), F.when(n > 2, rss / (n - 2)).alias("mean_square_error"),
    )


def predict_y(x: Column) -> Column:
    """On a trend's row."""
    return F.col("intercept") + F.col("slope") * x


def predict_x(y: Column) -> Column:
    return F.when(F.col("slope") != 0, (y - F.col("intercept")) / F.col("slope"))


def backpressure_prediction(df: DataFrame, key: str, ts: str, queued: str, threshold: float, horizon: float) -> DataFrame:
    """Of each key: the amount predicted ``horizon`` seconds after its last row, its percent of the threshold, and
    the seconds until the threshold is reached; -1 if the trend does not rise to it."""
    t = df.withColumn("__x", F.col(ts).cast("timestamp").cast("double")).withColumn("__y", F.col(queued).cast("double"))
    trend = linear_trend(t, [key], "__x", "__y").join(t.groupBy(key).agg(F.max("__x").alias("__last")), key)
    amount = F.greatest(predict_y(F.col("__last") + horizon), F.lit(0.0))
    wait = F.when(F.col("slope") > 0, predict_x(F.lit(float(threshold))) - F.col("__last"))
    return trend.select(key, amount.alias("predicted"), F.least(F.round(amount / threshold * 100), F.lit(100.0)).cast("int").alias("predicted_percent"), F.coalesce(F.when(wait >= 0, F.round(wait)), F.lit(-1.0)).cast("long").alias("seconds_to_threshold"))


def connection_status(df: DataFrame, count: str, size: str, count_limit: str, size_limit: str) -> DataFrame:
    """Adds is_back_pressure_enabled: a limit above 0 is reached."""
    hit = lambda limit, value: F.coalesce((F.col(limit) > 0) & (F.col(limit) <= F.col(value)), F.lit(False))
    return df.withColumn("is_back_pressure_enabled", hit(count_limit, count) | hit(size_limit, size))


def processor_status(groups: DataFrame, group_id: str, processors: str) -> DataFrame:
    """A row for each processor in the nested lists of groups."""
    return groups.select(F.col(group_id).alias("group_id"), F.explode(processors).alias("__p")).select("group_id", "__p.*")


def bulletins(df: DataFrame, levels: Sequence[str], since: str | None = None, until: str | None = None) -> DataFrame:
    """Log rows (ts, level, category, message, source) of some levels and a time range [since, until)."""
    out = df.filter(F.col("level").isin(*levels))
    out = out.filter(F.col("ts") >= F.lit(since).cast("timestamp")) if since else out
    return out.filter(F.col("ts") < F.lit(until).cast("timestamp")) if until else out


def query_since_last_run(spark: SparkSession, sql: str, state: str, name: str, now: str, path: str | None = None) -> DataFrame:
    """SQL with :start and :end bound to the end of the last run and to ``now``, which is then stored.

    ``state`` is a table (name, at), a row for each run; no row means from the
    beginning.  ``path`` is where the table lies, else the warehouse.
    """
    last = "1970-01-01 00:00:00"
    if spark.catalog.tableExists(state):
        last = spark.table(state).filter(F.col("name") == name).agg(F.max("at")).first()[0] or last
    out = spark.sql(sql, args={"start": last, "end": now})
    writer = spark.createDataFrame([(name, now)], "name string, at string").write.mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(state)
    return out


def metrics_to_actions(metrics: DataFrame, rules: Sequence[tuple[str, int, Column, str]], handlers: dict[str, Callable[[DataFrame], None]]) -> DataFrame:
    """Fire rules on metric rows and hand each action's rows to its handler; returns what fired."""
    from millrace.operators.records import rules_engine

    fired = written(rules_engine(metrics, rules), "fired")
    for action, handle in handlers.items():
        handle(fired.filter(F.col("action") == action))
    return fired


def filter_provenance(df: DataFrame, include: dict[str, object] | None = None, exclude: dict[str, object] | None = None) -> DataFrame:
    """Events by component_type and component_name (patterns over the whole text), event_type and component_id (lists)."""

    def tests(spec: dict[str, object]) -> list[Column]:
        out = []
        for field, value in spec.items():
            c = F.col(field)
            out.append(F.coalesce(c.rlike(rf"\A(?:{value})\z") if isinstance(value, str) else c.isin(*value), F.lit(False)))
        return out

    for t in tests(include or {}):
        df = df.filter(t)
    for t in tests(exclude or {}):
        df = df.filter(~t)
    return df


def set_operation(a: DataFrame, b: DataFrame, how: str, all_: bool = False) -> DataFrame:
    """union, intersect or except, by column name; with duplicates if ``all_``."""
    b = b.select(*a.columns)
    if how == "union":
        return a.unionByName(b) if all_ else a.unionByName(b).distinct()
    if how == "intersect":
        return a.intersectAll(b) if all_ else a.intersect(b)
    return a.exceptAll(b) if all_ else a.subtract(b)


# --- batch forms of the stateful operators ---------------------------------


def detect_duplicates(df: DataFrame, keys: Sequence[str], ts: str, age_off: int | None = None, tie: str | None = None) -> DataFrame:
    """Adds is_duplicate: the key was seen before, no longer than ``age_off`` seconds before the last time.

    Of rows at one time the least ``tie`` is the first, or any fixed one.
    """
    order = [ts, tie or F.xxhash64(*(c for c, t in df.dtypes if not t.startswith("map")))]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(_micros(F.col(ts))).over(w)
    dup = before.isNotNull() if age_off is None else F.coalesce(_micros(F.col(ts)) - before <= age_off * 1_000_000, F.lit(False))
    return df.withColumn("is_duplicate", dup)


def rolling_window(df: DataFrame, key: str, ts: str, value: str, seconds: int) -> DataFrame:
    """Count, sum, mean, variance and deviation over the ``seconds`` up to each row."""
    w = Window.partitionBy(key).orderBy(_micros(F.col(ts))).rangeBetween(-seconds * 1_000_000, 0)
    v = F.col(value)
    return df.withColumns({"rolling_count": F.count(v).over(w), "rolling_sum": F.sum(v).over(w), "rolling_mean": F.avg(v).over(w), "rolling_variance": F.var_pop(v).over(w), "rolling_stddev": F.stddev_pop(v).over(w)})


def batches_by_key(df: DataFrame, key: str, order: Sequence[str], value: str, size: int, demarcator: str = "\n") -> DataFrame:
    """Joined values of up to ``size`` rows of a key, in order."""
    numbered = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    grouped = numbered.groupBy(key, F.floor(F.col("__n") / size).cast("long").alias("batch")).agg(F.array_sort(F.collect_list(F.struct("__n", F.col(value).cast("string").alias("v")))).alias("l"))
    return grouped.select(key, "batch", F.array_join(F.col("l.v"), demarcator).alias("content"), F.size("l").cast("long").alias("n"))


def enforce_order(df: DataFrame, group: str, sequence: str, first: int = 0) -> DataFrame:
    """Adds outcome: ``released`` while the sequence has no gap from ``first`` on, then ``waiting``.

    Repeats and what lies before ``first`` are ``skipped``; a row without a
    sequence is ``invalid``.  Only rows from ``first`` on are ranked.
    """
    ahead = F.coalesce(F.col(sequence) >= first, F.lit(False))
    w = Window.partitionBy(group, ahead).orderBy(sequence)
    rank, repeat = F.dense_rank().over(w) - 1, F.coalesce(F.lag(sequence).over(w) == F.col(sequence), F.lit(False))
    outcome = F.when(F.col(sequence).isNull(), "invalid").when(~ahead | repeat, "skipped").when(F.col(sequence) - first == rank, "released").otherwise("waiting")
    return df.withColumn("outcome", outcome)


def wait_for_signal(rows: DataFrame, signals: DataFrame, signal_id: str, target: int | Column, delta: str | None = None) -> DataFrame:
    """Rows with ``released``: their signal's counter has reached the target."""
    counts = signals.groupBy(signal_id).agg((F.sum(delta) if delta else F.count("*")).alias("__n"))
    return rows.join(counts, signal_id, "left").withColumn("released", F.coalesce(F.col("__n") >= target, F.lit(False))).drop("__n")


def monitor_activity(df: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """(key, inactive_from, restored_at, gap_seconds) of every pause longer than ``seconds``."""
    after = F.lead(ts).over(Window.partitionBy(key).orderBy(ts))
    gap = _micros(after) - _micros(F.col(ts))
    return df.select(key, F.col(ts).alias("inactive_from"), after.alias("restored_at"), (gap / 1_000_000).alias("gap_seconds")).filter(F.col("gap_seconds") > seconds)


def session_bins(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Sessions of a key that a pause of ``gap`` ends."""
    return df.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")).drop("w")


#: The kinds of change events that say something about a row.
CDC_OPERATIONS = ("insert", "update", "delete")


def apply_cdc(events: DataFrame, keys: Sequence[str], sequence: str, operation: str, columns: Sequence[str]) -> DataFrame:
    """The table after insert, update and delete events: the last event of each key counts."""
    last = events.filter(F.col(operation).isin(*CDC_OPERATIONS)).groupBy(*keys).agg(F.max_by(F.struct(operation, *columns), F.col(sequence)).alias("r"))
    return last.filter(F.col(f"r.{operation}") != "delete").select(*keys, *(F.col(f"r.{c}") for c in columns))


def merge_cdc(table: DataFrame, events: DataFrame, keys: Sequence[str], sequence: str, operation: str, columns: Sequence[str]) -> DataFrame:
    """An older state of the table with events applied; events of other kinds change nothing.  Null keys are keys like others."""
    events = events.filter(F.col(operation).isin(*CDC_OPERATIONS))
    state = apply_cdc(events, keys, sequence, operation, columns)
    touched = events.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return table.join(touched, same, "left_anti").select(*keys, *columns).unionByName(state)


def cdc_columns(df: DataFrame, event: str, key: Sequence[str]) -> DataFrame:
    """A row for each column of JSON change events: id, name, type, last_value, value."""
    schema = "type string, database string, table_name string, columns array<struct<id:int,name:string,column_type:int,last_value:string,value:string>>"
    parsed = df.select(*key, F.from_json(event, schema).alias("e"))
    return parsed.select(*key, "e.type", "e.database", "e.table_name", F.explode_outer("e.columns").alias("c")).select(*key, "type", "database", "table_name", "c.*")


def change_tracking(events: DataFrame, key: str, operation: str, changed: str) -> DataFrame:
    """(key, event, changed): 'd' once a delete came, else 'u'; the time of the last event."""
    return events.groupBy(key).agg(F.max(F.when(F.col(operation) == "delete", 1).otherwise(0)).alias("d"), F.max(changed).alias("changed")).select(key, F.when(F.col("d") == 1, "d").otherwise("u").alias("event"), "changed")


def counters(df: DataFrame, name: Column, delta: Column) -> DataFrame:
    """The sum of deltas of each counter."""
    return df.groupBy(name.alias("counter")).agg(F.sum(delta).alias("value"))
