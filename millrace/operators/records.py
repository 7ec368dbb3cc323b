"""Record transforms: projection, update, split, merge, fork, statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.bins import bin_states, merge_bins
from millrace.scratch import written

__all__ = ["bin_states", "merge_bins"]


def query_record(df: DataFrame, sql: str, args: dict | None = None, name: str = "RECORDS") -> DataFrame:
    """SQL over one record table, named in the text as ``{name}`` in braces or by the view's name."""
    return df.sparkSession.sql(sql, args=args, **{name: df})


def update_record(df: DataFrame, values: dict[str, Column | object]) -> DataFrame:
    """Set dotted paths to literals or columns, in order; missing top-level fields are added."""
    for path, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        top, _, inner = path.partition(".")
        df = df.withColumn(top, F.col(top).withField(inner, value) if inner else value)
    return df


def set_by_rules(df: DataFrame, rules: Sequence[tuple[Column, dict[str, object]]]) -> DataFrame:
    """Where a rule's condition holds its columns are set; of several rules the first wins."""
    names = dict.fromkeys(n for _, actions in rules for n in actions)
    out = {}
    for n in names:
        c = None
        for condition, actions in rules:
            if n in actions:
                c = (F if c is None else c).when(condition, F.lit(actions[n]))
        out[n] = c.otherwise(F.col(n) if n in df.columns else F.lit(None))
    return df.withColumns(out)


def rules_engine(df: DataFrame, rules: Sequence[tuple[str, int, Column, str]]) -> DataFrame:
    """A row for each (fact row, rule that fires): (name, priority, condition, action), by priority."""
    fired = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(n).alias("rule"), F.lit(p).alias("priority"), F.lit(a).alias("action"))) for n, p, cond, a in sorted(rules, key=lambda r: r[1])]
    return df.withColumn("fired", F.explode(F.array_compact(F.array(*fired)))).select(*df.columns, "fired.*")


def filter_record(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(F.coalesce(predicate, F.lit(False)))


def validate_by_predicate(df: DataFrame, predicate: Column, name: str = "validity") -> DataFrame:
    return df.withColumn(name, F.when(predicate, "valid").otherwise("invalid"))


def transform_record(df: DataFrame, function: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """A user function from record to record, or None to drop it, in Arrow batches."""
    names = T._parse_datatype_string(schema).fieldNames()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [x for x in map(function, frame.to_dict("records")) if x is not None]
            yield pd.DataFrame(made, columns=names)

    return df.mapInPandas(run, schema)


def partition_record(df: DataFrame, paths: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Adds the values of paths under given names and brings equal ones together."""
    keyed = df.withColumns({n: F.col(p) for n, p in paths.items()})
    return keyed.repartition(partitions, *paths) if partitions else keyed.repartition(*paths)


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Row numbers from 0 over the whole order, without one task for all rows.

    Rows are dealt in ranges, numbered inside each, and shifted by the sizes of
    the ranges before: the only table for all is one row for each partition.
    The ranges are cut once: the numbered parts are written before both uses.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()})
    parts = written(parts, "numbered")
    sizes = parts.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.join(before.select("__p", "__first", "__before"), "__p").withColumn(name, F.col("__i") - F.col("__first") + F.col("__before")).drop("__p", "__i", "__first", "__before")


def split_record(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Chunks of ``size`` rows in the given order: adds fragment_index and row_in_fragment."""
    n = numbered(df, order, "__n")
    return n.withColumns({"fragment_index": F.floor(F.col("__n") / size).cast("long"), "row_in_fragment": (F.col("__n") % size).cast("long")}).drop("__n")


def _fragments(df: DataFrame, id_: str, index: str, count: str, value: str) -> DataFrame:
    """(id, p, n, problem) of every id: its parts by index, how many there should be, and what is wrong with them."""
    own = df.select(id_, F.col(index).cast("long").alias("i"), F.col(count).cast("long").alias("c"), F.col(value).alias("v"))
    parts = own.groupBy(id_).agg(F.array_sort(F.collect_set(F.when(F.col("i").isNotNull(), F.struct("i", "v")))).alias("p"), F.min("c").alias("least"), F.max("c").alias("n"), F.max(F.col("i").isNull()).alias("without"))
    found = F.array_distinct(F.col("p.i"))
    base = F.when(F.array_min(found) == 0, 0).otherwise(1)
    problem = (
        F.when(F.col("without"), "a part has no index").when(F.col("n").isNull(), "no part says how many there are").when(F.col("least") != F.col("n"), "parts say different numbers of parts")
        .when(F.size(found) < F.size("p"), "two values at one index").when((F.array_min(found) < 0) | (F.array_max(found) - base + 1 > F.col("n")), "an index is out of range").when(F.size(found) < F.col("n"), "parts are missing")
    )
    return parts.select(id_, "p", "n", problem.alias("problem"))


def defragment(df: DataFrame, id_: str, index: str, count: str, value: str, separator: str = "") -> DataFrame:
    """Whole texts of the ids whose parts are all there, in order of their index.

    Indexes run from 0 or from 1 without a gap up to the count; a part that
    comes twice with one value counts once.  ``defragment_failures`` has the rest.
    """
    return _fragments(df, id_, index, count, value).filter(F.col("problem").isNull()).select(id_, F.array_join(F.col("p.v"), separator).alias(value))


def defragment_failures(df: DataFrame, id_: str, index: str, count: str, value: str) -> DataFrame:
    """(id, problem) of the ids whose parts do not make one text."""
    return _fragments(df, id_, index, count, value).filter(F.col("problem").isNotNull()).select(id_, "problem")


def _merged(df: DataFrame, bin_: str, attributes: str, everywhere: bool) -> DataFrame:
    # each member's first pair, or its empty map, counts it
    pairs = df.select(bin_, F.posexplode_outer(attributes).alias("__at", "k", "v")).groupBy(bin_, "k").agg(
        F.min("v").alias("v"), F.max("v").alias("w"), F.count("*").alias("n"), F.sum(F.when(F.coalesce("__at", F.lit(0)) == 0, 1).otherwise(0)).alias("members")
    )
    # one value if the least is the greatest; no distinct count, and one read
    whole = pairs.groupBy(bin_).agg(F.sum("members").alias("__all"), F.array_sort(F.collect_list(F.when(F.col("k").isNotNull() & (F.col("v") == F.col("w")), F.struct("k", "v", "n")))).alias("l"))
    kept = F.filter("l", lambda p: (p["n"] == F.col("__all")) | F.lit(not everywhere))
    return whole.select(bin_, F.map_from_entries(F.transform(kept, lambda p: F.struct(p["k"], p["v"]))).alias(attributes))


def keep_common_attributes(df: DataFrame, bin_: str, attributes: str) -> DataFrame:
    """Pairs that every member of a bin has, with one value."""
    return _merged(df, bin_, attributes, True)


def keep_unique_attributes(df: DataFrame, bin_: str, attributes: str) -> DataFrame:
    """Pairs whose values do not differ among the members that have the key."""
    return _merged(df, bin_, attributes, False)


def fork_record(df: DataFrame, array: str, parents: Sequence[str] = ()) -> DataFrame:
    """A row for each element of an array of records, with chosen fields of the parent."""
    return df.select(*parents, F.explode(array).alias("__e")).select(*parents, "__e.*")


def split_json(df: DataFrame, json: str, path: str, element: str, parents: Sequence[str] = ()) -> DataFrame:
    """A row for each element of the JSON array at a path, read by a schema."""
    parsed = F.from_json(F.get_json_object(json, path), f"array<{element}>")
    return df.select(*parents, F.posexplode(parsed).alias("fragment_index", "element"))


def split_xml(df: DataFrame, xml: str, schema: str, array: str, parents: Sequence[str] = ()) -> DataFrame:
    """A row for each repeated child of an XML text."""
    return df.select(*parents, F.from_xml(F.col(xml), schema).alias("__x")).select(*parents, F.posexplode(f"__x.{array}").alias("fragment_index", "element"))


def sample_interval(df: DataFrame, order: Sequence[str], every: int) -> DataFrame:
    """Each ``every``-th row of the order."""
    return numbered(df, order, "__n").filter((F.col("__n") + 1) % every == 0).drop("__n")


def sample_probability(df: DataFrame, share: float, seed: int) -> DataFrame:
    return df.sample(False, share, seed)


def sample_reservoir(df: DataFrame, key: Sequence[str], size: int, seed: int = 0) -> DataFrame:
    """``size`` rows, each with the same chance: the least hashes of the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(size)


def record_stats(df: DataFrame, paths: dict[str, str], limit: int | None = None) -> DataFrame:
    """(name, value, n): the count of each non-null value of each path, of all of a path, and of all rows.

    ``limit`` keeps the most frequent values of each path.  One pass counts
    everything: rows are exploded to (name, value) and summed before the shuffle.
    """
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    pairs = df.select(F.explode(F.array(pair("record.count", F.lit(None)), *(pair(n, F.col(p)) for n, p in paths.items()))).alias("p")).select("p.*")
    counts = pairs.groupBy("name", "value").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame([(n, 0) for n in ("record.count", *paths)], "name string, n long")
    of_path = counts.select("name", F.when(F.col("value").isNotNull() | (F.col("name") == "record.count"), F.col("n")).otherwise(0).alias("n"))
    out = of_path.union(names).groupBy("name").agg(F.sum("n").alias("n")).select("name", F.lit(None).cast("string").alias("value"), "n")
    values = counts.filter("value IS NOT NULL")
    if limit is None:
        return out.union(values)
    for n in paths:
        out = out.union(values.filter(F.col("name") == n).orderBy(F.desc("n"), "value").limit(limit))
    return out


def duplicate_rows(df: DataFrame, copies: int) -> DataFrame:
    """The original, with copy_index 0, and its copies."""
    return df.withColumn("copy_index", F.explode(F.sequence(F.lit(0), F.lit(copies))))


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested records as columns with joined names."""

    def leaves(schema: T.StructType, path: str, name: str):
        for f in schema.fields:
            at, called = f"{path}`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, at + ".", called + separator)
            else:
                yield F.col(at).alias(called)

    return df.select(*leaves(df.schema, "", ""))


def evaluate_json_path(df: DataFrame, json: str, paths: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.get_json_object(json, p) for n, p in paths.items()})


def evaluate_xpath(df: DataFrame, xml: str, paths: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.xpath_string(F.col(xml), F.lit(p)) for n, p in paths.items()})


def attributes_to_json(df: DataFrame, columns: Sequence[str], name: str = "attributes_json", nulls: bool = True) -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct(*columns), {"ignoreNullFields": str(not nulls).lower()}))


def attributes_to_csv(df: DataFrame, columns: Sequence[str], name: str = "attributes_csv") -> DataFrame:
    return df.withColumn(name, F.to_csv(F.struct(*columns)))


def json_to_rows(df: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """JSON objects as typed columns of a table."""
    return df.select(F.from_json(json, schema).alias("__r")).select("__r.*")
