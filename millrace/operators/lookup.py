"""Lookups and enrichment: by key, by range, by address.

Sides are joined plainly, so Spark sends a lookup table to all tasks only where
its size is known to be small, and shuffles it otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lookup_value(df: DataFrame, on: str, table: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Adds one value for a key; null where the key is null or absent."""
    return df.join(table.select(F.col(key).alias("__k"), F.col(value).alias(name)), F.col(on) == F.col("__k"), "left").drop("__k")


def unique_keys(table: DataFrame, key: str, duplicates: str = "error", order: str | None = None) -> DataFrame:
    """A lookup table with one row for each key.

    A null or blank key is an error.  Repeated keys are an error, or with
    ``duplicates="last"`` the last row by ``order`` wins.
    """
    if not table.filter(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).isEmpty():
        raise ValueError("a lookup key is blank")
    if duplicates == "last":
        others = [c for c in table.columns if c != key]
        last = table.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("__r"))
        return last.select(key, "__r.*")
    if not table.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError("a lookup key is repeated")
    return table


def lookup_csv_value(df: DataFrame, on: str, path: str, key: str, value: str, name: str, duplicates: str = "error") -> DataFrame:
    """Key column to value column of a CSV file with a header; rows later in the file are the last."""
    table = df.sparkSession.read.option("header", True).csv(path)
    table = table.withColumn("__n", F.monotonically_increasing_id()) if duplicates == "last" else table
    return lookup_value(df, on, unique_keys(table, key, duplicates, "__n"), key, value, name)


def lookup_struct(df: DataFrame, table: DataFrame, on: dict[str, str], name: str = "record") -> DataFrame:
    """Adds the whole row of the table for a key, as a record; null if there is none."""
    keys = list(on.values())
    right = table.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.struct(*table.columns).alias(name))
    condition = reduce(lambda a, b: a & b, (F.col(left) == F.col(f"__k{i}") for i, left in enumerate(on)))
    return df.join(right, condition, "left").drop(*(f"__k{i}" for i in range(len(keys))))


def lookup_properties(spark: SparkSession, path: str) -> DataFrame:
    """A file of ``key=value`` lines as a table (key, value); comments and blank lines are left out."""
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(?:[#!].*)?$"))
    return lines.select(F.trim(F.regexp_extract("value", r"^\s*([^=:\s]+)\s*[=:\s]", 1)).alias("key"), F.trim(F.regexp_extract("value", r"^\s*[^=:\s]+\s*[=:\s]\s*(.*)$", 1)).alias("value"))


def lookup_xml(spark: SparkSession, path: str, row_tag: str, key: str = "_name", value: str = "_VALUE") -> DataFrame:
    """Elements of an XML file, by an attribute, as a table (key, value)."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(f"{key} string, {value} string").load(path)
    return rows.select(F.col(key).alias("key"), F.col(value).alias("value"))


def lookup_record(df: DataFrame, table: DataFrame, on: dict[str, str], to: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(matched rows with the table's other columns, unmatched rows).  ``to`` renames the columns added."""
    found = lookup_struct(df, table, on, "__found")
    added = [c for c in table.columns if c not in on.values()]
    matched = found.filter(F.col("__found").isNotNull()).select(*df.columns, *(F.col(f"__found.{c}").alias((to or {}).get(c, c)) for c in added))
    return matched, found.filter(F.col("__found").isNull()).select(*df.columns)


def lookup_attributes(df: DataFrame, lookups: dict[str, tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Several lookups: new name to (column, table, key, value)."""
    for name, (on, table, key, value) in lookups.items():
        df = lookup_value(df, on, table, key, value, name)
    return df


def ip_to_long(c: Column) -> Column:
    """The number of a dotted IPv4 address; null for other texts."""
    part = lambda i: F.split_part(c, F.lit("."), F.lit(i)).try_cast("long")
    valid = c.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.|$)){4}$") & ~c.endswith(".")
    return F.when(valid, part(1) * 16777216 + part(2) * 65536 + part(3) * 256 + part(4))


def lookup_range(df: DataFrame, value: str, ranges: DataFrame, start: str, end: str, columns: Sequence[str], width: int = 1 << 16) -> DataFrame:
    """Adds ``columns`` of the narrowest range [start, end] that holds the value; null if none does.

    Values and ranges meet in buckets of ``width``.  A range of many buckets is
    not copied to each: it is cut in aligned pieces, twice as wide at each
    level, at most two a level, and a value asks once for each level.
    """
    span = ranges.agg(F.max(F.col(end) - F.col(start))).first()[0]
    levels = max(1, math.ceil(math.log2(max(float(span or 0) / width, 1.0))) + 1)
    pieces = ranges.select(F.col(start).alias("__s"), F.col(end).alias("__e"), F.struct(*columns).alias("__r"))
    # at each level: the bucket of the start if it is a right half, that of the end if a left half
    low = lambda s: F.expr(f"CAST(ceil(__s / {width * 2**s}.0D) AS BIGINT)")
    high = lambda s: F.expr(f"CAST(floor((__e + 1) / {width * 2**s}.0D) AS BIGINT) - 1")
    entries = [F.struct(F.lit(0).alias("level"), F.expr(f"CAST(floor(__s / {width}.0D) AS BIGINT)").alias("bucket")), F.struct(F.lit(0).alias("level"), F.expr(f"CAST(floor(__e / {width}.0D) AS BIGINT)").alias("bucket"))]
    for s in range(levels):
        inside = low(s) <= high(s)
        entries.append(F.when(inside & (F.pmod(low(s), F.lit(2)) == 1), F.struct(F.lit(s).alias("level"), low(s).alias("bucket"))))
        entries.append(F.when(inside & (F.pmod(high(s), F.lit(2)) == 0), F.struct(F.lit(s).alias("level"), high(s).alias("bucket"))))
    used = pieces.withColumn("__b", F.explode(F.array_distinct(F.array_compact(F.array(*entries))))).select("__s", "__e", "__r", "__b.level", "__b.bucket")
    present = [r[0] for r in used.select("level").distinct().collect()]  # at most ``levels`` numbers
    if not present:
        return df.select("*", *(F.lit(None).cast(ranges.schema[c].dataType).alias(c) for c in columns))
    key = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__v", F.col(value).cast("long"))
    # rows that are equal in value share an answer, so each value is looked up once
    values = key.select("__v").filter("__v IS NOT NULL").distinct()
    asked = values.withColumn("level", F.explode(F.array(*map(F.lit, sorted(present))))).withColumn("bucket", F.floor(F.col("__v") / (F.lit(float(width)) * F.pow(F.lit(2.0), F.col("level")))).cast("long"))
    hits = asked.join(used, ["level", "bucket"]).filter("__v BETWEEN __s AND __e")
    best = hits.groupBy("__v").agg(F.min_by("__r", F.struct((F.col("__e") - F.col("__s")).alias("w"), "__s")).alias("__best")).withColumnRenamed("__v", "__bv")
    out = key.join(best, F.col("__v") == F.col("__bv"), "left")
    return out.select(*df.columns, *(F.col(f"__best.{c}").alias(c) for c in columns))


def enrich_ip(df: DataFrame, ip: str, ranges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the record of the narrowest address range (start_ip, end_ip as texts), and ``found``."""
    numbered = ranges.withColumns({"__start": ip_to_long(F.col("start_ip")), "__end": ip_to_long(F.col("end_ip")), "__hit": F.lit(True)})
    out = lookup_range(df.withColumn("__ip", ip_to_long(F.col(ip))), "__ip", numbered, "__start", "__end", [*columns, "__hit"])
    return out.drop("__ip").withColumn("found", F.coalesce("__hit", F.lit(False))).drop("__hit")


def anonymous_ip(df: DataFrame, ip: str, ranges: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Boolean flags of an address; false where it is in no range."""
    return enrich_ip(df, ip, ranges, flags).withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags}).drop("found")


def lookup_script(df: DataFrame, on: str, function: Callable[[object], object], name: str, kind: str = "string") -> DataFrame:
    """A user function from key to value, in Arrow batches."""

    @F.pandas_udf(kind)
    def run(keys: pd.Series) -> pd.Series:
        return keys.map(function)

    return df.withColumn(name, run(F.col(on)))


def cache_put(cache: DataFrame, rows: DataFrame, key: str, replace: bool = True) -> DataFrame:
    """The cache with new rows; of one key the new row, or the old one without ``replace``."""
    keep, add = (cache.join(rows, key, "left_anti"), rows) if replace else (cache, rows.join(cache, key, "left_anti"))
    return keep.unionByName(add)


def cache_fetch(df: DataFrame, cache: DataFrame, on: str, key: str, value: str, name: str) -> DataFrame:
    return lookup_value(df, on, cache, key, value, name)


def read_store(spark: SparkSession, connector: str, options: dict[str, str]) -> DataFrame:
    """A table of an outside store, by its Spark connector, to join with."""
    return spark.read.format(connector).options(**options).load()


class RefreshingLookup:
    """A lookup table for micro-batches, read anew when it is older than ``max_age`` seconds; 0 always."""

    def __init__(self, read: Callable[[], DataFrame], max_age: float, clock: Callable[[], float]):
        self.read, self.max_age, self.clock = read, max_age, clock
        self.at: float | None = None
        self.table: DataFrame | None = None

    def get(self) -> DataFrame:
        if self.table is None or self.max_age <= 0 or self.clock() - self.at >= self.max_age:
            if self.table is not None:
                self.table.unpersist()
            self.table, self.at = self.read(), self.clock()
            if self.max_age > 0:
                self.table.persist()
        return self.table
