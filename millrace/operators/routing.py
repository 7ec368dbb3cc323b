"""Routing of rows to named outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import all_of, any_of, sure


def route_on_attribute(df: DataFrame, routes: dict[str, Column], strategy: str = "each", name: str = "route") -> DataFrame:
    """Adds the route.  ``each``: a copy for every matching name; ``all`` and ``any``: matched or not."""
    tests = list(routes.values())
    if strategy in ("all", "any"):
        return df.withColumn(name, F.when((all_of if strategy == "all" else any_of)(*tests), "matched").otherwise("unmatched"))
    if strategy != "each":
        raise ValueError(f"no such strategy: {strategy}")
    hits = F.array_compact(F.array(*(F.when(sure(t), n) for n, t in routes.items())))
    return df.withColumn(name, F.explode(F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("unmatched")))))


def route_on_content(df: DataFrame, content: str, patterns: dict[str, str], whole: bool = False, name: str = "route") -> DataFrame:
    """A copy of the row for every pattern that its content has, or matches as a whole."""
    return route_on_attribute(df, {n: F.col(content).rlike(rf"(?s)\A(?:{p})\z" if whole else p) for n, p in patterns.items()}, "each", name)


def line_test(line: Column, value: str, how: str, ignore_case: bool = False, trim: bool = True) -> Column:
    """One test of a line: contains, starts, ends, equals, contains_regex, matches_regex."""
    x = F.trim(line) if trim else line
    if "regex" in how:
        flag = "(?i)" if ignore_case else ""
        return x.rlike(flag + (value if how == "contains_regex" else rf"\A(?:{value})\z"))
    x, v = (F.lower(x), value.lower()) if ignore_case else (x, value)
    return {"contains": x.contains(v), "starts": x.startswith(v), "ends": x.endswith(v), "equals": x == v}[how]


def route_text(df: DataFrame, text: str, tests: dict[str, str], how: str = "contains", strategy: str = "each", ignore_case: bool = False, trim: bool = True, group: str | None = None) -> DataFrame:
    """A row for each line and route; ``group`` is a pattern whose captures, joined, are the line's group."""
    lines = df.withColumn("__lines", F.split(text, "\n")).select("*", F.posexplode("__lines").alias("line_number", "line")).drop("__lines")
    routed = route_on_attribute(lines, {n: line_test(F.col("line"), v, how, ignore_case, trim) for n, v in tests.items()}, strategy)
    if group:
        routed = routed.withColumn("group", F.array_join(F.regexp_extract_all("line", F.lit(group), 1), ", "))
    return routed


def distribute_load(df: DataFrame, key: Sequence[str], weights: dict[str, int], name: str = "output") -> DataFrame:
    """Outputs in proportion to weights, by a hash of the key."""
    total, upto, c = sum(weights.values()), 0, None
    place = F.pmod(F.xxhash64(*key), F.lit(total))
    for output, w in weights.items():
        upto += w
        c = (F if c is None else c).when(place < upto, output)
    return df.withColumn(name, c)


def partition_by_attribute(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Equal values in one partition."""
    return df.repartition(partitions, *columns)
