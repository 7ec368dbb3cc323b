"""Boolean columns that are never null, in two families.

``path_*`` compare values of any type as field paths do; the others compare as
the expression language does.  Both give false where SQL would give null.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sure(c: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(c, F.lit(False))


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def path_equals(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    """Equal values; two nulls are equal, numbers compare as numbers, a number and a text by text."""
    if _is_number(a_type) != _is_number(b_type):
        a, b = a.cast("string"), b.cast("string")
    return a.eqNullSafe(b)


def path_not_equals(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    """False for a null left side, and for a number against anything else."""
    if _is_number(a_type) != _is_number(b_type):
        return F.lit(False)
    return a.isNotNull() & ~a.eqNullSafe(b)


def _path_order(a: Column, b: Column, op: Callable[[Column, Column], Column]) -> Column:
    return sure(op(a.cast("string").try_cast("double"), b.cast("string").try_cast("double")))


def path_less(a: Column, b: Column) -> Column:
    """Order as numbers; texts that read as numbers count, all else is false."""
    return _path_order(a, b, lambda x, y: x < y)


def path_less_or_equal(a: Column, b: Column) -> Column:
    return _path_order(a, b, lambda x, y: x <= y)


def path_greater(a: Column, b: Column) -> Column:
    return _path_order(a, b, lambda x, y: x > y)


def path_greater_or_equal(a: Column, b: Column) -> Column:
    return _path_order(a, b, lambda x, y: x >= y)


def contains(c: Column, part: Column) -> Column:
    return sure(c.contains(part))


def starts_with(c: Column, part: Column) -> Column:
    return sure(c.startswith(part))


def ends_with(c: Column, part: Column) -> Column:
    return sure(c.endswith(part))


def matches(c: Column, pattern: str) -> Column:
    """The whole text matches."""
    return sure(c.rlike(rf"\A(?:{pattern})\z"))


def find(c: Column, pattern: str) -> Column:
    """A part of the text matches."""
    return sure(c.rlike(pattern))


def path_is_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string") == "", F.lit(True))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c.cast("string"), r"^\s+", "") == "", F.lit(True))


def negate(c: Column) -> Column:
    return ~sure(c)


def is_null(c: Column) -> Column:
    return c.isNull()


def not_null(c: Column) -> Column:
    return c.isNotNull()


is_empty = is_blank


def equals(a: Column, b: Column) -> Column:
    """Equal as texts; times as epoch milliseconds."""
    return sure(a.cast("string") == b.cast("string"))


def equals_ignore_case(a: Column, b: Column) -> Column:
    return sure(F.lower(a.cast("string")) == F.lower(b.cast("string")))


def gt(a: Column, b: Column) -> Column:
    return sure(a > b)


def ge(a: Column, b: Column) -> Column:
    return sure(a >= b)


def lt(a: Column, b: Column) -> Column:
    return sure(a < b)


def le(a: Column, b: Column) -> Column:
    return sure(a <= b)


def is_in(c: Column, *values: object) -> Column:
    return sure(c.cast("string").isin(*[str(v) for v in values]))


def all_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a & b, map(sure, tests), F.lit(True))


def any_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, map(sure, tests), F.lit(False))


def if_else(test: Column, yes: Column, no: Column) -> Column:
    return F.when(test, yes).otherwise(no)


def any_column(names: list[str], test: Callable[[Column], Column]) -> Column:
    """Some of the named columns passes."""
    return any_of(*(test(F.col(n)) for n in names))


def all_columns(names: list[str], test: Callable[[Column], Column]) -> Column:
    return all_of(*(test(F.col(n)) for n in names))


def matching_columns(df: DataFrame, *patterns: str) -> list[str]:
    """Names of which a part matches one of the patterns, in the table's order."""
    return [c for c in df.columns if any(re.search(p, c) for p in patterns)]


def any_delimited(c: Column, delimiter: str, test: Callable[[Column], Column]) -> Column:
    """Some part of the text between delimiters (a pattern) passes."""
    return sure(F.exists(F.split(c, delimiter), lambda x: sure(test(x))))


def all_delimited(c: Column, delimiter: str, test: Callable[[Column], Column]) -> Column:
    return sure(F.forall(F.split(c, delimiter), lambda x: sure(test(x))))


def count_true(*tests: Column) -> Column:
    """How many tests are true; false and null do not count."""
    return F.size(F.filter(F.array(*map(sure, tests)), lambda x: x)).cast("long")


def join_values(separator: str, *values: Column) -> Column:
    """The texts in order, null as the empty text."""
    return F.concat_ws(separator, *(F.coalesce(v.cast("string"), F.lit("")) for v in values))
