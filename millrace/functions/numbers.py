"""Number, date and JSON functions as Column builders."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType)


def _pair(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> tuple[Column, Column, bool]:
    """Both sides as long if both are whole, else as double."""
    whole = _whole(a_type) and _whole(b_type)
    kind = "long" if whole else "double"
    return a.cast(kind), b.cast(kind), whole


def plus(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    x, y, _ = _pair(a, b, a_type, b_type)
    return x + y


def minus(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    x, y, _ = _pair(a, b, a_type, b_type)
    return x - y


def multiply(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    x, y, _ = _pair(a, b, a_type, b_type)
    return x * y


def divide(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    """Whole numbers truncate; a whole number over zero gives null."""
    x, y, whole = _pair(a, b, a_type, b_type)
    return F.when(y != 0, ((x - x % y) / y).cast("long")) if whole else F.when(y != 0, x / y)


def mod(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    x, y, _ = _pair(a, b, a_type, b_type)
    return F.when(y != 0, x % y)


_MATH = {"abs": F.abs, "ceil": F.ceil, "floor": F.floor, "round": F.round, "sqrt": F.sqrt, "cbrt": F.cbrt, "exp": F.exp, "log": F.log, "log10": F.log10, "log1p": F.log1p, "signum": F.signum, "sin": F.sin, "cos": F.cos, "tan": F.tan, "toDegrees": F.degrees, "toRadians": F.radians}
_MATH2 = {"pow": F.pow, "atan2": F.atan2, "hypot": F.hypot, "max": F.greatest, "min": F.least}


def math(c: Column, name: str, other: Column | None = None) -> Column:
    """A named function of one number, or of two."""
    table = _MATH if other is None else _MATH2
    if name not in table:
        raise ValueError(f"no such function: {name}")
    return table[name](c) if other is None else table[name](c, other)


def to_number(c: Column) -> Column:
    """A text, number or time (epoch milliseconds) as a whole number; null if it is none."""
    text = c.cast("string")
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))


def to_decimal(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def random_number(seed: int = 0) -> Column:
    """Non-negative, from a hash of the row's number."""
    return F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def next_int() -> Column:
    """Unique and increasing within a partition."""
    return F.monotonically_increasing_id()


def now() -> Column:
    return F.current_timestamp()


def to_date(c: Column, pattern: str, zone: str | None = None) -> Column:
    """A text read by a pattern, in a zone; null if it does not fit."""
    t = F.try_to_timestamp(c, F.lit(pattern))
    return F.to_utc_timestamp(t, zone) if zone else t


def path_to_date(c: Column, pattern: str) -> Column:
    """The date as text, or the value as it is if it does not fit the pattern."""
    return F.coalesce(F.try_to_timestamp(c, F.lit(pattern)).cast("string"), c)


def number_to_date(c: Column) -> Column:
    """From epoch milliseconds."""
    return F.timestamp_millis(c.cast("long"))


def format_date(c: Column, pattern: str, zone: str | None = None) -> Column:
    return F.date_format(F.from_utc_timestamp(c, zone) if zone else c, pattern)


def implicit_date(c: Column) -> Column:
    """A text in one of the usual forms, or digits as epoch milliseconds."""
    named = F.try_to_timestamp(F.regexp_replace(c, r"^\w{3} (\w{3} \d{2} \d{2}:\d{2}:\d{2}) (?:UTC|GMT) (\d{4})$", "$1 $2"), F.lit("MMM dd HH:mm:ss yyyy"))
    return F.coalesce(named, F.try_to_timestamp(c, F.lit("yyyy/MM/dd HH:mm:ss.SSS")), F.try_to_timestamp(c, F.lit("yyyy/MM/dd HH:mm:ss")), F.when(c.rlike(r"^\d+$"), F.timestamp_millis(c.try_cast("long"))))


def json_path(c: Column, path: str) -> Column:
    """A scalar as text, other values as JSON, a list of one unwrapped; '' if nothing is there."""
    found = F.get_json_object(c, path)
    one = F.get_json_object(found, "$[0]")
    single = found.startswith("[") & one.isNotNull() & (F.json_array_length(found) == 1)
    return F.coalesce(F.when(F.coalesce(single, F.lit(False)), one).otherwise(found), F.lit(""))


def _steps(path: str) -> list[str | int]:
    return [int(i) if i else name for name, i in re.findall(r"\.([^.\[]+)|\[(\d+)\]", path)]


def _edit(kind: str, path: str, value: object, key: str | None):
    steps = _steps(path)

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            root = json.loads(text)
        except ValueError:
            return text
        at = root
        try:
            for s in steps[:-1]:
                at = at[s]
            last = steps[-1]
            if kind == "set":
                at[last]  # only what is there is set
                at[last] = value
            elif kind == "put":
                at[last][key] = value
            elif kind == "add":
                at[last].append(value)
            elif kind == "delete":
                del at[last]
        except (KeyError, IndexError, TypeError, AttributeError):
            return text
        return json.dumps(root, separators=(",", ":"), ensure_ascii=False)

    return one


def _edited(c: Column, kind: str, path: str, value: object = None, key: str | None = None) -> Column:
    """JSON of any shape has no fixed schema, so texts are edited in Arrow batches."""
    one = _edit(kind, path, value, key)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run(c)


def json_path_set(c: Column, path: str, value: object) -> Column:
    """Replaces an existing value; other texts stay as they are."""
    return _edited(c, "set", path, value)


def json_path_put(c: Column, path: str, key: str, value: object) -> Column:
    """Puts a key in the object at the path."""
    return _edited(c, "put", path, value, key)


def json_path_add(c: Column, path: str, value: object) -> Column:
    """Appends to the list at the path."""
    return _edited(c, "add", path, value)


def json_path_delete(c: Column, path: str) -> Column:
    return _edited(c, "delete", path)
