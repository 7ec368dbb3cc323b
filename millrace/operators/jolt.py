"""Reshaping of nested records by declarative specs; every step maps a table to a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _type_at(schema: T.StructType, path: str) -> T.DataType | None:
    at: T.DataType = schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.fieldNames():
            return None
        at = at[name].dataType
    return at


def shift(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Only what the spec names: input path to output path; paths that are not there are left out."""
    tree: dict = {}
    for source, target in spec.items():
        if _type_at(df.schema, source) is None:
            continue
        at = tree
        *outer, last = target.split(".")
        for name in outer:
            at = at.setdefault(name, {})
        at[last] = F.col(source)

    def made(node: dict) -> list[Column]:
        return [(v if isinstance(v, Column) else F.struct(*made(v))).alias(n) for n, v in node.items()]

    return df.select(*made(tree))


def _set(df: DataFrame, path: str, make: Callable[[Column | None], Column]) -> DataFrame:
    """Set the value at a dotted path from the old one, or from None if the path is not there."""
    top, _, inner = path.partition(".")
    old = F.col(path) if _type_at(df.schema, path) is not None else None
    if not inner:
        return df.withColumn(top, make(old))
    return df.withColumn(top, F.col(top).withField(inner, make(old)))


def default(df: DataFrame, spec: dict[str, object]) -> DataFrame:
    """Fill what is absent or null."""
    for path, value in spec.items():
        df = _set(df, path, lambda old, v=value: F.lit(v) if old is None else F.coalesce(old, F.lit(v)))
    return df


def remove(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    for path in paths:
        top, _, inner = path.partition(".")
        if _type_at(df.schema, path) is not None:
            df = df.withColumn(top, F.col(top).dropFields(inner)) if inner else df.drop(top)
    return df


def cardinality(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """ONE takes the first element of an array, MANY wraps a value in an array."""
    for path, kind in spec.items():
        is_array = isinstance(_type_at(df.schema, path), T.ArrayType)
        if kind == "ONE" and is_array:
            df = _set(df, path, lambda old: F.get(old, F.lit(0)))
        elif kind == "MANY" and not is_array:
            df = _set(df, path, lambda old: F.when(old.isNotNull(), F.array(old)))
        elif kind not in ("ONE", "MANY"):
            raise ValueError(f"cardinality is ONE or MANY, not {kind}")
    return df


def _sorted(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_sorted(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(c, lambda x: _sorted(x, kind.elementType))
    return c


def sort(df: DataFrame) -> DataFrame:
    """Fields by name, at all depths."""
    return df.select(*(_sorted(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)))


def modify_default(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    """Set by function where the value is absent or null."""
    for path, value in spec.items():
        df = _set(df, path, lambda old, v=value: v if old is None else F.coalesce(old, v))
    return df


def modify_overwrite(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    for path, value in spec.items():
        df = _set(df, path, lambda _, v=value: v)
    return df


def modify_define(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    """Set by function only where the path is not in the schema."""
    for path, value in spec.items():
        if _type_at(df.schema, path) is None:
            df = _set(df, path, lambda _, v=value: v)
    return df


STEPS = {"shift": shift, "default": default, "remove": remove, "cardinality": cardinality, "modify-default": modify_default, "modify-overwrite": modify_overwrite, "modify-define": modify_define}


def chain(df: DataFrame, steps: Sequence[tuple[str, object]]) -> DataFrame:
    """(operation, spec) in order; an empty list is an error."""
    if not steps:
        raise ValueError("a chain needs a step")
    for name, spec in steps:
        df = sort(df) if name == "sort" else STEPS[name](df, spec)
    return df
