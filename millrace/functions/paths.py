"""Field paths on nested records: ``/a/b``, ``//x``, ``/*``, ``..``, ``[n]``, ``[0, 2..4]``, ``['k']``, ``[filter]``.

A path is walked on the schema when the query is built and becomes a plain
Column, so Spark prunes and pushes as for any other.  Steps that can give
several values give an array without nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Path:
    """A value in a row: its column, its type, and the path that it came from."""

    column: Column
    kind: T.DataType
    parent: Path | None = None

    def child(self, name: str) -> Path:
        """A field of the record; a null value where the schema has none."""
        if isinstance(self.kind, T.StructType) and name in self.kind.fieldNames():
            return Path(self.column[name], self.kind[name].dataType, self)
        if isinstance(self.kind, T.ArrayType) and isinstance(self.kind.elementType, T.StructType) and name in self.kind.elementType.fieldNames():
            field = self.kind.elementType[name].dataType
            return Path(F.transform(self.column, lambda x: x[name]), T.ArrayType(field), self)
        return Path(F.lit(None), T.NullType(), self)

    def up(self) -> Path:
        """The parent (``..``)."""
        if self.parent is None:
            raise ValueError("the root has no parent")
        return self.parent

    def _below(self) -> list[tuple[str, Path]]:
        """All descendants through records only, outer ones first."""
        if not isinstance(self.kind, T.StructType):
            return []
        own = [(f.name, self.child(f.name)) for f in self.kind.fields]
        return own + [pair for _, p in own for pair in p._below()]

    def _collected(self, found: Sequence[Path]) -> Path:
        kinds = {p.kind.simpleString() for p in found}
        if not found:
            return Path(F.array().cast("array<string>"), T.ArrayType(T.StringType()), self)
        if len(kinds) == 1:
            return Path(F.array_compact(F.array(*(p.column for p in found))), T.ArrayType(found[0].kind), self)
        # unlike types meet as JSON texts, scalars as their own text
        texts = [F.to_json(p.column) if isinstance(p.kind, (T.StructType, T.ArrayType, T.MapType)) else p.column.cast("string") for p in found]
        return Path(F.array_compact(F.array(*texts)), T.ArrayType(T.StringType()), self)

    def descendants(self, name: str) -> Path:
        """``//name``: every non-null field of that name at any depth of records."""
        return self._collected([p for n, p in self._below() if n == name])

    def children(self) -> Path:
        """``/*``: all non-null children."""
        return self._collected([self.child(f.name) for f in self.kind.fields] if isinstance(self.kind, T.StructType) else [])

    def all_descendants(self) -> Path:
        """``//*``: all non-null descendants."""
        return self._collected([p for _, p in self._below()])

    def index(self, n: int) -> Path:
        """``[n]``: from the end if negative; null past either end."""
        element = self.kind.elementType
        return Path(F.get(self.column, F.lit(n)) if n >= 0 else F.try_element_at(self.column, F.lit(n)), element, self)

    def slices(self, *ranges: int | tuple[int, int]) -> Path:
        """``[0, 2..4, -1]``: elements of indexes and inclusive ranges, in the order given; places past the end are left out."""
        size, parts = F.size(self.column), []
        for r in ranges:
            low, high = r if isinstance(r, tuple) else (r, r)
            place = lambda i: size + i if i < 0 else F.lit(i)
            a, b = place(low), F.least(place(high), size - 1)
            fits = (size > abs(low)) & (a <= b) & (a >= 0)
            parts.append(F.when(fits, F.slice(self.column, a + 1, b - a + 1)).otherwise(F.slice(self.column, 1, 0)))
        return Path(F.concat(*parts), self.kind, self)

    def elements(self) -> Path:
        """``[*]``: array elements or map values."""
        if isinstance(self.kind, T.MapType):
            return Path(F.map_values(self.column), T.ArrayType(self.kind.valueType), self)
        return self

    def key(self, *keys: str) -> Path:
        """``['k']``: the value of a key; of several keys an array of their values in that order."""
        if len(keys) == 1:
            return Path(F.try_element_at(self.column, F.lit(keys[0])), self.kind.valueType, self)
        return Path(F.array(*(F.try_element_at(self.column, F.lit(k)) for k in keys)), T.ArrayType(self.kind.valueType), self)

    def where(self, test: Callable[[Path], Column]) -> Path:
        """``[filter]``: the values for which the test holds; null counts as false."""
        if isinstance(self.kind, T.ArrayType):
            element = self.kind.elementType
            return Path(F.filter(self.column, lambda x: F.coalesce(test(Path(x, element, self)), F.lit(False))), self.kind, self)
        return Path(F.when(F.coalesce(test(self), F.lit(False)), self.column), self.kind, self)


def root(df: DataFrame) -> Path:
    return Path(F.struct(*(F.col(f"`{c}`") for c in df.columns)), df.schema)


def field(df: DataFrame, name: str) -> Path:
    """A top-level column as a path."""
    return Path(F.col(f"`{name}`"), df.schema[name].dataType, root(df))


Step = str | int | tuple[str, str]


def update_at(df: DataFrame, column: str, steps: Sequence[Step], make: Callable[[Column], Column]) -> DataFrame:
    """Write back a value inside a column: field names, array indexes, ``'*'`` for all elements, ('key', k) for a map's key."""

    def changed(c: Column, kind: T.DataType, rest: Sequence[Step]) -> Column:
        if not rest:
            return make(c)
        step, tail = rest[0], rest[1:]
        if isinstance(kind, T.StructType):
            return c.withField(step, changed(c[step], kind[step].dataType, tail))
        if isinstance(kind, T.ArrayType):
            if step == "*":
                return F.transform(c, lambda x: changed(x, kind.elementType, tail))
            at = F.lit(step) if step >= 0 else F.size(c) + step
            return F.transform(c, lambda x, i: F.when(i == at, changed(x, kind.elementType, tail)).otherwise(x))
        if isinstance(kind, T.MapType):
            key = step[1] if isinstance(step, tuple) else None
            return F.transform_values(c, lambda k, v: changed(v, kind.valueType, tail) if key is None else F.when(k == key, changed(v, kind.valueType, tail)).otherwise(v))
        raise ValueError(f"no step {step!r} into {kind.simpleString()}")

    return df.withColumn(column, changed(F.col(column), df.schema[column].dataType, steps))
