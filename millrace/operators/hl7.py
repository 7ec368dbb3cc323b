"""HL7 messages as a tree: segments, fields, repetitions, components, subcomponents.

The separators are those that a message's own MSH segment declares.  Numbers
begin with 1, as in the standard: MSH-1 is the field separator itself, MSH-2 the
other separators, and MSH-3 the first field after them.  An address is written
``PID-3``, ``PID-3[2]``, ``PID-3.1``, ``PID-3[2].1`` or ``PID-3[2].1.4``; without a
repetition a component is that of the first one.  All is built-in functions.

Defined cases: a message without an MSH segment at its start has the usual
separators; a part that is not there is null, one that is empty is empty; a
whole field or repetition is given as it stands, a component or subcomponent,
and a field that has no parts, with its escape sequences resolved.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import sure

#: Field, component, repetition, escape and subcomponent separators where none are declared.
USUAL = "|^~\\&"
_ADDRESS = re.compile(r"(?:(\w{3})-)?(\d+)(?:\[(\d+)\])?(?:\.(\d+))?(?:\.(\d+))?")


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("\\Q"), c, F.lit("\\E"))


def separators(message: Column) -> Column:
    """A record of the five separators of a message."""
    own = message.rlike(r"\AMSH.....")
    at = lambda i: F.when(own, F.substring(message, 4 + i, 1)).otherwise(USUAL[i])
    return F.struct(*(at(i).alias(n) for i, n in enumerate(("field", "component", "repetition", "escape", "sub"))))


def segments(df: DataFrame, message: str, key: Sequence[str]) -> DataFrame:
    """A row for each segment: (key, segment_index, segment, fields, separators); ``fields[n]`` is field n, and 0 the name."""
    lines = F.filter(F.split(message, r"[\r\n]+"), lambda x: x != "")
    rows = df.select(*key, separators(F.col(message)).alias("separators"), F.posexplode(lines).alias("segment_index", "__l"))
    parts = F.split("__l", _quoted(F.col("separators.field")), F.lit(-1))
    # MSH-1 is the separator itself
    numbered = F.when(F.get(parts, F.lit(0)) == "MSH", F.concat(F.array(F.lit("MSH"), F.col("separators.field")), F.slice(parts, F.lit(2), F.size(parts)))).otherwise(parts)
    return rows.select(*key, "segment_index", F.get(parts, F.lit(0)).alias("segment"), numbered.alias("fields"), "separators")


def unescaped(value: Column, s: Column) -> Column:
    """Escape sequences resolved from left to right; unknown ones stay."""
    e = s["escape"]
    pieces = F.regexp_extract_all(value, F.concat(F.lit("(?s)"), _quoted(e), F.lit("[^"), _quoted(e), F.lit("]*"), _quoted(e), F.lit("|[^"), _quoted(e), F.lit("]+|.")), F.lit(0))

    def one(piece: Column) -> Column:
        code = F.when(piece.startswith(e) & piece.endswith(e) & (F.length(piece) > 2), F.substring(piece, F.lit(2), F.length(piece) - 2))
        out = F.when(code.rlike("^X(?:[0-9A-Fa-f]{2})+$"), F.decode(F.unhex(F.substring(code, F.lit(2), F.length(code))), "UTF-8")).when(code == ".br", "\n").when(code == "E", e)
        for letter, name in {"F": "field", "S": "component", "T": "sub", "R": "repetition"}.items():
            out = out.when(code == letter, s[name])
        return out.otherwise(piece)

    return F.when(F.contains(value, e), F.array_join(F.transform(pieces, one), "")).otherwise(value)


def value_at(address: str | int, fields: str = "fields", separators_: str = "separators") -> Column:
    """The value at an address, of which the segment's name is not looked at, on rows of ``segments``."""
    m = _ADDRESS.fullmatch(str(address))
    if not m or "0" in m.groups()[1:]:
        raise ValueError(f"not an address of a field: {address}")
    _, field, repetition, component, sub = m.groups()
    s, raw = F.col(separators_), F.get(F.col(fields), F.lit(int(field)))
    # MSH-1 and MSH-2 hold the separators and have no parts
    held = (F.get(F.col(fields), F.lit(0)) == "MSH") & F.lit(int(field) <= 2)
    if repetition is component is None:
        parted = F.contains(raw, s["repetition"]) | F.contains(raw, s["component"]) | F.contains(raw, s["sub"])
        return F.when(held | parted, raw).otherwise(unescaped(raw, s))
    cut = lambda c, by, n: F.get(F.split(c, _quoted(s[by]), F.lit(-1)), F.lit(int(n) - 1))
    value = cut(raw, "repetition", repetition or 1)
    if component is not None:
        value = cut(value, "component", component)
        value = unescaped(cut(value, "sub", sub) if sub else value, s)
    return F.when(~held, value)


def select(df: DataFrame, message: str, key: Sequence[str], segment: str, fields: dict[str, int | str], where: Callable[[Callable[[int | str], Column]], Column] | None = None) -> DataFrame:
    """Chosen values of the segments of one kind; ``where`` gets a function from address to column."""
    for address in fields.values():
        named = _ADDRESS.fullmatch(str(address))
        if named and named[1] not in (None, segment):
            raise ValueError(f"{address} is not in {segment}")
    rows = segments(df, message, key).filter(F.col("segment") == segment)
    rows = rows.filter(sure(where(value_at))) if where else rows
    return rows.select(*key, "segment_index", *(value_at(a).alias(name) for name, a in fields.items()))
