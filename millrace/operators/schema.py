"""Schema operators: inference by a type lattice, conversion, validation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT, TIME_FORMAT, TIMESTAMP_FORMAT = "yyyy-MM-dd", "HH:mm:ss", "yyyy-MM-dd HH:mm:ss"
#: Wider numbers last.
NUMBERS = ("INT", "LONG", "FLOAT", "DOUBLE", "DECIMAL")
_SPARK = {"INT": "int", "LONG": "bigint", "FLOAT": "float", "DOUBLE": "double", "DECIMAL": "decimal(38,10)", "BOOLEAN": "boolean", "DATE": "date", "TIME": "string", "TIMESTAMP": "timestamp", "STRING": "string", "CHOICE": "string"}
FLOAT_MAX = 3.4028234663852886e38


def shape(form: str) -> str:
    """A pattern that all texts of a date format match: digits for the letters of numbers, anything for names."""
    out = []
    for letters, quoted, other in re.findall(r"([A-Za-z]+)|'([^']*)'|([^A-Za-z'])", form):
        for run in (m[0] for m in re.finditer(r"([A-Za-z])\1*", letters)):
            digits = run[0] in "uydHhkKmsSn" or (run[0] in "ML" and len(run) < 3)
            out.append((rf"\d{{{len(run)}}}" if len(run) > 1 else r"\d+") if digits else ".+")
        out.append(re.escape(quoted or other))
    return rf"\A{''.join(out)}\z"


def temporal_code(c: Column, date: str = DATE_FORMAT, time: str = TIME_FORMAT, timestamp: str = TIMESTAMP_FORMAT) -> Column:
    """TIMESTAMP, DATE or TIME for a text that fits that format, tried in this order; else null."""
    # only a text of the format's shape is worth a parse
    fits = lambda p: F.when(c.rlike(shape(p)), F.coalesce(F.date_format(F.try_to_timestamp(c, F.lit(p)), p) == c, F.lit(False))).otherwise(False)
    return F.when(fits(timestamp), "TIMESTAMP").when(fits(date), "DATE").when(fits(time), "TIME")


def type_code(c: Column, date: str = DATE_FORMAT, time: str = TIME_FORMAT, timestamp: str = TIMESTAMP_FORMAT) -> Column:
    """The narrowest type of one text value; null and empty texts carry none.

    A fraction is FLOAT if it is positive and within a float's range, else
    DOUBLE; whole numbers beyond a long are DECIMAL.
    """
    value = c.try_cast("double")
    whole = c.rlike(r"^[+-]?\d+$")
    fraction = c.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+(?=[eE]))([eE][+-]?\d+)?$")
    return (
        F.when(c.isNull() | (F.trim(c) == ""), None)
        .when(whole & c.try_cast("int").isNotNull(), "INT")
        .when(whole & c.try_cast("bigint").isNotNull(), "LONG")
        .when(whole, "DECIMAL")
        .when(fraction & (value > 0) & (value <= FLOAT_MAX), "FLOAT")
        .when(fraction, "DOUBLE")
        .when(F.lower(c).isin("true", "false"), "BOOLEAN")
        .otherwise(F.coalesce(temporal_code(c, date, time, timestamp), F.lit("STRING")))
    )


def widen(codes: set[str]) -> str:
    """One type for all: the widest number; unlike types are a CHOICE, or STRING if one of them is."""
    if not codes:
        return "STRING"
    if len(codes) == 1:
        return next(iter(codes))
    if codes <= set(NUMBERS):
        return max(codes, key=NUMBERS.index)
    return "STRING" if "STRING" in codes else "CHOICE"


def infer_codes(df: DataFrame) -> dict[str, str]:
    """The type of each text column over all rows; only the codes met, a handful a column, reach the driver."""
    row = df.agg(*(F.collect_set(type_code(F.col(f"`{c}`").cast("string"))).alias(f"c{i}") for i, c in enumerate(df.columns))).first()
    return {c: widen(set(row[i])) for i, c in enumerate(df.columns)}


def infer_schema(df: DataFrame) -> T.StructType:
    """A schema for a table of texts."""
    return T.StructType([T.StructField(c, T._parse_datatype_string(_SPARK[code]), True, {"inferred": code}) for c, code in infer_codes(df).items()])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to inferred types; values that do not fit become null."""
    return df.select(*(F.col(f"`{f.name}`").cast("string").try_cast(f.dataType).alias(f.name) for f in schema.fields))


def merge_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """The union of fields; records merge field by field, unlike types widen."""
    out, other = [], {f.name: f for f in b.fields}
    for f in a.fields:
        g = other.pop(f.name, None)
        out.append(T.StructField(f.name, merge_types(f.dataType, g.dataType) if g else f.dataType, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name in other])


_LATTICE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The wider type; types with nothing in common become a variant (CHOICE)."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if type(a) in _LATTICE and type(b) in _LATTICE:
        return max(a, b, key=lambda t: _LATTICE.index(type(t)))
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    return T.VariantType()


def union_records(*frames: DataFrame) -> DataFrame:
    """Rows of tables with unlike fields; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _coerced(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        names = {f.name: f.dataType for f in have.fields}
        fields = [(_coerced(c[f.name], names[f.name], f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _coerced(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if have == want:
        return c
    return c.cast("string").try_cast(want) if isinstance(have, T.StringType) else c.try_cast(want)


def convert_record(df: DataFrame, schema: T.StructType, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Project by name on a schema: extra fields go, missing ones are null or the field's default.

    A default stands in the field's metadata under ``default``, other names of a field in ``aliases``.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        source = next((n for n in [f.name, *(aliases or {}).get(f.name, [])] if n in have), None)
        default = F.lit(f.metadata.get("default")).cast(f.dataType)
        out.append((F.coalesce(_coerced(F.col(f"`{source}`"), have[source], f.dataType), default) if source else default).alias(f.name))
    return df.select(*out)


def validation_errors(df: DataFrame, schema: T.StructType, allow_extra: bool = False, strict_types: bool = True) -> Column:
    """An array of (field, type) for each row: MISSING_FIELD, EXTRA_FIELD, INVALID_FIELD."""
    have, problems = {f.name: f.dataType for f in df.schema.fields}, []
    error = lambda name, kind: F.struct(F.lit(name).alias("field"), F.lit(kind).alias("error"))
    for f in schema.fields:
        if f.name not in have:
            if not f.nullable:
                problems.append(error(f.name, "MISSING_FIELD"))
            continue
        c = F.col(f"`{f.name}`")
        if not f.nullable:
            problems.append(F.when(c.isNull(), error(f.name, "MISSING_FIELD")))
        if strict_types and have[f.name] != f.dataType:
            problems.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), error(f.name, "INVALID_FIELD")))
        allowed = f.metadata.get("enum")
        if allowed:
            problems.append(F.when(c.isNotNull() & ~c.isin(allowed), error(f.name, "INVALID_FIELD")))
    if not allow_extra:
        problems += [error(n, "EXTRA_FIELD") for n in have if n not in schema.fieldNames()]
    empty = F.array().cast("array<struct<field:string,error:string>>")
    return F.array_compact(F.array(*problems)) if problems else empty


def validate_record(df: DataFrame, schema: T.StructType, allow_extra: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with an ``errors`` column)."""
    marked = df.withColumn("errors", validation_errors(df, schema, allow_extra))
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def schema_by_name(registry: DataFrame, name: str, version: int | None = None) -> T.StructType:
    """The schema of a name in a table (name, version, ddl); the newest without a version."""
    rows = registry.filter(F.col("name") == name)
    rows = rows.filter(F.col("version") == version) if version is not None else rows
    row = rows.orderBy(F.desc("version")).limit(1).first()
    if row is None:
        raise LookupError(f"no schema {name}")
    return T._parse_datatype_string(row.ddl)


def embedded_schema_id(content: Column) -> Column:
    """The id in a payload of a magic byte 0 and four big-endian bytes; null for others."""
    return F.when(F.hex(F.substring(content, 1, 1)) == "00", F.conv(F.hex(F.substring(content, 2, 4)), 16, 10).cast("long"))


def schema_rows(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, type) of every field, outer ones first."""
    out = []
    for f in schema.fields:
        out.append((prefix + f.name, f.dataType.simpleString()))
        if isinstance(f.dataType, T.StructType):
            out += schema_rows(f.dataType, f"{prefix}{f.name}.")
    return out


def schema_fingerprint(df: DataFrame) -> Column:
    """SHA-256 of the field names and types, in order and at all depths."""
    return F.sha2(F.lit(";".join(f"{n}:{t}" for n, t in schema_rows(df.schema))), 256)


def format_times(df: DataFrame, date: str = DATE_FORMAT, timestamp: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Dates and timestamps as texts in the given formats."""
    formats = {"date": date, "timestamp": timestamp, "timestamp_ntz": timestamp}
    return df.select(*(F.date_format(F.col(f"`{n}`"), formats[t]).alias(n) if t in formats else F.col(f"`{n}`") for n, t in df.dtypes))


# The header fields of a common event format line.
CEF_HEADER = ("version", "deviceVendor", "deviceProduct", "deviceVersion", "deviceEventClassId", "name", "severity")


def infer_cef_schema(events: DataFrame, extensions: str = "extension") -> T.StructType:
    """Header fields and every extension key met in any row, with the type inferred for its values."""
    pairs = events.select(F.explode(extensions).alias("k", "v")).select("k", type_code(F.col("v")).alias("code")).groupBy("k").agg(F.collect_set("code").alias("codes"))
    found = sorted((r.k, widen(set(r.codes))) for r in pairs.collect())
    head = [T.StructField(n, T.IntegerType() if n in ("version", "severity") else T.StringType()) for n in CEF_HEADER]
    return T.StructType([*head, *(T.StructField(k, T._parse_datatype_string(_SPARK[code])) for k, code in found)])
