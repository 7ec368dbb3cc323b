"""Avro container files without Spark's connector: blocks are coded in Arrow batches.

Writing: a partition's rows become blocks of a file, which Spark's text writer
stores on any file system.  Each block goes out as one line: the sync marker ends
with the writer's line end.

Reading: Spark's text reader cuts files at the sync marker, so a long file is many
tasks.  Only the first bytes of each file are read beforehand, for its schema and
marker; files that share both, as those of one written table do, are one scan.
Where there are more kinds than ``MOST_SCANS``, files are read whole instead, one
task each.  Values are resolved from the schema they were written with to the
reader's: fields by name or alias, defaults, widened numbers, texts and bytes,
and any member of a union.

Codecs are ``null`` and ``deflate``.  A block whose length is not that which it
says, or that cannot be decoded, is damaged: an error, or a row of the second
result of ``read_blocks``.

Types: null, boolean, int, long, float, double, bytes, string, fixed, enum, array,
map, record, union, and the logical types date, timestamp-millis, timestamp-micros,
their local forms, decimal and uuid; other logical types are read as what they
rest on.  A union of null and one type is a column that may be null; one of
several types is a record with a field for each, ``member0`` and so on.
"""

from __future__ import annotations

import datetime
import decimal
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAGIC = b"Obj\x01"
BLOCK_ROWS = 4096
MOST_SCANS = 64
#: First bytes of a file in which its header has to end.
HEADER_BYTES = 1 << 20
_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
_DAY0 = datetime.date(1970, 1, 1)
Decoder = Callable[[bytes, int], tuple[object, int]]


class DamagedBlock(ValueError):
    """A block that is not what it says it is."""


# --- numbers and bytes -------------------------------------------------------


def _long(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7
        if shift > 63:
            raise DamagedBlock("a number is too long")


def _put_long(value: int) -> bytes:
    value, out = (value << 1) ^ (value >> 63), bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _bytes(data: bytes, at: int) -> tuple[bytes, int]:
    size, at = _long(data, at)
    if size < 0 or at + size > len(data):
        raise DamagedBlock("a value goes over the block's end")
    return data[at : at + size], at + size


def _put_bytes(value: bytes) -> bytes:
    return _put_long(len(value)) + value


# --- schemas -----------------------------------------------------------------


def _named(schema: object, known: dict[str, dict], space: str = "") -> object:
    """The schema with names resolved: each record, enum and fixed is the one object that defines it."""
    if isinstance(schema, list):
        return [_named(s, known, space) for s in schema]
    if isinstance(schema, str):
        return known.get(schema) or known.get(f"{space}.{schema}") or {"type": schema}
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return _named(kind, known, space)
    if kind in ("record", "error", "enum", "fixed"):
        space = schema.get("namespace", schema["name"].rpartition(".")[0] or space)
        made = known[schema["name"]] = known[f"{space}.{schema['name'].rpartition('.')[2]}"] = dict(schema)
        if "fields" in schema:
            made["fields"] = [dict(f, type=_named(f["type"], known, space)) for f in schema["fields"]]
        return made
    inner = {"array": "items", "map": "values"}.get(kind)
    return dict(schema, **{inner: _named(schema[inner], known, space)}) if inner else schema


def parse_schema(text: str) -> object:
    return _named(json.loads(text), {})


def spark_type(schema: object) -> T.DataType:
    """The Spark type of values of a schema."""
    if isinstance(schema, list):
        members = [s for s in schema if s["type"] != "null"]
        if len(members) == 1:
            return spark_type(members[0])
        return T.StructType([T.StructField(f"member{i}", spark_type(s)) for i, s in enumerate(members)]) if members else T.NullType()
    kind, logical = schema["type"], schema.get("logicalType")
    if logical == "decimal" and kind in ("bytes", "fixed"):
        return T.DecimalType(schema["precision"], schema.get("scale", 0))
    if logical == "date" and kind == "int":
        return T.DateType()
    if logical in ("timestamp-millis", "timestamp-micros") and kind == "long":
        return T.TimestampType()
    if logical in ("local-timestamp-millis", "local-timestamp-micros") and kind == "long":
        return T.TimestampNTZType()
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"])) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"]))
    return {"null": T.NullType, "boolean": T.BooleanType, "int": T.IntegerType, "long": T.LongType, "float": T.FloatType, "double": T.DoubleType, "bytes": T.BinaryType, "string": T.StringType, "fixed": T.BinaryType, "enum": T.StringType}[kind]()


def avro_schema(kind: T.DataType, name: str = "row", nullable: bool = False) -> object:
    """The schema that values of a Spark type are written with."""
    if isinstance(kind, T.StructType):
        made: object = {"type": "record", "name": name, "fields": [{"name": f.name, "type": avro_schema(f.dataType, f"{name}_{i}", f.nullable)} | ({"default": None} if f.nullable else {}) for i, f in enumerate(kind.fields)]}
    elif isinstance(kind, T.ArrayType):
        made = {"type": "array", "items": avro_schema(kind.elementType, f"{name}_e", kind.containsNull)}
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("keys of maps have to be texts")
        made = {"type": "map", "values": avro_schema(kind.valueType, f"{name}_v", kind.valueContainsNull)}
    elif isinstance(kind, T.DecimalType):
        made = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    else:
        plain = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.BinaryType: "bytes", T.StringType: "string", T.NullType: "null"}
        logical = {T.DateType: ("int", "date"), T.TimestampType: ("long", "timestamp-micros"), T.TimestampNTZType: ("long", "local-timestamp-micros")}
        if type(kind) in logical:
            made = dict(zip(("type", "logicalType"), logical[type(kind)]))
        elif type(kind) in plain:
            made = {"type": plain[type(kind)]}
        else:
            raise ValueError(f"no Avro type for {kind.simpleString()}")
    return [{"type": "null"}, made] if nullable and made != {"type": "null"} else made


# --- values ------------------------------------------------------------------


def _to_value(schema: dict) -> Callable[[object], object] | None:
    """What turns a decoded primitive into the value of its logical type."""
    logical, made = schema.get("logicalType"), spark_type(schema)
    if isinstance(made, T.DecimalType):
        return lambda v: decimal.Decimal(int.from_bytes(v, "big", signed=True)).scaleb(-made.scale, decimal.Context(prec=40))
    if isinstance(made, T.DateType):
        return lambda v: _DAY0 + datetime.timedelta(days=v)
    if isinstance(made, (T.TimestampType, T.TimestampNTZType)):
        unit, zone = (1000 if logical.endswith("millis") else 1), _EPOCH if isinstance(made, T.TimestampType) else _EPOCH.replace(tzinfo=None)
        return lambda v: zone + datetime.timedelta(microseconds=v * unit)
    return None


def _skip(schema: object) -> Decoder:
    return _decoder(schema, schema)


def _default(schema: object, value: object) -> object:
    if isinstance(schema, list):
        members = [s for s in schema if s["type"] != "null"]
        if value is None or not members:
            return None
        # a default is one of the union's first member
        first = _default(schema[0], value)
        return first if len(members) == 1 else {"member0": first} | {f"member{i}": None for i in range(1, len(members))}
    kind = schema["type"]
    if kind == "record":
        return {f["name"]: _default(f["type"], value[f["name"]] if f["name"] in value else f.get("default")) for f in schema["fields"]}
    if kind == "array":
        return [_default(schema["items"], v) for v in value]
    if kind == "map":
        return [(k, _default(schema["values"], v)) for k, v in value.items()]
    if kind in ("bytes", "fixed"):
        value = value.encode("latin-1")
    turn = _to_value(schema)
    return turn(value) if turn else value


def _decoder(writer: object, reader: object) -> Decoder:
    """What reads a value written by one schema as a value of another."""
    if isinstance(writer, list):
        branches = []
        for member in writer:
            try:
                branches.append(_decoder(member, reader))
            except ValueError as e:
                branches.append(e)

        def union(data: bytes, at: int) -> tuple[object, int]:
            i, at = _long(data, at)
            if not 0 <= i < len(branches):
                raise DamagedBlock("no such member of a union")
            if isinstance(branches[i], ValueError):
                raise branches[i]
            return branches[i](data, at)

        return union
    if isinstance(reader, list):
        members = [s for s in reader if s["type"] != "null"]
        if writer["type"] == "null":
            if len(members) == len(reader):
                raise ValueError("a null where the reader's schema has none")
            return lambda data, at: (None, at)
        exact = [i for i, m in enumerate(members) if m["type"] == writer["type"] and m.get("name") == writer.get("name")]
        for i in [*exact, *range(len(members))]:
            try:
                one = _decoder(writer, members[i])
            except ValueError:
                continue
            if len(members) == 1:
                return one
            empty = {f"member{k}": None for k in range(len(members))}

            def member(data: bytes, at: int, i: int = i, one: Decoder = one) -> tuple[object, int]:
                value, at = one(data, at)
                return empty | {f"member{i}": value}, at

            return member
        raise ValueError(f"{writer['type']} is none of the reader's members")
    w, r = writer["type"], reader["type"]
    if w == r == "record":
        return _record_decoder(writer, reader)
    if w == r == "array":
        item = _decoder(writer["items"], reader["items"])
        return lambda data, at: _blocks(data, at, item)
    if w == r == "map":
        one = _decoder(writer["values"], reader["values"])

        def pair(data: bytes, at: int) -> tuple[object, int]:
            key, at = _bytes(data, at)
            value, at = one(data, at)
            return (key.decode(), value), at

        return lambda data, at: _blocks(data, at, pair)
    if w == r == "enum":
        symbols = [s if s in reader["symbols"] else reader.get("default") for s in writer["symbols"]]

        def symbol(data: bytes, at: int) -> tuple[object, int]:
            i, at = _long(data, at)
            if not 0 <= i < len(symbols) or symbols[i] is None:
                raise ValueError("a symbol that the reader's schema does not have")
            return symbols[i], at

        return symbol
    widened = {"int": ("int", "long", "float", "double"), "long": ("long", "float", "double"), "float": ("float", "double"), "string": ("string", "bytes"), "bytes": ("bytes", "string")}
    if r not in widened.get(w, (w,)) or (w == "fixed" and writer["size"] != reader["size"]):
        raise ValueError(f"{w} cannot be read as {r}")
    turn = _to_value(reader)
    plain = _primitive(writer)
    change = {("string", "bytes"): str.encode, ("bytes", "string"): bytes.decode}.get((w, r)) or (float if r in ("float", "double") and w in ("int", "long") else None)
    if not turn and not change:
        return plain
    both = (lambda v: turn(change(v))) if turn and change else turn or change

    def turned(data: bytes, at: int) -> tuple[object, int]:
        value, at = plain(data, at)
        return both(value), at

    return turned


def _primitive(schema: dict) -> Decoder:
    kind = schema["type"]
    if kind in ("int", "long"):
        return _long
    if kind == "bytes":
        return _bytes
    if kind == "null":
        return lambda data, at: (None, at)
    if kind == "boolean":
        return lambda data, at: (data[at] == 1, at + 1)
    if kind == "string":

        def text(data: bytes, at: int) -> tuple[object, int]:
            value, at = _bytes(data, at)
            return value.decode(), at

        return text
    if kind == "fixed":
        size = schema["size"]

        def fixed(data: bytes, at: int) -> tuple[object, int]:
            if at + size > len(data):
                raise DamagedBlock("a value goes over the block's end")
            return data[at : at + size], at + size

        return fixed
    form = {"float": struct.Struct("<f"), "double": struct.Struct("<d")}[kind]
    return lambda data, at: (form.unpack_from(data, at)[0], at + form.size)


def _blocks(data: bytes, at: int, item: Decoder) -> tuple[list, int]:
    out = []
    while True:
        n, at = _long(data, at)
        if n == 0:
            return out, at
        if n < 0:
            n, (_, at) = -n, _long(data, at)
        for _ in range(n):
            value, at = item(data, at)
            out.append(value)


def _record_decoder(writer: dict, reader: dict) -> Decoder:
    wanted = {n: f for f in reader["fields"] for n in (f["name"], *f.get("aliases", ()))}
    steps, found = [], set()
    for f in writer["fields"]:
        to = wanted.get(f["name"])
        found.add(to["name"] if to else None)
        steps.append((to["name"] if to else None, _decoder(f["type"], to["type"]) if to else _skip(f["type"])))
    rest = {}
    for f in reader["fields"]:
        if f["name"] not in found:
            if "default" not in f:
                raise ValueError(f"field {f['name']} is not in the file and has no default")
            rest[f["name"]] = _default(f["type"], f["default"])

    def record(data: bytes, at: int) -> tuple[object, int]:
        out = dict(rest)
        for name, step in steps:
            value, at = step(data, at)
            if name is not None:
                out[name] = value
        return out, at

    return record


def _encoder(schema: object) -> Callable[[object], bytes]:
    """What writes a value as Arrow gives it."""
    if isinstance(schema, list):
        nulls = [i for i, s in enumerate(schema) if s["type"] == "null"]
        members = [(i, _encoder(s)) for i, s in enumerate(schema) if s["type"] != "null"]

        def union(v: object) -> bytes:
            if v is None:
                return _put_long(nulls[0])
            if len(members) == 1:
                return _put_long(members[0][0]) + members[0][1](v)
            for k, (i, one) in enumerate(members):
                if v[f"member{k}"] is not None:
                    return _put_long(i) + one(v[f"member{k}"])
            return _put_long(nulls[0])

        return union
    kind, made = schema["type"], spark_type(schema)
    if kind == "record":
        fields = [(f["name"], _encoder(f["type"])) for f in schema["fields"]]
        return lambda v: b"".join([one(v[n]) for n, one in fields])
    if kind in ("array", "map"):
        one = _encoder(schema["items" if kind == "array" else "values"])
        put = one if kind == "array" else lambda kv: _put_bytes(kv[0].encode()) + one(kv[1])
        return lambda v: (_put_long(len(v)) + b"".join(map(put, v)) if len(v) else b"") + b"\x00"
    if isinstance(made, T.DecimalType):
        size = schema.get("size")

        def number(v: decimal.Decimal) -> bytes:
            whole = int(v.scaleb(made.scale, decimal.Context(prec=40)))
            raw = whole.to_bytes(size or (whole.bit_length() // 8 + 1), "big", signed=True)
            return raw if size else _put_bytes(raw)

        return number
    if isinstance(made, T.DateType):
        return lambda v: _put_long((v - _DAY0).days)
    if isinstance(made, (T.TimestampType, T.TimestampNTZType)):
        unit = 1000 if schema["logicalType"].endswith("millis") else 1
        zone = _EPOCH if isinstance(made, T.TimestampType) else _EPOCH.replace(tzinfo=None)
        return lambda v: _put_long((v - zone) // datetime.timedelta(microseconds=unit))
    if kind == "enum":
        return lambda v: _put_long(schema["symbols"].index(v))
    return {
        "null": lambda v: b"", "boolean": lambda v: b"\x01" if v else b"\x00", "int": _put_long, "long": _put_long, "float": struct.Struct("<f").pack, "double": struct.Struct("<d").pack,
        "bytes": _put_bytes, "string": lambda v: _put_bytes(v.encode()), "fixed": lambda v: v,
    }[kind]


# --- files -------------------------------------------------------------------


def _codec(name: str) -> tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]:
    if name == "null":
        return bytes, bytes
    if name == "deflate":

        def pack(data: bytes) -> bytes:
            c = zlib.compressobj(6, zlib.DEFLATED, -15)
            return c.compress(data) + c.flush()

        return pack, lambda data: zlib.decompress(data, -15)
    raise ValueError(f"no codec {name}")


def write_avro(df: DataFrame, path: str, schema: str | None = None, codec: str = "deflate", mode: str = "errorifexists", block_rows: int = BLOCK_ROWS) -> None:
    """A container file for each partition, by the schema of the table or one in JSON."""
    written = avro_schema(df.schema) if schema is None else parse_schema(schema)
    text = schema or json.dumps(written)
    want = spark_type(written)
    # fifteen letters and digits, and the line end of the writer
    sync = uuid.uuid4().hex[:15].encode()
    pack, _ = _codec(codec)
    meta = {"avro.schema": text.encode(), "avro.codec": codec.encode()}
    header = MAGIC + _put_long(len(meta)) + b"".join(_put_bytes(k.encode()) + _put_bytes(v) for k, v in meta.items()) + b"\x00" + sync

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = _encoder(written), True
        for batch in batches:
            blocks = [header] if first else []
            first = False
            for start in range(0, batch.num_rows, block_rows):
                rows = batch.slice(start, block_rows).to_pylist()
                data = pack(b"".join(map(encode, rows)))
                blocks.append(_put_long(len(rows)) + _put_bytes(data) + sync)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])

    own = df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in want.fields))
    blocks = own.mapInArrow(run, "block binary")
    # a string of any bytes: the text writer stores it as it is; the first partition is a file even without rows
    empty = df.sparkSession.createDataFrame([(header,)], "block binary").coalesce(1)
    empty.union(blocks).select(F.col("block").cast("string").alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def _header(data: bytes) -> tuple[dict[str, bytes], bytes]:
    """(metadata, sync marker) of a file's first bytes."""
    if not data.startswith(MAGIC):
        raise ValueError("not an Avro container file")
    pairs, at = _blocks(data, 4, lambda d, a: (lambda k, b: ((k.decode(), _bytes(d, b)[0]), _bytes(d, b)[1]))(*_bytes(d, a)))
    return dict(pairs), data[at : at + 16]


def _headers(spark: SparkSession, path: str) -> dict[tuple[bytes, str, str], list[str]]:
    """Files by (marker, schema, codec); a header is read from each."""
    found: dict[tuple[bytes, str, str], list[str]] = {}
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for (file,) in spark.read.format("binaryFile").load(path).select("path").collect():
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream = at.getFileSystem(conf).open(at)
        try:
            data = bytes(stream.readNBytes(HEADER_BYTES))
        finally:
            stream.close()
        meta, sync = _header(data)
        found.setdefault((sync, meta["avro.schema"].decode(), meta.get("avro.codec", b"null").decode()), []).append(file)
    return found


def _rows_of(chunk: bytes, decode: Decoder, unpack: Callable[[bytes], bytes]) -> list[object]:
    n, at = _long(chunk, 0)
    data, at = _bytes(chunk, at)
    if at != len(chunk):
        raise DamagedBlock("a block's length is not what it says")
    data, at, rows = unpack(data), 0, []
    for _ in range(n):
        row, at = decode(data, at)
        rows.append(row)
    if at != len(data):
        raise DamagedBlock("a block has more than its rows")
    return rows


def _read(spark: SparkSession, path: str, schema: str | None, strict: bool) -> DataFrame:
    files = _headers(spark, path)
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    reader = parse_schema(schema) if schema else parse_schema(next(iter(files))[1])
    kind = spark_type(reader)
    if len(files) > MOST_SCANS:
        whole = spark.read.format("binaryFile").load(path).select(F.col("content").alias("chunk"), F.col("path").alias("file"))
        return _decoded(whole, kind, None, reader, None, strict)
    parts = []
    for (sync, text, codec), paths in files.items():
        scan = spark.read.option("lineSep", sync.decode("latin-1")).option("encoding", "ISO-8859-1").text(paths)
        chunks = scan.select(F.col("value").cast("binary").alias("chunk"), F.col("_metadata.file_path").alias("file"))
        parts.append(_decoded(chunks, kind, text, reader, codec, strict))
    return reduce(DataFrame.unionByName, parts)


def read_blocks(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged): all rows of sound blocks, and (file, problem) of each other one."""
    out = _read(spark, path, schema, False)
    return out.filter("problem IS NULL").select("row.*"), out.filter("problem IS NOT NULL").select("file", "problem")


def _decoded(chunks: DataFrame, kind: T.StructType, text: str | None, reader: object, codec: str | None, strict: bool) -> DataFrame:
    """(file, problem, row) of chunks between markers, or of whole files without a schema of their own."""
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("problem", T.StringType()), T.StructField("row", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        decode, unpack = (_decoder(parse_schema(text), reader), _codec(codec)[1]) if text is not None else (None, None)
        for batch in batches:
            for chunk, file in zip(batch.column(0), batch.column(1).to_pylist()):
                pieces, one, open_ = [chunk.as_py()], decode, unpack
                if text is None:
                    meta, sync = _header(pieces[0])
                    pieces = pieces[0].split(sync)
                    one, open_ = _decoder(parse_schema(meta["avro.schema"].decode()), reader), _codec(meta.get("avro.codec", b"null").decode())[1]
                for piece in pieces:
                    if not piece or piece.startswith(MAGIC):
                        continue
                    try:
                        rows = [(file, None, r) for r in _rows_of(piece, one, open_)]
                    except (DamagedBlock, zlib.error, IndexError, UnicodeDecodeError, OverflowError, struct.error) as e:
                        if strict:
                            raise DamagedBlock(f"{file}: {type(e).__name__}: {e}") from e
                        rows = [(file, f"{type(e).__name__}: {e}", None)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return chunks.mapInArrow(run, schema)


def read_avro(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows by the schema in the files, or by another in JSON; a damaged block is an error."""
    return _read(spark, path, schema, True).select("row.*")
