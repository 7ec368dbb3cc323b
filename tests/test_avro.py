import datetime
import decimal
import json
import struct

import pytest
from millrace.sources import avro

ROWS = [
    (1, "é", 1.5, True, b"\x00\xff", decimal.Decimal("-12.34"), datetime.date(1969, 12, 31), datetime.datetime(2024, 1, 2, 3, 4, 5, 678901), [1, None, -(1 << 62)], {"k": "v", "n": None}, (7, [("x",)])),
    (-5, "", float("-inf"), False, b"", decimal.Decimal("0.00"), datetime.date(2100, 1, 1), datetime.datetime(1900, 1, 1), [], {}, (None, [])),
    (None,) * 11,
]
SCHEMA = "i long, s string, d double, b boolean, x binary, n decimal(20,2), day date, t timestamp, l array<long>, m map<string,string>, r struct<a:int,q:array<struct<z:string>>>"


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_all_types_come_back(spark, tmp_path, codec):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = str(tmp_path / "a")
    avro.write_avro(df.repartition(2), path, codec=codec, block_rows=1)
    back = avro.read_avro(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    avro.write_avro(df.limit(0), path, mode="overwrite")
    assert avro.read_avro(spark, path).count() == 0 and avro.read_avro(spark, path).columns == df.columns


def foreign(schema, sync, *blocks):
    """A file as another program writes it: one with a marker of any bytes."""
    meta = {"avro.schema": json.dumps(schema).encode()}
    head = avro.MAGIC + avro._put_long(len(meta)) + b"".join(avro._put_bytes(k.encode()) + avro._put_bytes(v) for k, v in meta.items()) + b"\x00" + sync
    return head + b"".join(avro._put_long(n) + avro._put_bytes(data) + sync for n, data in blocks)


def test_files_of_others(spark, tmp_path, monkeypatch):
    schema = {"type": "record", "name": "a.b.Row", "fields": [
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}}, {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}}, {"name": "u", "type": ["int", "null", "string"]},
        {"name": "again", "type": "a.b.E"}, {"name": "g", "type": "float"}, {"name": "ms", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    ]}
    one = b"\x02" + b"ab" + b"\x00\x0e" + b"\x00" + struct.pack("<f", 0.5) + avro._put_long(1000)
    two = b"\x00" + b"\n\r" + b"\x04\x04hi" + b"\x02" + struct.pack("<f", -1) + avro._put_long(-1)
    for i in range(3):
        (tmp_path / f"{i}.avro").write_bytes(foreign(schema, bytes([200 + i, 10, 13, 0, 255] + [i] * 11), (2, one + two), (1, one)))
    want = [("Y", b"ab", (7, None), "X", 0.5, 1.0)] * 6 + [("X", b"\n\r", (None, "hi"), "Y", -1.0, -0.001)] * 3

    def rows():
        df = avro.read_avro(spark, str(tmp_path))
        return sorted((r.e, bytes(r.f), tuple(r.u), r.again, r.g, r.ms) for r in df.withColumn("ms", df.ms.cast("double")).collect())

    assert rows() == sorted(want, key=str) or sorted(rows(), key=str) == sorted(want, key=str)
    monkeypatch.setattr(avro, "MOST_SCANS", 2)
    assert sorted(rows(), key=str) == sorted(want, key=str)


def test_resolution_and_what_cannot_be(spark, tmp_path):
    path = str(tmp_path / "a")
    avro.write_avro(spark.createDataFrame([(1, "x")], "i int, s string"), path)
    of = lambda *fields: json.dumps({"type": "record", "name": "row", "fields": list(fields)})
    got = avro.read_avro(spark, path, of({"name": "s", "type": ["null", "bytes"]}, {"name": "j", "aliases": ["i"], "type": ["null", "double"]}, {"name": "d", "type": {"type": "array", "items": "int"}, "default": [4]}, {"name": "u", "type": ["string", "int"], "default": "q"})).first()
    assert (bytes(got.s), got.j, got.d, tuple(got.u)) == (b"x", 1.0, [4], ("q", None))
    for bad in ({"name": "i", "type": "string"}, {"name": "none", "type": "int"}):
        with pytest.raises(Exception, match="cannot be read as|none of the reader|no default"):
            avro.read_avro(spark, path, of(bad)).collect()


def test_damaged_blocks_are_reported(spark, tmp_path):
    schema = {"type": "record", "name": "r", "fields": [{"name": "s", "type": "string"}]}
    good, short = avro._put_bytes(b"fine"), b"\x50ab"
    (tmp_path / "a.avro").write_bytes(foreign(schema, b"0123456789abcde\n", (1, good), (1, short), (3, good), (1, good)))
    rows, damaged = avro.read_blocks(spark, str(tmp_path))
    assert [r.s for r in rows.collect()] == ["fine", "fine"] and damaged.count() == 2
    with pytest.raises(Exception, match="a.avro"):
        avro.read_avro(spark, str(tmp_path)).collect()
    (tmp_path / "b.avro").write_bytes(b"no")
    with pytest.raises(ValueError):
        avro.read_avro(spark, str(tmp_path))


def test_one_file_is_many_tasks(spark, tmp_path):
    path = str(tmp_path / "a")
    avro.write_avro(spark.range(50_000).coalesce(1), path, codec="null", block_rows=500)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = avro.read_avro(spark, path)
        assert df.rdd.getNumPartitions() > 3 and df.count() == df.distinct().count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
