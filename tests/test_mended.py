"""Odd inputs that once gave wrong rows, lost rows or failures."""

import bz2
import json
import lzma

import pytest
from millrace.operators import analytics, hl7, records, text
from millrace.sources import readers, writers
from pyspark.sql import functions as F


def test_other_events_delete_nothing(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    events = spark.createDataFrame([(1, 1, "ddl", None), (2, 2, "update", "c"), (2, 3, "begin", None), (None, 4, "update", "m")], "k int, s int, op string, v string")
    assert sorted(map(str, (tuple(r) for r in analytics.merge_cdc(table, events, ["k"], "s", "op", ["v"]).collect()))) == ["(1, 'a')", "(2, 'c')", "(None, 'm')"]


def test_incomplete_texts_are_failures(spark):
    rows = [("two", 0, 2, "x"), ("two", 0, 2, "y"), ("gap", 0, 3, "a"), ("gap", 2, 3, "c"), ("ok", 0, 2, "a"), ("ok", 1, 2, "b"), ("ok", 1, 2, "b"), ("one", 1, 2, "a"), ("one", 2, 2, "b"), ("far", 0, 2, "a"), ("far", 5, 2, "b"), ("count", 0, 2, "a"), ("count", 1, 3, "b"), ("null", None, 1, "a"), (None, 0, 1, "z")]
    df = spark.createDataFrame(rows, "id string, i int, n int, v string")
    assert sorted((str(r.id), r.v) for r in records.defragment(df, "id", "i", "n", "v").collect()) == [("None", "z"), ("ok", "ab"), ("one", "ab")]
    problems = {r.id: r.problem for r in records.defragment_failures(df, "id", "i", "n", "v").collect()}
    assert problems == {"two": "two values at one index", "gap": "parts are missing", "far": "an index is out of range", "count": "parts say different numbers of parts", "null": "a part has no index"}


@pytest.mark.parametrize("first,rows,want", [(5, [3, 5, 6], ["skipped", "released", "released"]), (0, [None, 0, 1], ["invalid", "released", "released"]), (0, [0, 0, 2], ["released", "skipped", "waiting"])])
def test_order_from_a_first_number(spark, first, rows, want):
    df = spark.createDataFrame([("g", s, i) for i, s in enumerate(rows)], "g string, s int, i int")
    assert [r.outcome for r in analytics.enforce_order(df, "g", "s", first).orderBy("i").collect()] == want


def test_repeated_names_and_keys(spark):
    one = lambda value: spark.createDataFrame([(value,)], "v string")
    got = text.parse_syslog_5424(one('<1>1 - h a p m [x ip="1" ip="2"][x ip="3" b="4"] t'), "v").first()
    assert got.structured_data == {"x.ip": "3", "x.b": "4"} and got.valid
    assert text.parse_syslog_5424(one("<1>1 - h a p m - t"), "v").first().structured_data == {}
    got = text.parse_cef(one("CEF:0|v|p|1|i|n|5|src=1 src=2 a=b"), "v").first()
    assert got.extension == {"src": "2", "a": "b"}
    assert text.parse_cef(one("no"), "v").first().extension is None and text.parse_cef(one(None), "v").first().valid is False


def test_grok_classes(spark):
    assert text.expand_grok("[(]%{WORD:n}[)]") == (r"[(](\b\w+\b)[)]", ["n"])
    assert text.expand_grok(r"\Q(\E(a)[]()](?<x>b)\(")[0] == r"\Q(\E(?:a)[]()](?<x>b)\("
    df = spark.createDataFrame([(":ab)",), ("(ab)",)], "v string")
    assert [r.n for r in text.extract_grok(df, "v", "[(]%{WORD:n}[)]").collect()] == [None, "ab"]


def test_words_of_any_script(spark):
    df = spark.createDataFrame([("le café noir",), ("чай и кофе",)], "t string")
    mapping = spark.createDataFrame([("café", "bar"), ("чай", "сок"), ("caf", "X")], "word string, replacement string")
    assert sorted(r.t for r in text.replace_with_mapping(df, "t", ["t"], mapping).collect()) == ["le bar noir", "сок и кофе"]
    assert None not in [r[0] for r in spark.createDataFrame([("Привет",), ("你好",)], "t string").select(text.fuzzy_hash(F.col("t"))).collect()]


def test_hl7_numbers_and_separators(spark):
    message = "MSH|^~\\&|app|fac|to|there|2024||ADT^A01|ID7|P\rPID|1||a^b~c^d&e|x\\T\\y\\.br\\z\\X41\\\\E\\F\\|\rOBX|"
    df = spark.createDataFrame([(1, message), (2, "PID|1|x"), (3, None), (4, "")], "k int, m string")
    one = lambda segment, **fields: [tuple(r)[2:] for r in hl7.select(df, "m", ["k"], segment, fields).orderBy("k").collect()]
    assert one("MSH", a="MSH-1", b="MSH-2", c="MSH-9", d="MSH-9.1", e=10, f="MSH-3") == [("|", "^~\\&", "ADT^A01", "ADT", "ID7", "app")]
    assert one("PID", a="PID-3", b="PID-3[2].1", c="PID-3[2].2.2", d="PID-3.2", e="PID-4", f="PID-5", g="PID-9", h="PID-3[2]")[0] == ("a^b~c^d&e", "c", "e", "b", "x&y\nzA\\F\\", "", None, "c^d&e")
    assert one("PID", a=2) == [("",), ("x",)]
    with pytest.raises(ValueError):
        hl7.select(df, "m", ["k"], "PID", {"a": "MSH-1"})
    with pytest.raises(ValueError):
        hl7.value_at("PID-0")


def test_xml_elements_by_name(spark):
    check = lambda xml, schema, **more: text.validate_xml(spark.createDataFrame([(xml,)], "x string"), "x", schema, **more).first()[1:]
    assert check("<r><b>1</b></r>", "a bigint") == (False, "r: unknown element b; r: no element a")
    assert check("<r><a>1</a></r>", "a bigint") == (True, None)
    assert check("<r/>", "a bigint", required=False) == (True, None)
    assert check("<r><a>", "a bigint")[1].startswith("not well-formed")
    assert check(None, "a bigint") == (False, "no text")
    assert check('<r k="1"><a>300</a></r>', "_k int, a tinyint") == (False, "r/a: not a tinyint")


def test_arrays_of_nothing_are_json(spark, tmp_path):
    for name, df in (("none", spark.range(0)), ("some", spark.range(0, 3, 1, 5))):
        writers.write_json(df, str(tmp_path / name), "array")
        found = [x for p in sorted((tmp_path / name).glob("part-*")) for x in json.loads(p.read_text())]
        assert found == [{"id": i} for i in range(df.count())] and list((tmp_path / name).glob("part-*"))


def test_saved_maximum_is_a_number(spark):
    state = spark.createDataFrame([("t", "9"), ("t", "10")], "name string, value string")
    fresh, new = readers.read_incremental(spark.range(8, 12), "id", state, "t")
    assert [r.id for r in fresh.collect()] == [11] and new.first().value == "11"


def test_short_values_are_packed_with_short_tables():
    """The packed bytes of a short value say how large the tables are that packing it took."""
    for value in (b"", b"large ring", b"ab" * 2000, b"x" * 100_000, bytes(range(256)) * 4000):
        packed = {kind: text._codec(kind)[0](value, 6) for kind in ("bzip2", "xz", "lzma")}
        assert all(text._codec(kind)[1](p) == value for kind, p in packed.items())
        assert len(packed["bzip2"]) == len(bz2.compress(value, 6)) and len(packed["xz"]) == len(lzma.compress(value, preset=6))
        short = len(value) <= 4096
        assert (int.from_bytes(packed["lzma"][1:5], "little") == 4096) == short
        assert (packed["bzip2"][:4] == b"BZh1") == short


def test_values_that_repeat_in_a_batch_are_packed_once(spark, tmp_path):
    calls = tmp_path / "calls"

    def noted(value):
        with open(calls, "ab") as out:
            out.write(b".")
        if value == b"2":
            raise ValueError
        return value * 2

    df = spark.range(0, 3000, 1, 1).select("id", F.when(F.col("id") % 4 < 3, (F.col("id") % 4).cast("string")).alias("v"))
    got = {(r.id % 4, None if r.w is None else bytes(r.w)) for r in df.select("id", text._per_row(F.col("v"), noted).alias("w")).collect()}
    assert got == {(0, b"00"), (1, b"11"), (2, None), (3, None)} and calls.stat().st_size == 3
    assert df.filter(F.lit(False)).select(text._per_row(F.col("v"), noted)).collect() == []
