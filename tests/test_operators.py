"""Cases that the given tables do not hold."""

import base64
import html as html_module
import json
import urllib.parse
import uuid

import pytest
from millrace.functions import numbers, paths, predicates, strings
from millrace.operators import analytics, geo, jolt, lookup, records, routing, schema, scripts, text
from millrace.sources import readers, writers
from millrace.streaming import streams
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("value,start,end,want", [("hello", 1, 3, "el"), ("hello", 0, None, "hello"), ("hello", 3, 9, ""), ("hello", -1, 2, ""), (None, 0, 1, ""), ("", 0, 0, "")])
def test_substring(spark, value, start, end, want):
    assert one(spark, lambda c: strings.substring(c, start, end), value) == want


@pytest.mark.parametrize("value,start,end,want", [("hello", -3, -1, "lo"), ("hello", 0, 99, "hello"), ("hello", 3, 3, ""), ("hello", -9, 2, ""), (None, 0, 1, None)])
def test_path_substring(spark, value, start, end, want):
    assert one(spark, lambda c: strings.path_substring(c, start, end), value) == want


def test_uuids_and_escapes(spark):
    space = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
    for name in ("", "x", "näme"):
        assert one(spark, lambda c: strings.uuid3(c, space), name) == str(uuid.uuid3(uuid.UUID(space), name))
        assert one(spark, lambda c: strings.uuid5(c, space), name) == str(uuid.uuid5(uuid.UUID(space), name))
    odd = 'a"b\\c/é\n\t<&>© ∑'
    assert json.loads('"' + one(spark, strings.escape_json_text, odd) + '"') == odd
    assert one(spark, strings.unescape_json_text, one(spark, strings.escape_json_text, odd)) == odd
    assert html_module.unescape(one(spark, strings.escape_html4, odd)) == odd
    assert one(spark, strings.unescape_html4, one(spark, strings.escape_html4, odd)) == odd
    assert "∑" in one(spark, strings.escape_html3, odd)
    assert urllib.parse.unquote_plus(one(spark, strings.url_encode, odd)) == odd
    assert one(spark, strings.escape_xml) == ""


def test_text_errors(spark):
    with pytest.raises(ValueError):
        strings.repeat(F.lit("a") if spark else None, 0)
    with pytest.raises(ValueError):
        strings.hash_text(F.lit("a"), "MD4")
    with pytest.raises(ValueError):
        numbers.math(F.lit(1), "nothing")


def test_replace_first_groups(spark):
    assert one(spark, lambda c: strings.replace_first(c, "(b)(.)", "[$2$1]"), "abcbd") == "a[cb]bd"
    assert one(spark, lambda c: strings.replace_first(c, "x", "y"), "abc") == "abc"


def test_json_edits(spark):
    doc = '{"a":{"l":[1,2]},"b":1}'
    assert json.loads(one(spark, lambda c: numbers.json_path_add(c, "$.a.l", 3), doc))["a"]["l"] == [1, 2, 3]
    assert json.loads(one(spark, lambda c: numbers.json_path_delete(c, "$.a.l[0]"), doc))["a"]["l"] == [2]
    assert one(spark, lambda c: numbers.json_path_set(c, "$.zz", 3), doc) == doc
    assert one(spark, lambda c: numbers.json_path_set(c, "$.b", 3), "not json") == "not json"
    assert one(spark, lambda c: numbers.json_path(c, "$.a.l"), doc) == "[1,2]"


@pytest.mark.parametrize("value,code", [("1", "INT"), ("-5", "INT"), ("3000000000", "LONG"), ("99999999999999999999", "DECIMAL"), ("1.5", "FLOAT"), ("-1.5", "DOUBLE"), ("1e60", "DOUBLE"), ("true", "BOOLEAN"), ("2020-01-02", "DATE"), ("10:20:30", "TIME"), ("2020-01-02 10:20:30", "TIMESTAMP"), ("2020-13-02", "STRING"), ("x", "STRING"), ("", None), (None, None)])
def test_type_codes(spark, value, code):
    assert one(spark, schema.type_code, value) == code


def test_widening():
    assert schema.widen({"INT", "LONG"}) == "LONG" and schema.widen({"INT", "FLOAT", "DOUBLE"}) == "DOUBLE"
    assert schema.widen({"INT", "BOOLEAN"}) == "CHOICE" and schema.widen({"INT", "STRING"}) == "STRING" and schema.widen(set()) == "STRING"
    a, b = T._parse_datatype_string("r struct<x:int>, v int"), T._parse_datatype_string("r struct<y:string>, v string")
    merged = schema.merge_schemas(a, b)
    assert merged["r"].dataType.simpleString() == "struct<x:int,y:string>" and isinstance(merged["v"].dataType, T.VariantType)


def test_validation(spark):
    df = spark.createDataFrame([(1, "ACTIVE", 1), (None, "ODD", 2)], "id int, status string, extra int")
    want = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("status", T.StringType(), True, {"enum": ["ACTIVE", "INACTIVE"]}), T.StructField("gone", T.StringType(), False)])
    errors = {r.extra: sorted((e.field, e.error) for e in r.errors) for r in df.withColumn("errors", schema.validation_errors(df, want)).collect()}
    assert errors[1] == [("extra", "EXTRA_FIELD"), ("gone", "MISSING_FIELD")]
    assert errors[2] == [("extra", "EXTRA_FIELD"), ("gone", "MISSING_FIELD"), ("id", "MISSING_FIELD"), ("status", "INVALID_FIELD")]


def test_convert_nested(spark):
    df = spark.createDataFrame([((1, "a"), [("x", 1)])], "r struct<i:int,s:string>, l array<struct<k:string,v:int>>")
    out = schema.convert_record(df, T._parse_datatype_string("r struct<s:string,n:double>, l array<struct<v:string>>")).first()
    assert (out.r.s, out.r.n, out.l[0].v) == ("a", None, "1")


def test_predicates_are_never_null(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    a, b = F.col("a"), F.col("b")
    tests = [predicates.contains(a, F.lit("x")), predicates.matches(a, "x"), predicates.gt(b, F.lit(1)), predicates.is_in(a, "x"), predicates.path_less(a, b), predicates.any_delimited(a, ",", lambda x: x == "y"), predicates.negate(b > 1), predicates.path_equals(a, a, T.StringType(), T.StringType())]
    assert list(df.select(*tests).first()) == [False] * 6 + [True, True]


def test_merge_bins_close_on_bytes(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 5, 20, 1])] + [(2, 0, 3)], "k int, i int, s int")
    out = {(r.k, r.i): r.bin for r in records.merge_bins(df, "k", ["i"], 10, 11, F.col("s")).collect()}
    assert out == {(1, 0): 0, (1, 1): 0, (1, 2): 1, (1, 3): 2, (1, 4): 3, (2, 0): 0}


def test_jolt_errors(spark):
    with pytest.raises(ValueError):
        jolt.chain(spark.range(1), [])
    with pytest.raises(ValueError):
        jolt.cardinality(spark.range(1), {"id": "TWO"})


def test_lookup_errors(spark):
    with pytest.raises(ValueError):
        lookup.unique_keys(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), "k")
    with pytest.raises(ValueError):
        lookup.unique_keys(spark.createDataFrame([(" ", 1)], "k string, v int"), "k")


def test_range_lookup_equals_brute_force(spark):
    import random

    rng = random.Random(9)
    ranges = [(s := rng.randrange(-3000, 100000), s + rng.choice([0, 3, 50, 5000, 90000]), f"r{i}") for i in range(60)]
    values = [(i, rng.randrange(-4000, 200000)) for i in range(500)] + [(900, None)]
    df = lookup.lookup_range(spark.createDataFrame(values, "i int, v long"), "v", spark.createDataFrame(ranges, "s long, e long, name string"), "s", "e", ["name"], width=16)
    for r in df.collect():
        hits = [(e - s, s, n) for s, e, n in ranges if r.v is not None and s <= r.v <= e]
        assert (r.name is None) == (not hits)
        if hits:
            assert (min(hits)[0], min(hits)[1]) == next((e - s, s) for s, e, n in ranges if n == r.name)
    assert lookup.lookup_range(spark.createDataFrame(values, "i int, v long"), "v", spark.createDataFrame([], "s long, e long, name string"), "s", "e", ["name"]).filter("name IS NOT NULL").count() == 0


def test_refreshing_lookup(spark):
    now, reads = [0.0], []
    table = lookup.RefreshingLookup(lambda: reads.append(1) or spark.range(1), 10, lambda: now[0])
    for now[0] in (0.0, 5.0, 11.0):
        table.get()
    assert len(reads) == 2


def test_grok_and_html(spark):
    pattern, names = text.expand_grok("%{IPV4:ip} (a|b) %{WORD:w}")
    assert names == ["ip", "w"]
    with pytest.raises(ValueError):
        text.expand_grok("%{NOTHING:x}")
    page = '<div class="a b"><p id=x>one <b>two</b><br></p></div><p>three'
    assert text.html_elements(page, "p", "text") == ["one two", "three"]
    assert text.html_elements(page, ".b", "@class") == ["a b"]
    assert text.edit_html(page, "#x", "append", "!") == page.replace("<br>", "<br>!")
    assert text.edit_html(page, "div", "put", "#") == page.replace("</div>", "</div>#")


def test_content_edges(spark):
    assert one(spark, lambda c: text.modify_bytes(c, 1, 1), "abcd") == b"bc"
    assert one(spark, lambda c: text.modify_bytes(c, 3, 3), "abcd") == b""
    assert one(spark, lambda c: text.encode_content(c, "base32"), "abcd") == base64.b32encode(b"abcd").decode()
    assert one(spark, lambda c: text.decode_content(c, "base32"), "not base 32!") is None
    rows = text.segment_content(spark.createDataFrame([("",), ("abcde",)], "t string"), "t", 2).collect()
    assert [bytes(r.segment) for r in rows] == [b"", b"ab", b"cd", b"e"]
    df = spark.createDataFrame([("a",)], "t string")
    assert text.scan_content(df, "t", [" "]).first().matched is False
    assert text.scan_attributes(df, df, "t", [], "all").first().matched is True


def test_fuzzy_hash_is_close_for_close_texts(spark):
    base = " ".join(f"word{i}" for i in range(200))
    df = spark.createDataFrame([(base, base.replace("word7 ", "other "), " ".join(f"else{i}" for i in range(200)))], "a string, b string, c string")
    h = {c: text.fuzzy_hash(F.col(c)) for c in "abc"}
    near, far = df.select(text.hash_distance(h["a"], h["b"]), text.hash_distance(h["a"], h["c"])).first()
    assert near <= 10 < far
    digests = spark.createDataFrame([(1, 0b1011), (2, 0b1000), (3, -1)], "i int, d long")
    pairs = text.compare_fuzzy_hash(digests, "d", digests.toDF("j", "e"), "e", 2).filter("i < j").collect()
    assert [(p.i, p.j, p.distance) for p in pairs] == [(1, 2, 2)]


def test_readers(spark, tmp_path):
    p = str(tmp_path / "a.csv")
    with open(p, "w") as f:
        f.write("id,name\n1,a,x\n2,b\nz,c\n")
    rows = readers.read_csv(spark, p, "id int, name string", malformed="bad").collect()
    assert [(r.id, r.name) for r in rows] == [(1, "a"), (2, "b"), (None, "c")]
    j = str(tmp_path / "a.json")
    with open(j, "w") as f:
        f.write('[{"a":1,"z":9},{"b":2}]')
    assert [tuple(r) for r in readers.read_json(spark, j, "a int, b int").collect()] == [(1, None), (None, 2)]
    assert readers.split_statements(r"select 1; select '\;' ;") == ["select 1", "select ';'"]
    assert "ROWNUM <= 20" in readers.paged_sql("select * from t", "id", 10, 1, "oracle")
    with pytest.raises(readers.MissingConnector):
        readers.read_avro(spark, p)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    for nulls, want in (("never_suppress", {"a", "b", "c"}), ("always_suppress", {"a"}), ("suppress_missing", {"a", "b"})):
        writers.write_json(df.coalesce(1), str(tmp_path / nulls), "array", nulls)
        rows = [json.loads("".join(r.value for r in spark.read.text(str(tmp_path / nulls)).collect()))]
        assert set(rows[0][0]) == want and len(rows[0]) == 2
    assert writers.merge_statement("t", ["a", "b"], ["a"], "postgresql") == "INSERT INTO t (a, b) VALUES (?, ?) ON CONFLICT (a) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b"
    with pytest.raises(ValueError):
        writers.route_to_sinks(df, "b", {})


def test_jdbc_round_trip(spark, tmp_path):
    """Derby comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "ID int, NAME string")
    writers.write_jdbc(df, url, "t", options)
    whole, few = readers.read_jdbc(spark, url, "SELECT * FROM t; SELECT id FROM t WHERE id < 3", options)
    assert whole.count() == 20 and few.count() == 3
    sliced = readers.read_jdbc_partitioned(spark, url, "t", "ID", 0, 20, 4, options)
    assert sliced.rdd.getNumPartitions() == 4 and sliced.count() == 20


def test_geometry(spark):
    assert geo.simplify_wkt("LINESTRING (0 0, 1 0.1, 2 0)", 0.5) == "LINESTRING (0 0, 2 0)"
    ring = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    assert geo.simplify_wkt(ring, 10) == ring and geo.simplify_wkt(None, 1) is None
    assert geo.clip_lines("LINESTRING (-1 1, 3 1)", (0, 0, 2, 2)) == ["LINESTRING (0 1, 2 1)"]
    df = spark.createDataFrame([(-5.6, 42.6)], "lon double, lat double")
    assert df.select(geo.geohash(F.col("lon"), F.col("lat"), 5)).first()[0] == "ezs42"
    x, y = geo.SYSTEMS[5179](F.col("lon"), F.col("lat"))
    at = spark.createDataFrame([(127.5, 38.0)], "lon double, lat double").select(x, y).first()
    assert at[0] == pytest.approx(1_000_000, abs=1e-3) and at[1] == pytest.approx(2_000_000, abs=1e-3)


def test_paths_on_unlike_types(spark):
    df = spark.createDataFrame([((1, "x", None), [1, 2, 3])], "r struct<a:int,b:string,c:string>, l array<int>")
    r, l = paths.field(df, "r"), paths.field(df, "l")
    got = df.select(r.children().column, l.index(9).column, l.index(-9).column, l.slices((1, -1), 7).column).first()
    assert (list(got[0]), got[1], got[2], list(got[3])) == (["1", "x"], None, None, [2, 3])
    with pytest.raises(ValueError):
        paths.root(df).up()


def test_limits_and_lineage(spark):
    with pytest.raises(ValueError):
        analytics.limit_rows(spark.range(3), -1)
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8)], "parent int, child int")
    assert sorted((r.item, r.depth) for r in analytics.lineage(edges, spark.createDataFrame([(3,)], "x int")).collect()) == [(1, 2), (2, 1), (3, 0)]


def test_depth_limits_raise(spark):
    chain = spark.createDataFrame([(1, None, 1), (2, 1, 1), (3, 2, 1), (4, 3, 1)], "g int, parent int, n int")
    assert sorted((r.g, r.total_n) for r in analytics.group_status(chain, "g", "parent", ["n"], 3).collect()) == [(1, 4), (2, 3), (3, 2), (4, 1)]
    with pytest.raises(RuntimeError):
        analytics.group_status(chain, "g", "parent", ["n"], 2)
    start = spark.createDataFrame([(1,)], "x int")
    assert analytics.lineage(chain, start, "parent", "g", 3).agg({"depth": "max"}).first()[0] == 3
    with pytest.raises(RuntimeError):
        analytics.lineage(chain, start, "parent", "g", 2)


def test_stream_order_and_overtake(spark, tmp_path):
    rows = [(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (1, 1, "again"), (2, 1, "x")]
    spark.createDataFrame(rows, "g int, n int, v string").write.parquet(str(tmp_path / "in"))
    df = streams.read_files(spark, str(tmp_path / "in"), "g int, n int, v string")
    out = streams.run_to_end(streams.enforce_order(df, "g", "n", "v"))
    assert sorted((r.g, r.n, r.outcome) for r in out.collect()) == [(1, 0, "released"), (1, 1, "late"), (1, 1, "released"), (1, 2, "released")]


def test_scripts(spark):
    sent = scripts.sink_source("millrace_test_sink", lambda part, rows: sum(1 for _ in rows))
    scripts.write_script(spark.range(5), sent)
    assert routing.distribute_load(spark.range(4000), ["id"], {"a": 3, "b": 1}).filter("output = 'a'").count() == pytest.approx(3000, rel=0.1)


def test_record_stats(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None)], "x string, y string")
    stats = lambda d, limit=None: sorted((r.name, r.value or "", r.n) for r in records.record_stats(d, {"p": "x", "q": "y"}, limit).collect())
    assert stats(df) == [("p", "", 3), ("p", "a", 2), ("p", "b", 1), ("q", "", 0), ("record.count", "", 3)]
    assert stats(df, 1) == [("p", "", 3), ("p", "a", 2), ("q", "", 0), ("record.count", "", 3)]
    assert stats(df.limit(0)) == [("p", "", 0), ("q", "", 0), ("record.count", "", 0)]


def test_deep_groups_and_lineage(spark):
    chain = spark.createDataFrame([(i, i - 1 if i > 1 else None, 1) for i in range(1, 71)], "g int, parent int, n int")
    totals = {r.g: r.total_n for r in analytics.group_status(chain.filter("g <= 60"), "g", "parent", ["n"]).collect()}
    assert totals == {g: 61 - g for g in range(1, 61)}
    cycle = spark.createDataFrame([(1, 3, 1), (2, 1, 1), (3, 2, 1), (4, None, 1)], "g int, parent int, n int")
    with pytest.raises(ValueError):
        analytics.group_status(cycle, "g", "parent", ["n"])
    # a ring, a chain from it, and an item of its own
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (9, 8)] + [(i, i + 1) for i in range(4, 35)], "parent int, child int")
    got = {r.item: r.depth for r in analytics.lineage(edges, spark.createDataFrame([(1,), (1,)], "x int")).collect()}
    assert got == {1: 0, 2: 1, 3: 1} | {i: i - 2 for i in range(4, 36)}


def test_csv_headers_types_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,x\na,b\n')
    (tmp_path / "b.csv").write_text('a,b\n2,"y,z",more,"p,q"\n3\n')
    path = str(tmp_path)
    rows = readers.read_csv(spark, path, "a string, b string", drop_unknown=False)
    assert rows.columns == ["a", "b", "unknown_field_index_2", "unknown_field_index_3"]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted([("1", "x", None, None), ("a", "b", None, None), ("2", "y,z", "more", "p,q"), ("3", None, None, None)], key=str)
    assert readers.read_csv(spark, path, "a string, b string").count() == 4
    for drop in (True, False):
        with pytest.raises(Exception, match="is no int"):
            readers.read_csv(spark, path, "a int, b string", drop_unknown=drop).collect()
    assert readers.read_csv(spark, path, "a string", header=False, drop_unknown=False).count() == 6
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("a,b\n7,\n,x\n")
    assert sorted(readers.read_csv(spark, str(tmp_path / "c"), "a int, b string").collect(), key=str) == [(7, None), (None, "x")]


def test_merges_of_repeated_and_null_keys(spark):
    target = spark.createDataFrame([(1, "old", 0), (5, "five", 0)], "k int, v string, s int")
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 4), (2, "d", 3), (None, "n", 1), (None, "m", 1)], "k int, v string, s int")
    rows = lambda df: sorted(((r.k, r.v) for r in df.collect()), key=str)
    assert rows(writers.upsert(target, source, ["k"], "s")) == sorted([(1, "b"), (2, "c"), (5, "five"), (None, "n"), (None, "m")], key=str)
    assert rows(writers.insert_ignore(target, source, ["k"], "s")) == sorted([(1, "old"), (2, "d"), (5, "five"), (None, "n"), (None, "m")], key=str)
    for merge in (writers.upsert, writers.insert_ignore):
        with pytest.raises(Exception, match="repeated"):
            merge(target, source, ["k"]).collect()
    once = source.filter("s <= 1 OR s = 4")
    assert rows(writers.upsert(target, once, ["k"])) == sorted([(1, "a"), (2, "c"), (5, "five"), (None, "n"), (None, "m")], key=str)


def test_mapping_with_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "z w"), (None, "x-x"), (2, None), (3, "")], "k int, t string")
    mapping = spark.createDataFrame([("x", "X"), ("x", "Y"), ("y", None), (None, "no")], "word string, replacement string")
    got = text.replace_with_mapping(df, "t", ["k"], mapping)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in spark.createDataFrame([(1, "X y"), (1, "z w"), (None, "X-X"), (2, None), (3, "")], "k int, t string").collect())


def test_fuzzy_hash_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " -- "), (4, "one word"), (5, "one word")], "i int, t string")
    digests = df.select("i", text.fuzzy_hash(F.col("t")).alias("d")).cache()
    assert [r.d is None for r in digests.orderBy("i").collect()] == [True, True, True, False, False]
    pairs = text.compare_fuzzy_hash(digests, "d", digests.toDF("j", "e"), "e", 3).collect()
    assert sorted((r.i, r.j, r.distance) for r in pairs) == [(4, 4, 0), (4, 5, 0), (5, 4, 0), (5, 5, 0)]


def test_stream_bins_to_the_end(spark, tmp_path):
    from millrace.streaming import streams

    spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(20)], "k string, v int").coalesce(1).write.parquet(f"{tmp_path}/in")
    rows = streams.read_files(spark, f"{tmp_path}/in", "k string, v int")
    got = streams.merge_bins_to_end(rows, "k", "v", 5).collect()
    assert sorted((r.k, r.n) for r in got) == [("a", 3), ("a", 5), ("a", 5), ("b", 2), ("b", 5)]
    assert sorted(int(x) for r in got for x in r.content.split("\n")) == list(range(20))


def test_routing_reads_once_and_takes_odd_names(spark):
    df = spark.createDataFrame([(1, "a/b"), (2, None), (3, "c"), (4, "other")], "i int, to string")
    got = {}
    keep = lambda name: lambda part: got.update({name: sorted(r.i for r in part.collect())})
    writers.route_to_sinks(df, "to", {"a/b": keep("a/b"), "c": keep("c"), "none": keep("none")}, keep("rest"))
    assert got == {"a/b": [1], "c": [3], "none": [], "rest": [2, 4]}


def test_buffers_and_systems(spark):
    from millrace.operators import geo

    for wkt in ("LINESTRING (0 0, 1 1, 2 0)", "POLYGON ((0 0, 4 0, 4 4, 2 1, 0 4, 0 0))", "MULTIPOINT (0 0)", "POLYGON ((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))"):
        with pytest.raises(ValueError):
            geo.buffer_wkt(wkt, 1.0)
    with pytest.raises(Exception, match="no point"):
        spark.createDataFrame([("LINESTRING (0 0, 1 1)",)], "g string").select(geo.buffer_point(F.col("g"), 1.0)).collect()
    ring = geo._points(geo.buffer_wkt("LINESTRING (0 0, 10 0)", 2.0)[len("POLYGON ((") : -2])
    away = [max(0.0, -x, x - 10) ** 2 + y * y for x, y in ring]
    assert len(ring) == 35 and all(abs(d - 4) < 1e-7 for d in away)
    # either way round, and with corners on an edge
    assert geo.buffer_wkt("POLYGON ((0 0, 2 0, 4 0, 4 4, 0 4, 0 0))", 1.0) == geo.buffer_wkt("POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0))", 1.0)
    df = spark.createDataFrame([("POLYGON ((126 35, 129.5 36, 128 38, 126 35))",), (None,), ("POLYGON EMPTY",)], "g string")
    back = geo.transform_geometry(geo.transform_geometry(geo.transform_geometry(df, "g", 4326, 5179), "g", 5179, 3857), "g", 3857, 4326)
    got = [r.g for r in back.collect()]
    assert got[1:] == [None, "POLYGON EMPTY"]
    assert abs(geo._points(got[0][len("POLYGON ((") : -2]) - geo._points("126 35, 129.5 36, 128 38, 126 35")).max() < 1e-9


def test_pages_far_from_the_start(spark, monkeypatch):
    df = spark.range(1000).select((999 - F.col("id")).alias("i"))
    near = [r.i for r in analytics.page(df, ["i"], 7, 9).orderBy("i").collect()]
    monkeypatch.setattr(analytics, "TOP_ROWS", 10)
    assert [r.i for r in analytics.page(df, ["i"], 7, 9).orderBy("i").collect()] == near == list(range(63, 70))


def test_common_attributes_of_odd_members(spark):
    rows = [("x", {"a": "1", "b": "2"}), ("x", {"a": "1"}), ("y", {}), ("y", {"c": "3"}), ("z", {}), ("v", None), ("w", {"d": None})]
    df = spark.createDataFrame(rows, "bin string, m map<string,string>")
    common = {r.bin: r.m for r in records.keep_common_attributes(df, "bin", "m").collect()}
    unique = {r.bin: r.m for r in records.keep_unique_attributes(df, "bin", "m").collect()}
    assert common == {"x": {"a": "1"}, "y": {}, "z": {}, "v": {}, "w": {}}
    assert unique == {"x": {"a": "1", "b": "2"}, "y": {"c": "3"}, "z": {}, "v": {}, "w": {}}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from millrace import scratch

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        scratch.scratch_dir(session)
    session.conf.get = lambda *_: "hdfs://shared/x/"
    assert scratch.scratch_dir(session) == "hdfs://shared/x"


def test_optional_operators_may_be_missing(monkeypatch):
    import builtins
    import importlib
    import sys

    import __spark_entry__ as entry

    have = set(entry.queries())
    for name in [m for m in sys.modules if m.startswith("millrace.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name.split(".")[0] == "public_tokenizers" or name.startswith("millrace.llm"):
            raise ModuleNotFoundError(name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", without)
    monkeypatch.setattr(importlib, "import_module", lambda name, find=importlib.import_module: without(name) if "llm" in name else find(name))
    left = entry.queries()
    assert left and set(left) == {n for n in have if not n.startswith("op") and n != "pipeline"} and set(entry.oracle_sql()) <= set(left)


@pytest.mark.parametrize("value", [b"", b"a", b"ab", b"abc", b"abcd", b"abcde", bytes(range(256)), b"\x00" * 7, None])
def test_base32_of_any_length(spark, value):
    want = None if value is None else base64.b32encode(value).decode()
    assert one(spark, lambda c: text.encode_content(c, "base32"), value, "binary") == want


@pytest.mark.parametrize("kind", ["gzip", "deflate", "bzip2", "xz", "lzma"])
def test_codecs(spark, kind):
    for value in (b"", b"abc" * 1000, None):
        assert one(spark, lambda c: text.unpack_content(text.compress_content(c, kind=kind), kind), value, "binary") == value
    assert one(spark, lambda c: text.unpack_content(c, kind), b"no such thing", "binary") is None
    broken = one(spark, lambda c: F.substring(text.compress_content(c, kind=kind), 1, 9), b"abc" * 1000, "binary")
    assert one(spark, lambda c: text.unpack_content(c, kind), bytes(broken), "binary") in (None, b"")


@pytest.mark.parametrize("kind", ["zip", "tar"])
def test_archives(spark, kind):
    files = [(1, "b", b"two"), (1, "a", b"one"), (2, "a", None), (2, None, b"lost"), (3, "a", b"x"), (3, "a", b"x")]
    packed = text.pack_files(spark.createDataFrame(files, "k int, n string, c binary"), ["k"], "n", "c", kind)
    bad = spark.createDataFrame([(4, None), (5, b"broken" * 200)], "k int, archive binary")
    got = text.unpack_files(packed.union(bad), "archive", ["k"], kind).collect()
    rows = sorted((r.k, r.fragment_index, r.name, None if r.content is None else bytes(r.content)) for r in got)
    assert rows == [(1, 0, "a", b"one"), (1, 1, "b", b"two"), (2, 0, "a", b""), (3, 0, "a", b"x"), (3, 1, "a", b"x"), (4, None, None, None), (5, None, None, None)]
    with pytest.raises(ValueError):
        text.compress_content(F.col("c"), kind="none")
