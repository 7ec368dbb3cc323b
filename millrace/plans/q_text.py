"""Queries of the text operators."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from millrace.operators import dictionary
from millrace.operators import hl7 as messages
from millrace.operators import text
from millrace.plans.registry import load, register

c = F.col


@register("text_01_replace", r"SELECT doc_id, md5(regexp_replace(text, '(\w+)\.', '<\1>', 'g')) AS whole, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^.', '#')), chr(10))) AS lines FROM documents")
def replace(spark, sf_dir):
    df = load(spark, sf_dir, "documents")
    return df.select("doc_id", F.md5(text.replace_text(c("text"), r"([a-zA-Z0-9_]+)\.", "<$1>")).alias("whole"), F.md5(text.replace_text(c("text"), "^.", "#", line_by_line=True)).alias("lines"))


@register("text_01_replace_computed", "SELECT o_orderkey, 'on ' || strftime(o_orderdate, '%d.%m.%Y') || '!' AS t FROM orders")
def replace_computed(spark, sf_dir):
    t = F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("!"))
    made = text.replace_computed(t, r"(\d{4}-\d\d-\d\d)", lambda g: F.date_format(F.to_date(g[1]), "dd.MM.yyyy"), 1)
    return load(spark, sf_dir, "orders").select("o_orderkey", made.alias("t"))


@register("text_02_replace_mapping", "SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda x: CASE x WHEN 'STANDARD' THEN 'PLAIN' WHEN 'PROMO' THEN 'AD' ELSE x END), ' ') AS p_type FROM part")
def replace_mapping(spark, sf_dir):
    mapping = load(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("word")).distinct().filter("word IN ('STANDARD', 'PROMO')").withColumn("replacement", F.when(c("word") == "PROMO", "AD").otherwise("PLAIN"))
    return text.replace_with_mapping(load(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", ["p_partkey"], mapping)


@register("text_03_extract", r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)', 0) AS "u.0", regexp_extract(url, '^(https?)://([^/]+)', 1) AS "u.1", regexp_extract(url, '^(https?)://([^/]+)', 2) AS "u.2" FROM pages""")
def extract(spark, sf_dir):
    return text.extract_text(load(spark, sf_dir, "pages").select("page_id", "url"), "url", {"u": r"^(https?)://([^/]+)"}).drop("url")


def _log_lines(spark, sf_dir):
    line = F.expr("if(event_id % 4 = 3, '  at frame', concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' ', upper(if(event_type = 'error', 'error', 'info')), ' user=', user_id))")
    return load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", line.alias("line"))


_GROK = r"%{TIMESTAMP_ISO8601:at} %{LOGLEVEL:level} user=%{INT:who}"


@register("text_04_grok", "SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at, CASE WHEN event_id % 4 <> 3 THEN CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END END AS level, CASE WHEN event_id % 4 <> 3 THEN user_id::VARCHAR END AS who FROM events")
def grok(spark, sf_dir):
    return text.extract_grok(_log_lines(spark, sf_dir), "line", _GROK).select("event_id", "at", "level", "who")


@register("text_04_grok_classes", "SELECT event_id, event_type AS kind, user_id::VARCHAR AS who FROM events")
def grok_classes(spark, sf_dir):
    """Brackets and parentheses inside character classes are text."""
    line = F.format_string("(%s) [%d]", "event_type", "user_id")
    out = text.extract_grok(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line", r"^[(]%{WORD:kind}[)] [\[(]%{INT:who}[])]$")
    return out.filter("matched").select("event_id", "kind", "who")


@register("text_05_grok_skip_append", "WITH l AS (SELECT event_id, event_id % 64 AS s, event_id % 4 = 3 AS miss FROM events), g AS (SELECT *, sum((NOT miss)::INT) OVER (PARTITION BY s ORDER BY event_id) AS grp FROM l) SELECT f.event_id, t.n AS appended FROM g f LEFT JOIN (SELECT s, grp, count(*) AS n FROM g WHERE miss AND grp > 0 GROUP BY s, grp) t ON t.s = f.s AND t.grp = f.grp WHERE NOT f.miss")
def grok_append(spark, sf_dir):
    lines = _log_lines(spark, sf_dir).withColumn("s", c("event_id") % 64)
    out = text.extract_grok(lines, "line", _GROK, no_match="append", order=["event_id"], stream="s")
    return out.select("event_id", F.size(F.split("stack_trace", "\n")).cast("long").alias("appended")).withColumn("appended", F.when(c("appended") > 0, c("appended")))


@register("text_06_syslog", "SELECT event_id, (event_id % 192)::INTEGER AS priority, (event_id % 8)::INTEGER AS severity, (event_id % 192 // 8)::INTEGER AS facility, 'host' || user_id AS hostname, event_type AS body, event_id % 5 <> 0 AS valid FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, false FROM events WHERE event_id % 5 = 0")
def syslog(spark, sf_dir):
    line = F.expr("if(event_id % 5 = 0, 'broken', concat('<', event_id % 192, '>', if(event_id % 2 = 0, date_format(ts, 'MMM dd HH:mm:ss'), concat('1 ', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"))), ' host', user_id, ' ', event_type))")
    return text.parse_syslog(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line").select("event_id", "priority", "severity", "facility", "hostname", "body", "valid")


@register("text_07_syslog_5424", "SELECT event_id, 'app' AS appname, NULL::VARCHAR AS procid, 'ID' || event_id AS messageid, event_type AS kind, 'a]b' AS odd, 'body ' || user_id AS body FROM events")
def syslog_5424(spark, sf_dir):
    line = F.expr(r"""concat('<34>1 2024-01-01T00:00:00Z host app - ID', event_id, ' [ex@1 kind="', event_type, '"][two@2 odd="a\\]b"] body ', user_id)""")
    out = text.parse_syslog_5424(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line")
    return out.select("event_id", "appname", "procid", "messageid", c("structured_data")["ex@1.kind"].alias("kind"), F.replace(c("structured_data")["two@2.odd"], F.lit("\\"), F.lit("")).alias("odd"), "body")


@register("text_07_syslog_repeated", "SELECT event_id, user_id::VARCHAR AS ip, event_type AS kind FROM events")
def syslog_repeated(spark, sf_dir):
    """A parameter name may come again in an element, and an element's in another."""
    line = F.expr(r"""concat('<34>1 2024-01-01T00:00:00Z host app - ID [o ip="1" kind="', event_type, '" ip="', user_id, '"][p ip="3"] body')""")
    out = text.parse_syslog_5424(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line")
    return out.select("event_id", c("structured_data")["o.ip"].alias("ip"), c("structured_data")["o.kind"].alias("kind"))


@register("text_08_cef_repeated", "SELECT event_id, user_id::VARCHAR AS src, event_type AS msg FROM events")
def cef_repeated(spark, sf_dir):
    line = F.expr("concat('CEF:0|V|P|1|id|name|5|src=1 msg=', event_type, ' src=', user_id)")
    out = text.parse_cef(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line")
    return out.select("event_id", c("extension")["src"].alias("src"), c("extension")["msg"].alias("msg"))


def _cef(spark, sf_dir):
    line = F.expr(r"concat('CEF:0|Vend\\|or|Prod|1.0|', event_type, '|A name|', user_id % 10, '|src=10.0.0.1 msg=two words cnt=', user_id)")
    return text.parse_cef(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line")


@register("text_08_cef", "SELECT event_id, 'Vend|or' AS \"deviceVendor\", event_type AS kind, (user_id % 10)::VARCHAR AS severity, 'two words' AS msg, user_id::VARCHAR AS cnt FROM events")
def cef(spark, sf_dir):
    return _cef(spark, sf_dir).select("event_id", "deviceVendor", c("deviceEventClassId").alias("kind"), "severity", c("extension")["msg"].alias("msg"), c("extension")["cnt"].alias("cnt"))


@register("sch_05_cef_schema", "SELECT * FROM (VALUES ('cnt', 'int'), ('msg', 'string'), ('src', 'string')) t(field, kind)")
def cef_schema(spark, sf_dir):
    from millrace.operators.schema import infer_cef_schema

    found = infer_cef_schema(_cef(spark, sf_dir))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found.fields[7:]], "field string, kind string")


@register("text_09_netflow", "SELECT c_custkey, i AS record_index, '10.0.' || c_custkey % 256 || '.' || i AS srcaddr, (1000 + c_custkey) AS \"dOctets\", 443::BIGINT AS dstport FROM customer, range(2) t(i)")
def netflow(spark, sf_dir):
    def record(i):
        n = F.lpad(F.hex(c("c_custkey") % 256), 2, "0")
        octets = F.lpad(F.hex(c("c_custkey") + 1000), 8, "0")
        return F.concat(F.lit("0A00"), n, F.lit(f"{i:02x}"), F.lit("00" * 8 + "00" * 4 + "00" * 4), octets, F.lit("00" * 8 + "0050" + "01BB" + "00" * 12))

    data = F.unhex(F.concat(F.lit("00050002" + "00" * 20), record(0), record(1)))
    return text.parse_netflow_v5(load(spark, sf_dir, "customer").withColumn("d", data), "d").select("c_custkey", "record_index", "srcaddr", c("dOctets"), "dstport")


@register("text_10_windows_event", "SELECT c_custkey, c_name AS provider, (4000 + c_nationkey)::INTEGER AS event_id, 'a,' || c_mktsegment AS data FROM customer")
def windows_event(spark, sf_dir):
    xml = F.format_string('<Event><System><Provider Name="%s"/><EventID>%d</EventID><Level>4</Level><Computer>pc</Computer></System><EventData><Data>a</Data><Data>%s</Data></EventData></Event>', "c_name", c("c_nationkey") + 4000, "c_mktsegment")
    return text.parse_windows_event_xml(load(spark, sf_dir, "customer").withColumn("x", xml), "x").select("c_custkey", "provider", "event_id", F.array_join("data", ",").alias("data"))


@register("text_11_html_element", "SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, regexp_extract(html, '<html lang=\"(\\w+)\"', 1) AS lang FROM pages")
def html_element(spark, sf_dir):
    df = text.get_html_element(load(spark, sf_dir, "pages"), "html", "title", "text").withColumn("title", c("elements")[0])
    return text.get_html_element(df, "html", "html", "@lang").select("page_id", "title", c("elements")[0].alias("lang"))


@register("text_11_html_modify", "SELECT page_id, md5(regexp_replace(html, '<title>.*?</title>', '<title>new</title>')) AS changed FROM pages")
def html_modify(spark, sf_dir):
    return text.modify_html_element(load(spark, sf_dir, "pages"), "html", "title", "modify", "new").select("page_id", F.md5("html").alias("changed"))


@register("text_12_split_text", "WITH l AS (SELECT doc_id, i - 1 AS i, string_split(text, chr(10))[i] AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) u(i)) SELECT doc_id, (i // 3)::BIGINT AS fragment_index, md5(string_agg(line, chr(10) ORDER BY i)) AS split FROM l GROUP BY doc_id, i // 3")
def split_text(spark, sf_dir):
    return text.split_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", 3).select("doc_id", "fragment_index", F.md5("split").alias("split"))


@register("text_12_split_content", "SELECT o_orderkey, (i - 1)::INTEGER AS fragment_index, list_filter(string_split(o_orderpriority, 'E'), lambda x: x <> '')[i] AS split FROM orders, unnest(range(1, len(list_filter(string_split(o_orderpriority, 'E'), lambda x: x <> '')) + 1)) u(i)")
def split_content(spark, sf_dir):
    return text.split_content(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "E").drop("o_orderpriority")


@register("text_13_segment", "SELECT doc_id, i AS fragment_index, greatest((strlen(text) + 999) // 1000, 1)::BIGINT AS fragment_count, least(1000, strlen(text) - 1000 * (i - 1))::INTEGER AS size FROM documents, unnest(range(1, greatest((strlen(text) + 999) // 1000, 1) + 1)) u(i)")
def segment(spark, sf_dir):
    return text.segment_content(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", 1000).select("doc_id", "fragment_index", "fragment_count", F.octet_length("segment").alias("size"))


@register("text_14_modify_bytes", "SELECT p_partkey, substr(p_name, 3, greatest(length(p_name) - 4, 0)) AS cut, '' AS nothing FROM part")
def modify_bytes(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", text.modify_bytes(c("p_name"), 2, 2).cast("string").alias("cut"), text.modify_bytes(c("p_name"), 99).cast("string").alias("nothing"))


@register("text_15_count", r"SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS line_count, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))::BIGINT AS non_empty_line_count, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS word_count, length(text)::BIGINT AS character_count FROM documents")
def count(spark, sf_dir):
    return text.count_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")


@register("text_16_scan_attributes", "SELECT p_partkey, p_brand IN ('Brand#1', 'Brand#2') OR p_type IN ('Brand#1', 'Brand#2') AS matched FROM part")
def scan_attributes(spark, sf_dir):
    terms = load(spark, sf_dir, "part").select("p_brand").distinct().filter("p_brand IN ('Brand#1', 'Brand#2')")
    return text.scan_attributes(load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), terms, "p_brand", ["p_brand", "p_type"]).select("p_partkey", "matched")


@register("text_17_scan_content", "SELECT doc_id, regexp_matches(text, 'licensed under|All rights reserved') AS matched, nullif(regexp_extract(text, 'licensed under|All rights reserved'), '') AS term FROM documents")
def scan_content(spark, sf_dir):
    return text.scan_content(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["licensed under", " ", "All rights reserved"]).drop("text")


@register("text_17_scan_dictionary", "WITH terms AS (SELECT p_name AS term FROM part UNION SELECT unnest(string_split(text, ' ')) FROM benchmark) SELECT doc_id, term, min(strpos(text, term) - 1)::BIGINT AS first FROM documents, terms WHERE trim(term) <> '' AND length(term) > 5 AND contains(text, term) GROUP BY doc_id, term")
def scan_dictionary_(spark, sf_dir):
    """Names of parts and words of the benchmark, all of them in all documents; the first place of each."""
    names = load(spark, sf_dir, "part").select(c("p_name").alias("term"))
    terms = names.union(load(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")))).filter("length(term) > 5")
    found = dictionary.scan_dictionary(load(spark, sf_dir, "documents"), "text", ["doc_id"], terms, "term")
    return found.groupBy("doc_id", "term").agg(F.min("place").alias("first"))


@register("text_18_encode", "SELECT p_partkey, base64(encode(p_name)) AS b64, lower(hex(encode(p_name))) AS hexed, p_name AS back, p_name AS back32, true AS bad FROM part")
def encode(spark, sf_dir):
    df, n = load(spark, sf_dir, "part"), c("p_name")
    return df.select("p_partkey", text.encode_content(n, "base64").alias("b64"), text.encode_content(n, "hex").alias("hexed"), text.decode_content(text.encode_content(n, "base64"), "base64").cast("string").alias("back"), text.decode_content(text.encode_content(n, "base32"), "base32").cast("string").alias("back32"), text.decode_content(F.lit("zz!"), "hex").isNull().alias("bad"))


@register("text_19_compress", "SELECT doc_id, md5(text) AS back, true AS bad FROM documents")
def compress(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", F.md5(text.unpack_content(text.compress_content(c("text")))).alias("back"), text.unpack_content(c("text")).isNull().alias("bad"))


@register("text_19_codecs", "SELECT p_partkey, md5(p_name) AS deflate, md5(p_name) AS bzip2, md5(p_name) AS xz, md5(p_name) AS lzma FROM part")
def codecs(spark, sf_dir):
    back = lambda kind: F.md5(text.unpack_content(text.compress_content(c("p_name"), kind=kind), kind)).alias(kind)
    # packing is the work of all tasks, however few pieces the table's file has
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_name").repartition("p_partkey")
    return parts.select("p_partkey", *(back(k) for k in ("deflate", "bzip2", "xz", "lzma")))


@register("text_19_archives", "SELECT kind, conv_id, (turn // 16)::BIGINT AS part, (row_number() OVER (PARTITION BY kind, conv_id, turn // 16 ORDER BY turn, coalesce(text, '')) - 1)::INTEGER AS fragment_index, 'turn-' || lpad(turn::VARCHAR, 6, '0') AS name, md5(coalesce(text, '')) AS content FROM conversations, (VALUES ('zip'), ('tar')) k(kind) WHERE turn IS NOT NULL")
def archives(spark, sf_dir):
    """Sixteen turns of a conversation as files of an archive, and back."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", F.expr("turn div 16").alias("part"), F.concat(F.lit("turn-"), F.lpad(c("turn").cast("string"), 6, "0")).alias("name"), "text")
    back = lambda kind: text.unpack_files(text.pack_files(turns, ["conv_id", "part"], "name", "text", kind), "archive", ["conv_id", "part"], kind)
    both = [back(kind).select(F.lit(kind).alias("kind"), "conv_id", "part", "fragment_index", "name", F.md5("content").alias("content")) for kind in ("zip", "tar")]
    return both[0].union(both[1])


@register("text_20_21_hash", "SELECT o_orderkey, sha256(o_orderstatus) AS one, sha256(o_orderstatus || '|' || o_orderpriority) AS several, md5(regexp_extract(o_orderpriority, '[A-Z]+') || o_orderstatus) AS parts FROM orders")
def hashes(spark, sf_dir):
    df = text.hash_attribute(load(spark, sf_dir, "orders"), {"o_orderstatus": ".*", "o_orderpriority": "[A-Z]+"}, "parts")
    return df.select("o_orderkey", text.hash_content(c("o_orderstatus")).alias("one"), text.hash_columns(["o_orderstatus", "o_orderpriority"], "|").alias("several"), "parts")


@register("text_22_23_fuzzy_hash")
def fuzzy(spark, sf_dir):
    """All documents against the benchmark's items, by digests that differ in 3 bits at most."""
    docs = load(spark, sf_dir, "documents").select("doc_id", text.fuzzy_hash(c("text")).alias("digest"))
    known = load(spark, sf_dir, "benchmark").groupBy(text.fuzzy_hash(c("text")).alias("known")).agg(F.min("item_id").alias("known_id"))
    return text.compare_fuzzy_hash(docs, "digest", known, "known", 3).select("doc_id", "known_id", "distance")


@register("text_22_fuzzy_hash_of_same_words", r"SELECT doc_id, CASE WHEN regexp_matches(text, '[\pL\pN_]') THEN 0 END::INTEGER AS distance FROM documents")
def fuzzy_same(spark, sf_dir):
    """The digest does not see case or marks between words; a text without a word has none."""
    other = F.concat(F.lit("-- "), F.regexp_replace(F.translate("text", string.ascii_lowercase, string.ascii_uppercase), r"(?U)\W+", " ; "))
    return load(spark, sf_dir, "documents").select("doc_id", text.hash_distance(text.fuzzy_hash(c("text")), text.fuzzy_hash(other)).alias("distance"))


@register("text_23_compare_fuzzy_hash", "SELECT doc_id, item_id AS known_id FROM documents, benchmark WHERE documents.text = benchmark.text UNION SELECT item_id, item_id FROM benchmark")
def fuzzy_compare(spark, sf_dir):
    """Benchmark items, and documents that are one of them, find it at distance 0."""
    items = load(spark, sf_dir, "benchmark").select("item_id", "text")
    own = items.select(c("item_id").cast("long").alias("doc_id"), "text").union(load(spark, sf_dir, "documents").join(items.select("text"), "text", "left_semi").select("doc_id", "text")).distinct()
    digests = own.select("doc_id", "text", text.fuzzy_hash(c("text")).alias("digest"))
    known = items.select(c("item_id").alias("known_id"), c("text").alias("known_text"), text.fuzzy_hash(c("text")).alias("known"))
    return text.compare_fuzzy_hash(digests, "digest", known, "known", 3).filter("text = known_text AND distance = 0").select("doc_id", "known_id")


@register("text_24_mime", "SELECT page_id, CASE WHEN starts_with(html, '<!DOCTYPE ') OR starts_with(html, '<html') THEN 'text/html' ELSE 'application/octet-stream' END AS mime, 'text/csv' AS by_name, 'application/gzip' AS packed FROM pages")
def mime(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", text.identify_mime_type(c("html")).alias("mime"), text.identify_mime_type(F.lit("a,b"), F.lit("X.CSV")).alias("by_name"), text.identify_mime_type(text.compress_content(c("url"))).alias("packed"))


@register("text_25_validate", "SELECT o_orderkey, o_orderkey % 2 = 0 AS xml_ok, o_orderkey % 3 <> 0 AS csv_ok FROM orders")
def validate(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", F.expr("if(o_orderkey % 2 = 0, concat('<r><a>', o_custkey, '</a></r>'), '<r><a>')").alias("x"), F.expr("if(o_orderkey % 3 <> 0, concat(o_custkey, ',', o_orderstatus), 'x,y')").alias("l"))
    df = text.validate_xml(df, "x", "a bigint").withColumnRenamed("valid", "xml_ok").drop("error")
    return text.validate_csv(df, "l", "a bigint, b string").withColumnRenamed("valid", "csv_ok").select("o_orderkey", "xml_ok", "csv_ok")


@register("text_25_validate_xml", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN 'r: unknown element c; r: no element b' WHEN 2 THEN 'r/a: not a bigint' WHEN 3 THEN 'r: no element b' WHEN 4 THEN 'r: unknown attribute k; r: more than one element a' WHEN 5 THEN 'r/n: no element x' END AS error FROM orders")
def validate_xml_elements(spark, sf_dir):
    """Well-formed texts that are not of the schema, by name of what is wrong."""
    bad = F.expr("CASE o_orderkey % 6 WHEN 1 THEN '<c>1</c>' WHEN 2 THEN '<a>x</a><b>y</b>' WHEN 3 THEN '' WHEN 4 THEN '<a>2</a><b/>' WHEN 5 THEN '<b/><n><y>1</y></n>' ELSE '<b>y</b><l>1</l><l>2</l>' END")
    body = F.when(c("o_orderkey") % 6 == 2, bad).otherwise(F.concat(F.format_string("<a>%d</a>", "o_custkey"), bad))
    inner = F.when(c("o_orderkey") % 6 == 5, F.replace(body, F.lit("<y>1</y>"), F.lit(""))).otherwise(F.concat(body, F.lit("<n><x>1</x></n>")))
    df = load(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.when(c("o_orderkey") % 6 == 4, '<r k="1">').otherwise("<r>"), inner, F.lit("</r>")).alias("x"))
    return text.validate_xml(df, "x", "a bigint, b string, n struct<x:int>, l array<int>").select("o_orderkey", "error")


_HL7 = "format_string('MSH#^*!%%#app#fac#to#there#2024##ADT^A%02d#ID%d#P#2.3\rPID#1##A%d^x*B%d^y%%z#', c_custkey % 40, c_custkey, c_custkey, c_nationkey)"


@register("text_26_hl7_tree", "SELECT c_custkey, '#' AS sep, 'ADT' AS kind, printf('A%02d', c_custkey % 40) AS trigger, 'ID' || c_custkey AS control FROM customer WHERE c_custkey % 40 < 9")
def hl7_tree(spark, sf_dir):
    """Numbers of MSH, with separators of the message's own."""
    df = load(spark, sf_dir, "customer").select("c_custkey", F.expr(_HL7).alias("m"))
    return messages.select(df, "m", ["c_custkey"], "MSH", {"sep": "MSH-1", "kind": "MSH-9.1", "trigger": "MSH-9.2", "control": 10}, lambda at: at("MSH-9.2") < "A09").drop("segment_index")


@register("text_26_hl7_components", "SELECT c_custkey, 'A' || c_custkey || '^x*B' || c_nationkey || '^y%z' AS whole, 'A' || c_custkey AS first, 'B' || c_nationkey AS second, 'z' AS sub, 'a|b^' || c_name AS text, NULL AS none FROM customer WHERE c_nationkey > 3")
def hl7_components(spark, sf_dir):
    """Repetitions, components, subcomponents and escape sequences."""
    tail = F.replace(F.concat(F.lit("a!X7C!b!S!"), "c_name"), F.lit("#"), F.lit("!F!"))
    df = load(spark, sf_dir, "customer").select("c_custkey", F.concat(F.expr(_HL7), tail).alias("m"))
    wanted = {"whole": "PID-3", "first": "PID-3.1", "second": "PID-3[2].1", "sub": "PID-3[2].2.2", "text": "PID-4", "none": "PID-3[3].1"}
    return messages.select(df, "m", ["c_custkey"], "PID", wanted, lambda at: F.substring(at("PID-3[2].1"), 2, 9).try_cast("int") > 3).drop("segment_index")


@register("text_26_hl7", "SELECT c_custkey, 1 AS segment_index, c_name AS name FROM customer WHERE c_custkey > 10")
def hl7(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select("c_custkey", F.format_string("MSH|^~\\&|app\rPID|%d|%s|x", "c_custkey", "c_name").alias("m"))
    return messages.select(df, "m", ["c_custkey"], "PID", {"name": 2}, lambda at: at(1).try_cast("long") > 10)


@register("text_27_email", "SELECT c_custkey, 'Hello ' || c_custkey AS subject, c_name || ' <x@example.com>' AS sender FROM customer")
def email(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select("c_custkey", F.format_string("From: %s\r\n <x@example.com>\r\nSubject: Hello %d\r\n\r\nSubject: no", "c_name", "c_custkey").alias("m"))
    return text.extract_email_headers(df, "m").select("c_custkey", c("headers")["subject"].alias("subject"), c("headers")["from"].alias("sender"))
