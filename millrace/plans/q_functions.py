"""Queries of the Column functions: predicates, texts, numbers, dates and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import numbers as N
from millrace.functions import predicates as P
from millrace.functions import strings as S
from millrace.plans.registry import load, register, register_columns

c = F.col
LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()
#: Null for some rows, so that null rules show.
STATUS = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END"
PRIORITY = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END"


def status():
    return F.expr(STATUS)


def priority():
    return F.expr(PRIORITY)


register_columns("pred_01_02_path_equality", "orders", ["o_orderkey"], {
    "same_number": (lambda: P.path_equals(c("o_orderkey"), c("o_custkey"), LONG, LONG), "coalesce(o_orderkey = o_custkey, false)"),
    "same_text": (lambda: P.path_equals(status(), F.lit("F"), TEXT, TEXT), f"coalesce({STATUS} = 'F', false)"),
    "number_as_text": (lambda: P.path_equals(c("o_custkey"), F.lit("7"), LONG, TEXT), "CAST(o_custkey AS VARCHAR) = '7'"),
    "other_text": (lambda: P.path_not_equals(status(), F.lit("F"), TEXT, TEXT), f"coalesce({STATUS} <> 'F', false)"),
    "number_not_text": (lambda: P.path_not_equals(c("o_custkey"), F.lit("7"), LONG, TEXT), "false"),
})
register_columns("pred_03_path_order", "orders", ["o_orderkey"], {
    "less": (lambda: P.path_less(c("o_totalprice"), F.lit("100000")), "o_totalprice < 100000"),
    "at_most": (lambda: P.path_less_or_equal(c("o_custkey"), F.lit(50)), "o_custkey <= 50"),
    "more": (lambda: P.path_greater(F.substring("o_orderpriority", 1, 1), F.lit(2)), "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) > 2"),
    "at_least": (lambda: P.path_greater_or_equal(priority(), F.lit(1)), "false"),
})
register_columns("pred_04_text_parts", "orders", ["o_orderkey"], {
    "has": (lambda: P.contains(priority(), F.lit("IGH")), f"coalesce(contains({PRIORITY}, 'IGH'), false)"),
    "starts": (lambda: P.starts_with(priority(), F.lit("1")), f"coalesce(starts_with({PRIORITY}, '1'), false)"),
    "ends": (lambda: P.ends_with(priority(), F.lit("NT")), f"coalesce(ends_with({PRIORITY}, 'NT'), false)"),
})
register_columns("pred_05_12_regex", "orders", ["o_orderkey"], {
    "whole": (lambda: P.matches(priority(), r"\d-[A-Z]+"), f"coalesce(regexp_full_match({PRIORITY}, '\\d-[A-Z]+'), false)"),
    "part": (lambda: P.find(priority(), "U[RM]"), f"coalesce(regexp_matches({PRIORITY}, 'U[RM]'), false)"),
})
register_columns("pred_06_08_empty", "documents", ["doc_id"], {
    "empty": (lambda: P.path_is_empty(F.substring("text", 1, c("doc_id").cast("int") % 2)), "doc_id % 2 = 0 OR text = ''"),
    "blank": (lambda: P.is_blank(F.expr("if(doc_id % 3 = 0, '  ', if(doc_id % 3 = 1, NULL, text))")), "doc_id % 3 < 2"),
    "is_null": (lambda: P.is_null(c("lang")), "lang IS NULL"),
    "not_null": (lambda: P.not_null(c("lang")), "lang IS NOT NULL"),
})
register_columns("pred_07_13_logic", "orders", ["o_orderkey"], {
    "neither": (lambda: P.negate(status() == "F"), f"NOT coalesce({STATUS} = 'F', false)"),
    "both": (lambda: P.all_of(status() == "O", priority().startswith("1")), f"coalesce({STATUS} = 'O', false) AND coalesce({PRIORITY} LIKE '1%', false)"),
    "either": (lambda: P.any_of(status() == "O", priority().startswith("1")), f"coalesce({STATUS} = 'O', false) OR coalesce({PRIORITY} LIKE '1%', false)"),
})
register_columns("pred_09_10_compare", "orders", ["o_orderkey"], {
    "same": (lambda: P.equals(status(), F.lit("O")), f"coalesce({STATUS} = 'O', false)"),
    "same_any_case": (lambda: P.equals_ignore_case(status(), F.lit("o")), f"coalesce(lower({STATUS}) = 'o', false)"),
    "gt": (lambda: P.gt(c("o_totalprice"), F.lit(200000.0)), "o_totalprice > 200000"),
    "ge": (lambda: P.ge(c("o_custkey"), F.lit(100)), "o_custkey >= 100"),
    "lt": (lambda: P.lt(c("o_custkey"), F.lit(100)), "o_custkey < 100"),
    "le": (lambda: P.le(c("o_totalprice"), F.lit(None).cast("double")), "false"),
})
register_columns("pred_11_14_in_if", "orders", ["o_orderkey"], {
    "among": (lambda: P.is_in(status(), "O", "P"), f"coalesce({STATUS} IN ('O', 'P'), false)"),
    "choice": (lambda: P.if_else(status() == "O", F.lit("open"), F.lit("other")), f"CASE WHEN {STATUS} = 'O' THEN 'open' ELSE 'other' END"),
})
register_columns("pred_15_17_18_several", "orders", ["o_orderkey"], {
    "some": (lambda: P.any_of(*(P.contains(x, F.lit("O")) for x in (status(), priority()))), f"coalesce({STATUS} LIKE '%O%', false) OR coalesce({PRIORITY} LIKE '%O%', false)"),
    "any_part": (lambda: P.any_delimited(priority(), "-", lambda x: x == "1"), f"coalesce(list_contains(string_split({PRIORITY}, '-'), '1'), false)"),
    "all_parts": (lambda: P.all_delimited(priority(), "-", lambda x: F.length(x) < 5), f"coalesce(len(list_filter(string_split({PRIORITY}, '-'), lambda x: length(x) >= 5)) = 0, false)"),
    "passed": (lambda: P.count_true(status() == "O", priority().startswith("1"), c("o_custkey") > 50), f"(coalesce({STATUS} = 'O', false)::BIGINT + coalesce({PRIORITY} LIKE '1%', false)::BIGINT + (o_custkey > 50)::BIGINT)"),
    "joined": (lambda: P.join_values("|", status(), priority(), c("o_custkey")), f"coalesce({STATUS}, '') || '|' || coalesce({PRIORITY}, '') || '|' || o_custkey"),
})


@register("pred_16_columns_by_pattern", "SELECT c_custkey, contains(c_name, '1') OR contains(c_mktsegment, '1') AS some, contains(c_name, 'U') AND contains(c_mktsegment, 'U') AS every FROM customer")
def columns_by_pattern(spark, sf_dir):
    df = load(spark, sf_dir, "customer")
    names = P.matching_columns(df, "^c_name$", "segment$")
    return df.select("c_custkey", P.any_column(names, lambda x: x.contains("1")).alias("some"), P.all_columns(names, lambda x: x.contains("U")).alias("every"))


@register("pred_15_any_all_columns", "SELECT p_partkey, contains(p_name, '1') OR contains(p_type, '1') AS some, length(p_name) > 5 AND length(p_type) > 5 AS every FROM part")
def any_all_columns(spark, sf_dir):
    names = ["p_name", "p_type"]
    return load(spark, sf_dir, "part").select("p_partkey", P.any_column(names, lambda x: x.contains("1")).alias("some"), P.all_columns(names, lambda x: F.length(x) > 5).alias("every"))


register_columns("strfn_01_case_trim", "part", ["p_partkey"], {
    "up": (lambda: S.to_upper(c("p_name")), "upper(p_name)"),
    "low": (lambda: S.to_lower(c("p_type")), "lower(p_type)"),
    "trimmed": (lambda: S.trim(F.concat(F.lit(" \t"), c("p_brand"), F.lit(" \n"))), "p_brand"),
})
register_columns("strfn_02_substring", "orders", ["o_orderkey"], {
    "middle": (lambda: S.substring(priority(), 2, 5), f"CASE WHEN length({PRIORITY}) >= 5 THEN substr({PRIORITY}, 3, 3) ELSE '' END"),
    "rest": (lambda: S.substring(priority(), 2), f"coalesce(substr({PRIORITY}, 3), '')"),
    "beyond": (lambda: S.substring(priority(), 3, 60), "''"),
})
register_columns("strfn_03_path_substring", "orders", ["o_orderkey"], {
    "whole": (lambda: S.path_substring(priority(), 0, -1), PRIORITY),
    "tail": (lambda: S.path_substring(priority(), -4, -1), f"substr({PRIORITY}, length({PRIORITY}) - 2, 3)"),
    "clipped": (lambda: S.path_substring(priority(), 2, 99), f"substr({PRIORITY}, 3)"),
    "backward": (lambda: S.path_substring(priority(), 3, 2), f"CASE WHEN {PRIORITY} IS NOT NULL THEN '' END"),
})
URL = "url"
register_columns("strfn_04_before_after", "pages", ["page_id"], {
    "before": (lambda: S.substring_before(c(URL), "/"), "CASE WHEN contains(url, '/') THEN substr(url, 1, instr(url, '/') - 1) ELSE url END"),
    "after": (lambda: S.substring_after(c(URL), "//"), "CASE WHEN contains(url, '//') THEN substr(url, instr(url, '//') + 2) ELSE url END"),
    "before_last": (lambda: S.substring_before_last(c(URL), "/"), "regexp_replace(url, '/[^/]*$', '')"),
    "after_last": (lambda: S.substring_after_last(c(URL), "/"), "regexp_extract(url, '[^/]*$')"),
    "missing": (lambda: S.substring_before(c(URL), "\x01"), "url"),
    "nothing": (lambda: S.substring_after(c(URL), ""), "url"),
})
register_columns("strfn_05_06_places", "pages", ["page_id"], {
    "first": (lambda: S.index_of(c(URL), "e"), "(instr(url, 'e') - 1)::BIGINT"),
    "last": (lambda: S.last_index_of(c(URL), "/"), "(length(url) - strpos(reverse(url), '/'))::BIGINT"),
    "absent": (lambda: S.last_index_of(c(URL), "\x01"), "-1::BIGINT"),
    "size": (lambda: S.length(F.expr("if(page_id % 2 = 0, NULL, url)")), "CASE WHEN page_id % 2 = 0 THEN 0 ELSE length(url) END::BIGINT"),
})
register_columns("strfn_07_el_parts", "orders", ["o_orderkey"], {
    "has": (lambda: P.contains(status(), F.lit("O")), f"coalesce(contains({STATUS}, 'O'), false)"),
    "starts": (lambda: P.starts_with(status(), F.lit("F")), f"coalesce(starts_with({STATUS}, 'F'), false)"),
})
register_columns("strfn_08_09_concat_replace", "orders", ["o_orderkey"], {
    "before": (lambda: S.prepend(status(), "s="), f"'s=' || coalesce({STATUS}, '')"),
    "after": (lambda: S.append(status(), "."), f"coalesce({STATUS}, '') || '.'"),
    "all": (lambda: S.concat(status(), priority(), c("o_custkey")), f"coalesce({STATUS}, '') || coalesce({PRIORITY}, '') || o_custkey"),
    "swapped": (lambda: S.replace(c("o_orderpriority"), "O", "00"), "replace(o_orderpriority, 'O', '00')"),
})
register_columns("strfn_10_regex_replace", "part", ["p_partkey"], {
    "one": (lambda: S.replace_first(c("p_type"), "([A-Z])([A-Z]+)", "$2$1"), r"regexp_replace(p_type, '([A-Z])([A-Z]+)', '\2\1')"),
    "every": (lambda: S.replace_all(c("p_type"), "([AEIOU])", "<$1>"), r"regexp_replace(p_type, '([AEIOU])', '<\1>', 'g')"),
})
register_columns("strfn_11_replace_null", "orders", ["o_orderkey"], {
    "no_null": (lambda: S.replace_null(status(), F.lit("?")), f"coalesce({STATUS}, '?')"),
    "no_blank": (lambda: S.replace_empty(F.expr("if(o_orderkey % 2 = 0, ' ', o_orderstatus)"), F.lit("?")), "CASE WHEN o_orderkey % 2 = 0 THEN '?' ELSE o_orderstatus END"),
    "first": (lambda: S.coalesce(status(), priority(), F.lit("-")), f"coalesce({STATUS}, {PRIORITY}, '-')"),
})
register_columns("strfn_12_13_pad_repeat", "customer", ["c_custkey"], {
    "left_pad": (lambda: S.pad_left(c("c_name"), 22), "CASE WHEN length(c_name) < 22 THEN lpad(c_name, 22, '_') ELSE c_name END"),
    "right_pad": (lambda: S.pad_right(c("c_name"), 22, "xy"), "CASE WHEN length(c_name) < 22 THEN rpad(c_name, 22, 'xy') ELSE c_name END"),
    "same": (lambda: S.pad_left(c("c_name"), 0), "c_name"),
    "thrice": (lambda: S.repeat(c("c_name"), 3), "repeat(c_name, 3)"),
    "random_ok": (lambda: F.length(S.repeat(c("c_name"), 2, 4, seed=3)).between(2 * F.length("c_name"), 4 * F.length("c_name")), "true"),
})
register_columns("strfn_14_delimited_field", "part", ["p_partkey"], {
    "second": (lambda: S.delimited_field(F.concat_ws(",", F.lit("a"), F.concat(F.lit('"'), c("p_name"), F.lit(',x"')), c("p_brand")), 2), "'\"' || p_name || ',x\"'"),
    "stripped": (lambda: S.delimited_field(F.concat_ws(",", F.lit("a"), F.concat(F.lit('"'), c("p_name"), F.lit(',x"')), c("p_brand")), 2, strip=True), "p_name || ',x'"),
    "third": (lambda: S.delimited_field(F.concat_ws(",", F.lit("a"), F.concat(F.lit('"'), c("p_name"), F.lit(',x"')), c("p_brand")), 3), "p_brand"),
    "none": (lambda: S.delimited_field(c("p_brand"), 5), "''"),
})
register_columns("strfn_15_radix", "orders", ["o_orderkey"], {
    "hexed": (lambda: S.to_radix(c("o_orderkey"), 16, 8), "lpad(lower(to_hex(o_orderkey)), 8, '0')"),
    "binary_digits": (lambda: S.to_radix(-c("o_custkey"), 2), "CASE WHEN o_custkey = 0 THEN '0' ELSE '-' || bin(o_custkey) END"),
    "back": (lambda: S.from_radix(S.to_radix(-c("o_custkey"), 36), 36), "-o_custkey"),
})
register_columns("strfn_16_17_encodings", "part", ["p_partkey"], {
    "url": (lambda: S.url_encode(F.concat(c("p_name"), F.lit("é&=/"))), "replace(url_encode(p_name || 'é&=/'), '%20', '+')"),
    "url_back": (lambda: S.url_decode(S.url_encode(c("p_type"))), "p_type"),
    "b64": (lambda: S.base64_encode(c("p_name")), "base64(encode(p_name))"),
    "b64_back": (lambda: S.base64_decode(S.base64_encode(c("p_name"))), "p_name"),
})
register_columns("strfn_18_escapes", "pages", ["page_id"], {
    "xml": (lambda: S.escape_xml(F.substring("html", 1, 400)), "replace(replace(replace(replace(replace(substr(html, 1, 400), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&apos;')"),
    "xml_back": (lambda: S.unescape_xml(S.escape_xml(c("html"))), "html"),
    "csv": (lambda: S.escape_csv(c("html")), "CASE WHEN regexp_matches(html, '[,\"\\r\\n]') THEN '\"' || replace(html, '\"', '\"\"') || '\"' ELSE html END"),
    "csv_back": (lambda: S.unescape_csv(S.escape_csv(c("html"))), "html"),
    "json_back": (lambda: S.unescape_json_text(S.escape_json_text(c("html"))), "html"),
    "html4_back": (lambda: S.unescape_html4(S.escape_html4(c("url"))), "url"),
    "html3": (lambda: S.escape_html3(F.lit('é<"&')), "'&eacute;&lt;&quot;&amp;'"),
})
register_columns("strfn_19_json_values", "events", ["event_id"], {
    "as_json": (lambda: S.escape_json(c("event_type")), "'\"' || event_type || '\"'"),
    "number_json": (lambda: S.escape_json(c("user_id")), "CAST(user_id AS VARCHAR)"),
    "back": (lambda: S.unescape_json(S.escape_json(c("user_id")), "bigint"), "user_id"),
})
register_columns("strfn_20_hash", "customer", ["c_custkey"], {
    "m": (lambda: S.hash_text(c("c_name"), "MD5"), "md5(c_name)"),
    "s1": (lambda: S.hash_text(c("c_name"), "SHA-1"), "sha1(c_name)"),
    "s256": (lambda: S.hash_text(c("c_name"), "SHA-256"), "sha256(c_name)"),
})
def _uuid_sql(hash_, version):
    return f"(SELECT h[1:8] || '-' || h[9:12] || '-{version}' || h[14:16] || '-' || substr('89ab', (('0x' || h[17])::INT & 3) + 1, 1) || h[18:20] || '-' || h[21:32] FROM (SELECT {hash_} AS h))"


register_columns("strfn_21_named_uuid", "customer", ["c_custkey"], {
    "v3": (lambda: S.uuid3(c("c_name"), "6ba7b810-9dad-11d1-80b4-00c04fd430c8"), _uuid_sql("md5(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_name))", 3)),
    "v5": (lambda: S.uuid5(c("c_name")), _uuid_sql("sha1(unhex('00000000000000000000000000000000') || encode(c_name))", 5)),
})
register_columns("strfn_22_24_names", "customer", ["c_custkey"], {
    "uuid_size": (lambda: F.length(S.uuid()), "36"),
    "name": (lambda: S.field_name("/a/b"), "'b'"),
})
register_columns("strfn_23_25_charsets", "documents", ["doc_id"], {
    "size": (lambda: F.octet_length(S.text_to_bytes(c("text"))), "strlen(text)"),
    "back": (lambda: F.md5(S.bytes_to_text(S.text_to_bytes(c("text"))).cast("binary")), "md5(text)"),
    "wide": (lambda: F.octet_length(S.convert_charset(S.text_to_bytes(c("source")), "UTF-8", "UTF-16BE")), "2 * length(source)"),
})

register_columns("fn_01_02_arithmetic", "lineitem", ["l_orderkey", "l_linenumber"], {
    "added": (lambda: N.plus(c("l_quantity"), c("l_linenumber"), DOUBLE, LONG), "l_quantity + l_linenumber"),
    "less": (lambda: N.minus(c("l_orderkey"), c("l_partkey"), LONG, LONG), "l_orderkey - l_partkey"),
    "times": (lambda: N.multiply(c("l_extendedprice"), c("l_discount"), DOUBLE, DOUBLE), "l_extendedprice * l_discount"),
    "whole": (lambda: N.divide(c("l_partkey"), c("l_linenumber"), LONG, LONG), "(l_partkey // l_linenumber)::BIGINT"),
    "part": (lambda: N.divide(c("l_extendedprice"), c("l_quantity"), DOUBLE, DOUBLE), "l_extendedprice / l_quantity"),
    "rest": (lambda: N.mod(c("l_partkey"), F.lit(7), LONG, LONG), "(l_partkey % 7)::BIGINT"),
})
register_columns("fn_03_math", "supplier", ["s_suppkey"], {
    "size": (lambda: N.math(c("s_acctbal"), "abs"), "abs(s_acctbal)"),
    "up": (lambda: N.math(c("s_acctbal"), "ceil"), "ceil(s_acctbal)::BIGINT"),
    "down": (lambda: N.math(c("s_acctbal"), "floor"), "floor(s_acctbal)::BIGINT"),
    "root": (lambda: N.math(N.math(c("s_acctbal"), "abs"), "sqrt"), "sqrt(abs(s_acctbal))"),
    "most": (lambda: N.math(c("s_acctbal"), "max", F.lit(0.0)), "greatest(s_acctbal, 0.0)"),
})
register_columns("fn_04_to_number", "part", ["p_partkey"], {
    "from_text": (lambda: N.to_number(F.regexp_extract("p_brand", r"(\d+)", 1)), r"CAST(nullif(regexp_extract(p_brand, '(\d+)', 1), '') AS BIGINT)"),
    "not_one": (lambda: N.to_number(c("p_brand")), "CAST(NULL AS BIGINT)"),
    "decimal": (lambda: N.to_decimal(c("p_retailprice").cast("string")), "p_retailprice"),
})
register_columns("fn_05_06_07_generated", "customer", ["c_custkey"], {
    "random_ok": (lambda: N.random_number(5) >= 0, "true"),
    "next_ok": (lambda: N.next_int() >= 0, "true"),
    "now_ok": (lambda: N.now() > F.lit("2020-01-01").cast("timestamp"), "true"),
})
register_columns("fn_08_09_to_date", "orders", ["o_orderkey"], {
    "parsed": (lambda: N.to_date(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"), "dd/MM/yyyy HH:mm"), "date_trunc('minute', o_orderdate)"),
    "bad": (lambda: N.to_date(c("o_orderpriority"), "yyyy"), "CAST(NULL AS TIMESTAMP)"),
    "zoned": (lambda: N.to_date(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss", "Asia/Tokyo"), "date_trunc('second', o_orderdate) - INTERVAL 9 HOUR"),
    "left_alone": (lambda: N.path_to_date(c("o_orderpriority"), "yyyy-MM-dd"), "o_orderpriority"),
    "of_millis": (lambda: N.number_to_date(c("o_orderkey") * 86400000), "make_timestamp(o_orderkey * 86400000000)"),
})
register_columns("fn_10_11_format", "orders", ["o_orderkey"], {
    "day": (lambda: N.format_date(c("o_orderdate"), "yyyy/MM/dd"), "strftime(o_orderdate, '%Y/%m/%d')"),
    "in_tokyo": (lambda: N.format_date(c("o_orderdate"), "yyyy-MM-dd HH", "Asia/Tokyo"), "strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d %H')"),
    "slashes": (lambda: N.implicit_date(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss")), "date_trunc('second', o_orderdate)"),
    "digits": (lambda: N.implicit_date((c("o_custkey") * 1000).cast("string")), "make_timestamp(o_custkey * 1000000)"),
    "none": (lambda: N.implicit_date(c("o_orderpriority")), "CAST(NULL AS TIMESTAMP)"),
})
register_columns("fn_12_json_path", "events", ["event_id"], {
    "value_text": (lambda: N.json_path(F.to_json(F.struct(F.struct("user_id", "event_type").alias("a"))), "$.a.event_type"), "event_type"),
    "absent": (lambda: N.json_path(c("props"), "$.no_such_key"), "''"),
    "one": (lambda: N.json_path(F.to_json(F.struct(F.array("user_id").alias("l"))), "$.l"), "CAST(user_id AS VARCHAR)"),
})
register_columns("fn_13_json_edit", "events", ["event_id"], {
    "put": (lambda: N.json_path_put(F.to_json(F.struct(F.struct("user_id").alias("a"))), "$.a", "b", 1), "'{\"a\":{\"user_id\":' || user_id || ',\"b\":1}}'"),
    "put_none": (lambda: N.json_path_set(F.to_json(F.struct("user_id")), "$.zzz", 1), "'{\"user_id\":' || user_id || '}'"),
    "added": (lambda: N.json_path_add(F.to_json(F.struct(F.array("user_id").alias("l"))), "$.l", 9), "'{\"l\":[' || user_id || ',9]}'"),
    "gone": (lambda: N.json_path_delete(F.to_json(F.struct("user_id", "event_type")), "$.event_type"), "'{\"user_id\":' || user_id || '}'"),
    "set": (lambda: N.json_path_set(F.to_json(F.struct("user_id", F.lit(1).alias("x"))), "$.x", "y"), "'{\"user_id\":' || user_id || ',\"x\":\"y\"}'"),
})
