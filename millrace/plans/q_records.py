"""Queries of the schema, record, reshaping and routing operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import jolt, records, routing, schema
from millrace.plans.registry import load, register

c = F.col

ROUTES = "CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 50000 THEN 'medium' ELSE 'unmatched' END"


@register("slice_orders_by_route", f"SELECT {ROUTES} AS route, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def slice_orders(spark, sf_dir):
    """Convert, look up, route, count: one query through the main operators."""
    from millrace.operators.lookup import lookup_record

    want = T._parse_datatype_string("o_orderkey bigint, o_custkey bigint, o_totalprice double")
    orders = schema.convert_record(load(spark, sf_dir, "orders"), want)
    found, _ = lookup_record(orders, load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), {"o_custkey": "c_custkey"})
    price = c("o_totalprice")
    routed = routing.route_on_attribute(found, {"large": price > 200000, "medium": (price > 50000) & (price <= 200000)})
    return routed.groupBy("route", "c_mktsegment").agg(F.count("*").alias("n"))


@register("sch_01_infer_schema", "SELECT * FROM (VALUES ('o_orderkey', 'INT'), ('o_totalprice', 'FLOAT'), ('o_orderdate', 'TIMESTAMP'), ('o_orderpriority', 'STRING'), ('mixed', 'STRING'), ('big', 'LONG'), ('none', 'STRING')) t(field, code)")
def infer_schema(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select(
        c("o_orderkey").cast("string"), F.format_string("%.2f", "o_totalprice").alias("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority", F.when(c("o_orderkey") % 2 == 0, c("o_orderkey").cast("string")).otherwise("x").alias("mixed"),
        (c("o_orderkey") + (1 << 40)).cast("string").alias("big"), F.lit(None).cast("string").alias("none"))
    codes = schema.infer_codes(df)
    return spark.createDataFrame(sorted(codes.items()), "field string, code string")


@register("sch_02_infer_temporal", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'TIMESTAMP' WHEN 1 THEN 'DATE' WHEN 2 THEN 'TIME' END AS code FROM orders")
def infer_temporal(spark, sf_dir):
    text = F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 2 THEN date_format(o_orderdate, 'HH:mm:ss') ELSE o_orderpriority END")
    return load(spark, sf_dir, "orders").select("o_orderkey", schema.temporal_code(text).alias("code"))


@register("sch_03_merge_schemas", "SELECT n_nationkey AS id, n_name AS name, NULL::VARCHAR AS segment FROM nation UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer")
def merge_schemas(spark, sf_dir):
    a = load(spark, sf_dir, "nation").select(c("n_nationkey").cast("long").alias("id"), F.struct(c("n_name").alias("name")).alias("r"))
    b = load(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), F.struct(c("c_mktsegment").alias("segment")).alias("r"))
    return schema.union_records(a, b).select("id", "r.name", "r.segment")


@register("sch_04_widen_types", "SELECT o_orderkey, o_custkey::DOUBLE AS v FROM orders")
def widen_types(spark, sf_dir):
    a = T._parse_datatype_string("o_orderkey bigint, v int")
    b = T._parse_datatype_string("o_orderkey bigint, v double")
    df = load(spark, sf_dir, "orders").select("o_orderkey", c("o_custkey").alias("v"))
    return schema.convert_record(df, schema.merge_schemas(a, b))


@register("sch_06_convert_record", "SELECT o_orderkey::INTEGER AS id, CAST(o_totalprice AS VARCHAR) IS NOT NULL AS has_price, 'none' AS note, TRY_CAST(o_orderpriority AS INTEGER) AS priority FROM orders")
def convert_record(spark, sf_dir):
    want = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("o_totalprice", T.StringType()), T.StructField("note", T.StringType(), True, {"default": "none"}), T.StructField("priority", T.IntegerType())])
    out = schema.convert_record(load(spark, sf_dir, "orders"), want, {"id": ["o_orderkey"], "priority": ["o_orderpriority"]})
    return out.select("id", c("o_totalprice").isNotNull().alias("has_price"), "note", "priority")


@register("sch_07_validate_record", "SELECT o_orderkey, o_orderkey % 5 = 0 AS missing, o_orderkey % 2 = 1 AS invalid FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 2 = 1")
def validate_record(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", F.expr("if(o_orderkey % 5 = 0, NULL, o_orderstatus)").alias("status"), F.expr("if(o_orderkey % 2 = 1, 'x', '1')").alias("n"))
    want = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("status", T.StringType(), False), T.StructField("n", T.IntegerType())])
    _, bad = schema.validate_record(df, want)
    has = lambda kind: F.exists("errors", lambda e: e["error"] == kind)
    return bad.select("o_orderkey", has("MISSING_FIELD").alias("missing"), has("INVALID_FIELD").alias("invalid"))


@register("sch_08_schema_by_name", "SELECT c_custkey AS id, c_name AS name, 7::BIGINT AS schema_id FROM customer")
def schema_by_name(spark, sf_dir):
    registry = spark.createDataFrame([("customer", 1, "id int"), ("customer", 2, "id long, name string")], "name string, version int, ddl string")
    want = schema.schema_by_name(registry, "customer")
    df = load(spark, sf_dir, "customer")
    body = F.concat(F.unhex(F.lit("0000000007")), F.to_json(F.struct(c("c_custkey").alias("id"), c("c_name").alias("name"))).cast("binary"))
    payload = df.select(body.alias("b"))
    return payload.select(F.from_json(F.expr("substring(b, 6)").cast("string"), want).alias("r"), schema.embedded_schema_id(c("b")).alias("schema_id")).select("r.*", "schema_id")


@register("sch_09_fingerprint", "SELECT sha256('o_orderkey:bigint;o_orderstatus:string') AS fingerprint, count(*) AS n, count(*) FILTER (o_orderstatus IS NOT NULL) AS whole FROM orders")
def fingerprint(spark, sf_dir):
    """Rows that carry the fingerprint of the schema that they were written with."""
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return df.withColumn("fingerprint", schema.schema_fingerprint(df)).groupBy("fingerprint").agg(F.count("*").alias("n"), F.count("o_orderstatus").alias("whole"))


@register("sch_10_time_formats", "SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y %H:%M') AS o_orderdate FROM orders")
def time_formats(spark, sf_dir):
    return schema.format_times(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), timestamp="dd.MM.yyyy HH:mm")


@register("rec_01_query_record", "SELECT o_orderstatus, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus HAVING count(*) > 1")
def query_record(spark, sf_dir):
    return records.query_record(load(spark, sf_dir, "orders"), "SELECT o_orderstatus, count(*) AS n, sum(o_custkey) AS keys FROM {RECORDS} WHERE o_totalprice > :least GROUP BY o_orderstatus HAVING count(*) > 1", {"least": 1000})


@register("rec_02_update_record", "SELECT o_orderkey, 'x' AS status, upper(o_orderpriority) AS priority, o_orderpriority AS old FROM orders")
def update_record(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", F.struct(c("o_orderstatus").alias("status"), c("o_orderpriority").alias("priority")).alias("r"))
    out = records.update_record(df, {"old": c("r.priority"), "r.status": "x", "r.priority": F.upper("r.priority")})
    return out.select("o_orderkey", "r.status", "r.priority", "old")


@register("rec_03_set_by_rules", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'big' WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def set_by_rules(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return records.set_by_rules(df, [(c("o_totalprice") > 200000, {"o_orderstatus": "big"}), (c("o_orderstatus") == "O", {"o_orderstatus": "open"})]).drop("o_totalprice")


@register("rec_04_rules_engine", "SELECT o_orderkey, 'costly' AS rule, 1 AS priority, 'alert' AS action FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT o_orderkey, 'open', 2, 'log' FROM orders WHERE o_orderstatus = 'O'")
def rules_engine(spark, sf_dir):
    df = load(spark, sf_dir, "orders")
    out = records.rules_engine(df, [("open", 2, c("o_orderstatus") == "O", "log"), ("costly", 1, c("o_totalprice") > 200000, "alert")])
    return out.select("o_orderkey", "rule", "priority", "action")


@register("rec_05_06_filter_validate", "SELECT o_orderkey, CASE WHEN o_custkey > 50 THEN 'valid' ELSE 'invalid' END AS validity FROM orders WHERE o_totalprice > 100000")
def filter_validate(spark, sf_dir):
    df = records.filter_record(load(spark, sf_dir, "orders"), c("o_totalprice") > 100000)
    return records.validate_by_predicate(df, c("o_custkey") > 50).select("o_orderkey", "validity")


@register("rec_07_transform_record", "SELECT c_custkey AS id, c_name || '!' AS name FROM customer WHERE c_custkey % 2 = 0")
def transform_record(spark, sf_dir):
    return records.transform_record(load(spark, sf_dir, "customer"), lambda r: {"id": r["c_custkey"], "name": r["c_name"] + "!"} if r["c_custkey"] % 2 == 0 else None, "id long, name string")


@register("rec_08_partition_record", "SELECT o_orderkey, o_orderstatus AS status FROM orders")
def partition_record(spark, sf_dir):
    return records.partition_record(load(spark, sf_dir, "orders"), {"status": "o_orderstatus"}).select("o_orderkey", "status")


@register("rec_09_split_record", "SELECT o_orderkey, (n // 1000)::BIGINT AS fragment_index, (n % 1000)::BIGINT AS row_in_fragment FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)")
def split_record(spark, sf_dir):
    return records.split_record(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 1000)


@register("rec_10_merge_bins", "SELECT o_orderkey, o_custkey, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3)::BIGINT AS bin FROM orders")
def merge_bins(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return records.merge_bins(df, "o_custkey", ["o_orderkey"], 3, 1 << 30, F.lit(100))


_BYTES = "1 + (o_orderkey * 7) % 13"


@register("rec_10_merge_bins_bytes", f"WITH RECURSIVE o AS (SELECT o_orderkey, o_custkey, {_BYTES} AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders), b AS (SELECT o_orderkey, o_custkey, i, size AS used, 1 AS n, 0 AS bin FROM o WHERE i = 1 UNION ALL SELECT o.o_orderkey, o.o_custkey, o.i, CASE WHEN n = 4 OR used + size > 20 THEN size ELSE used + size END, CASE WHEN n = 4 OR used + size > 20 THEN 1 ELSE n + 1 END, CASE WHEN n = 4 OR used + size > 20 THEN bin + 1 ELSE bin END FROM b JOIN o ON o.o_custkey = b.o_custkey AND o.i = b.i + 1) SELECT o_orderkey, o_custkey, bin::BIGINT AS bin FROM b")
def merge_bins_bytes(spark, sf_dir):
    """Bins of at most 4 rows and 20 bytes: both limits close some."""
    return records.merge_bins(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", ["o_orderkey"], 4, 20, F.expr(_BYTES))


_ONE_KEY = "1 + (c_custkey * 7) % 13"


@register("rec_10_merge_bins_one_key", f"WITH RECURSIVE o AS (SELECT c_custkey, {_ONE_KEY} AS size, row_number() OVER (ORDER BY c_custkey) AS i FROM customer), b AS (SELECT c_custkey, i, size AS used, 1 AS n, 0 AS bin FROM o WHERE i = 1 UNION ALL SELECT o.c_custkey, o.i, CASE WHEN n = 9 OR used + size > 60 THEN size ELSE used + size END, CASE WHEN n = 9 OR used + size > 60 THEN 1 ELSE n + 1 END, CASE WHEN n = 9 OR used + size > 60 THEN bin + 1 ELSE bin END FROM b JOIN o ON o.i = b.i + 1) SELECT c_custkey, bin::BIGINT AS bin FROM b")
def merge_bins_one_key(spark, sf_dir):
    """All rows under one key, which is null: the fold is cut in slices."""
    df = load(spark, sf_dir, "customer").select("c_custkey", F.lit(None).cast("double").alias("k"))
    return records.merge_bins(df, "k", ["c_custkey"], 9, 60, F.expr(_ONE_KEY)).select("c_custkey", "bin")


@register("rec_10_merge_bins_age", "WITH RECURSIVE o AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), b AS (SELECT event_id, user_id, i, t AS first, 1 AS n, 0 AS bin FROM o WHERE i = 1 UNION ALL SELECT o.event_id, o.user_id, o.i, CASE WHEN n = 5 OR t - first > 259200000000 THEN t ELSE first END, CASE WHEN n = 5 OR t - first > 259200000000 THEN 1 ELSE n + 1 END, CASE WHEN n = 5 OR t - first > 259200000000 THEN bin + 1 ELSE bin END FROM b JOIN o ON o.user_id = b.user_id AND o.i = b.i + 1) SELECT event_id, bin::BIGINT AS bin FROM b")
def merge_bins_age(spark, sf_dir):
    """Bins of at most 5 rows, none over three days."""
    return records.merge_bins(load(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", ["event_id"], 5, None, F.lit(1), "ts", 3 * 86400).select("event_id", "bin")


@register("rec_10_bin_states", "WITH b AS (SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS bin, floor(o_totalprice)::BIGINT AS size FROM orders), s AS (SELECT o_custkey, bin, count(*) AS n, sum(size)::BIGINT AS bytes FROM b GROUP BY ALL) SELECT o_custkey, bin, n, bytes, CASE WHEN bin < max(bin) OVER (PARTITION BY o_custkey) THEN 'closed' WHEN n >= 2 AND bytes >= 300000 THEN 'enough' ELSE 'waiting' END AS state FROM s")
def bin_states(spark, sf_dir):
    """Minima decide about each key's last bin."""
    binned = records.merge_bins(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.floor("o_totalprice").cast("long").alias("size")), "o_custkey", ["o_orderkey"], 3, None, c("size"))
    return records.bin_states(binned, "o_custkey", c("size"), 2, 300_000)


_PARTS_SQL = "SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS part, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS n FROM lineitem QUALIFY l_linenumber <> 3 OR l_orderkey % 2 = 0"
_PARTS_BY_ID = f"SELECT l_orderkey, count(DISTINCT l_linenumber) AS found, count(DISTINCT (l_linenumber, part)) AS parts, max(n) AS n FROM ({_PARTS_SQL}) GROUP BY l_orderkey"


def _parts(spark, sf_dir):
    """Lines as parts of their order; every other order has lost its third, and some have two values at one index."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_partkey").cast("string").alias("part"))
    counts = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n"))
    return lines.join(counts, "l_orderkey").filter("l_linenumber <> 3 OR l_orderkey % 2 = 0")


@register("rec_11_defragment", f"WITH d AS ({_PARTS_SQL}), ok AS (SELECT l_orderkey FROM ({_PARTS_BY_ID}) WHERE found = parts AND found = n) SELECT l_orderkey, string_agg(part, ',' ORDER BY l_linenumber) AS part FROM (SELECT DISTINCT l_orderkey, l_linenumber, part FROM d SEMI JOIN ok USING (l_orderkey)) GROUP BY l_orderkey")
def defragment(spark, sf_dir):
    return records.defragment(_parts(spark, sf_dir), "l_orderkey", "l_linenumber", "n", "part", ",")


@register("rec_11_defragment_failures", f"SELECT l_orderkey, CASE WHEN found < parts THEN 'two values at one index' ELSE 'parts are missing' END AS problem FROM ({_PARTS_BY_ID}) WHERE found < parts OR found < n")
def defragment_failures(spark, sf_dir):
    return records.defragment_failures(_parts(spark, sf_dir), "l_orderkey", "l_linenumber", "n", "part")


def _attributes(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", F.create_map(F.lit("flag"), c("l_returnflag"), F.lit("status"), c("l_linestatus"), F.concat(F.lit("line"), c("l_linenumber")), c("l_partkey").cast("string")).alias("m"))


@register("rec_12_keep_common", "SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS flag, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS status, CASE WHEN count(*) = 1 THEN max(CASE WHEN l_linenumber = 1 THEN l_partkey END)::VARCHAR END AS line1 FROM lineitem GROUP BY l_orderkey")
def keep_common(spark, sf_dir):
    return records.keep_common_attributes(_attributes(spark, sf_dir), "l_orderkey", "m").select("l_orderkey", *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("flag", "status", "line1")))


@register("rec_13_keep_unique", "SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS flag, CASE WHEN count(DISTINCT CASE WHEN l_linenumber = 1 THEN l_partkey END) = 1 THEN max(CASE WHEN l_linenumber = 1 THEN l_partkey END)::VARCHAR END AS line1 FROM lineitem GROUP BY l_orderkey")
def keep_unique(spark, sf_dir):
    return records.keep_unique_attributes(_attributes(spark, sf_dir), "l_orderkey", "m").select("l_orderkey", *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("flag", "line1")))


def _order_lines(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))


@register("rec_14_fork_record", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def fork_record(spark, sf_dir):
    return records.fork_record(_order_lines(spark, sf_dir), "lines", ["l_orderkey"])


@register("rec_16_split_json", "SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1)::INTEGER AS fragment_index, l_partkey FROM lineitem")
def split_json(spark, sf_dir):
    df = _order_lines(spark, sf_dir).select("l_orderkey", F.to_json(F.struct(F.struct("lines").alias("o"))).alias("j"))
    return records.split_json(df, "j", "$.o.lines", "struct<l_linenumber:int,l_partkey:bigint>", ["l_orderkey"]).select("l_orderkey", "fragment_index", "element.l_partkey")


@register("rec_16_split_xml", "SELECT c_custkey, i::INTEGER AS fragment_index, c_name || i AS v FROM customer, (VALUES (0), (1)) t(i)")
def split_xml(spark, sf_dir):
    df = load(spark, sf_dir, "customer").withColumn("x", F.format_string("<r><e>%s0</e><e>%s1</e></r>", "c_name", "c_name"))
    return records.split_xml(df, "x", "e array<string>", "e", ["c_custkey"]).select("c_custkey", "fragment_index", c("element").alias("v"))


@register("rec_17_sample_interval", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n % 10 = 0")
def sample_interval(spark, sf_dir):
    return records.sample_interval(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 10)


@register("rec_17_sample_membership", "SELECT count(*) BETWEEN 0 AND 1e12 AS sampled, least(100, count(*)) AS reservoir, true AS members FROM orders")
def sample_membership(spark, sf_dir):
    """Both samples hold rows of the table, each at most once; the probability sample is within 6 deviations of a tenth."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    n = orders.count()
    some, few = records.sample_probability(orders, 0.1, 11), records.sample_reservoir(orders, ["o_orderkey"], 100)
    of = lambda s: s.agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("d")).crossJoin(s.join(orders, "o_orderkey", "left_anti").agg(F.count("*").alias("strange")))
    a, b = of(some).toDF("n1", "d1", "s1"), of(few).toDF("n2", "d2", "s2")
    near = F.abs(c("n1") - n / 10) <= 6 * F.sqrt(F.lit(n * 0.09)) + 1
    return a.crossJoin(b).select(near.alias("sampled"), c("n2").alias("reservoir"), ((c("n1") == c("d1")) & (c("n2") == c("d2")) & (c("s1") == 0) & (c("s2") == 0)).alias("members"))


@register("rec_17_sample_probability")
def sample_probability(spark, sf_dir):
    return records.sample_probability(load(spark, sf_dir, "orders").select("o_orderkey"), 0.1, 11)


@register("rec_17_sample_reservoir")
def sample_reservoir(spark, sf_dir):
    return records.sample_reservoir(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 100)


@register("rec_18_record_stats", "SELECT 'record.count' AS name, NULL AS value, count(*) AS n FROM orders UNION ALL SELECT 'status', NULL, count(o_orderstatus) FROM orders UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'priority', NULL, count(o_orderpriority) FROM orders UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority")
def record_stats(spark, sf_dir):
    return records.record_stats(load(spark, sf_dir, "orders"), {"status": "o_orderstatus", "priority": "o_orderpriority"})


@register("rec_19_duplicate_rows", "SELECT c_custkey, i::INTEGER AS copy_index FROM customer, range(4) t(i)")
def duplicate_rows(spark, sf_dir):
    return records.duplicate_rows(load(spark, sf_dir, "customer").select("c_custkey"), 3)


@register("rec_20_flatten", "SELECT c_custkey AS id, c_name AS \"a.name\", c_nationkey AS \"a.b.region\" FROM customer")
def flatten(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), F.struct(c("c_name").alias("name"), F.struct(c("c_nationkey").alias("region")).alias("b")).alias("a"))
    return records.flatten(df)


@register("rec_21_json_paths", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.ref') AS ref FROM events")
def json_paths(spark, sf_dir):
    return records.evaluate_json_path(load(spark, sf_dir, "events").select("event_id", "props"), "props", {"k": "$.k", "ref": "$.ref"}).drop("props")


@register("rec_22_xpath", "SELECT c_custkey, c_name AS name, c_nationkey::VARCHAR AS region FROM customer")
def xpath(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select("c_custkey", F.format_string('<n region="%d"><name>%s</name></n>', "c_nationkey", "c_name").alias("x"))
    return records.evaluate_xpath(df, "x", {"name": "/n/name", "region": "/n/@region"}).drop("x")


@register("rec_23_attributes_to_text", "SELECT c_custkey, '{\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || c_nationkey || '}' AS attributes_json, c_name || ',' || c_nationkey AS attributes_csv FROM customer")
def attributes_to_text(spark, sf_dir):
    df = load(spark, sf_dir, "customer")
    names = ["c_name", "c_nationkey"]
    return records.attributes_to_csv(records.attributes_to_json(df, names), names).select("c_custkey", "attributes_json", "attributes_csv")


@register("rec_24_json_to_rows", "SELECT c_custkey, c_name FROM customer")
def json_to_rows(spark, sf_dir):
    df = load(spark, sf_dir, "customer").select(F.to_json(F.struct("*")).alias("j"))
    return records.json_to_rows(df, "j", T._parse_datatype_string("c_custkey long, c_name string"))


def _nested(spark, sf_dir):
    df = load(spark, sf_dir, "orders")
    return df.select(c("o_orderkey").alias("id"), F.struct(c("o_orderstatus").alias("z"), F.expr("if(o_orderkey % 3 = 0, NULL, o_orderpriority)").alias("a"), F.array("o_custkey", F.lit(1)).alias("l")).alias("r"))


@register("rec_25_jolt_shift", "SELECT o_orderkey AS k, o_orderstatus AS s FROM orders")
def jolt_shift(spark, sf_dir):
    return jolt.shift(_nested(spark, sf_dir), {"id": "out.k", "r.z": "out.deep.s", "not.there": "x"}).select("out.k", "out.deep.s")


@register("rec_26_27_jolt_default_remove", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE o_orderpriority END AS a, 'new' AS b FROM orders")
def jolt_default_remove(spark, sf_dir):
    out = jolt.remove(jolt.default(_nested(spark, sf_dir), {"r.a": "none", "r.b": "new"}), ["r.z", "r.l", "nothing"])
    return out.select("id", "r.*")


@register("rec_28_jolt_cardinality", "SELECT o_orderkey AS id, o_custkey AS l, o_orderstatus AS z FROM orders")
def jolt_cardinality(spark, sf_dir):
    return jolt.cardinality(_nested(spark, sf_dir), {"r.l": "ONE", "r.z": "MANY"}).select("id", "r.l", c("r.z")[0].alias("z"))


@register("rec_29_jolt_sort", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN '{\"l\":[' || o_custkey || ',1],\"z\":\"' || o_orderstatus || '\"}' ELSE '{\"a\":\"' || o_orderpriority || '\",\"l\":[' || o_custkey || ',1],\"z\":\"' || o_orderstatus || '\"}' END AS r FROM orders")
def jolt_sort(spark, sf_dir):
    return jolt.sort(_nested(spark, sf_dir)).select("id", F.to_json("r").alias("r"))


@register("rec_30_31_jolt_chain", "SELECT o_orderkey * 2 AS id, upper(o_orderstatus) AS z, CASE WHEN o_orderkey % 3 = 0 THEN 'dflt' ELSE o_orderpriority END AS a, 'made' AS fresh FROM orders")
def jolt_chain(spark, sf_dir):
    steps = [("modify-overwrite", {"id": c("id") * 2, "r.z": F.upper("r.z")}), ("modify-default", {"r.a": F.lit("dflt")}), ("modify-define", {"r.fresh": F.lit("made"), "id": F.lit(0)}), ("remove", ["r.l"]), ("sort", None)]
    return jolt.chain(_nested(spark, sf_dir), steps).select("id", "r.z", "r.a", "r.fresh")


@register("route_01_each", "SELECT o_orderkey, 'open' AS route FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'costly' FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT o_orderkey, 'unmatched' FROM orders WHERE NOT (o_orderstatus = 'O' OR o_totalprice > 200000)")
def route_each(spark, sf_dir):
    return routing.route_on_attribute(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), {"open": c("o_orderstatus") == "O", "costly": c("o_totalprice") > 200000}).select("o_orderkey", "route")


@register("route_01_all", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 'matched' ELSE 'unmatched' END AS route FROM orders")
def route_all(spark, sf_dir):
    return routing.route_on_attribute(load(spark, sf_dir, "orders"), {"open": c("o_orderstatus") == "O", "costly": c("o_totalprice") > 200000}, "all").select("o_orderkey", "route")


@register("route_02_content", "SELECT doc_id, 'the' AS route FROM documents WHERE regexp_matches(text, '\\bthe\\b') UNION ALL SELECT doc_id, 'der' FROM documents WHERE regexp_matches(text, '\\bder\\b') UNION ALL SELECT doc_id, 'unmatched' FROM documents WHERE NOT regexp_matches(text, '\\b(the|der)\\b')")
def route_content(spark, sf_dir):
    return routing.route_on_content(load(spark, sf_dir, "documents"), "text", {"the": r"\bthe\b", "der": r"\bder\b"}).select("doc_id", "route")


@register("route_03_text_lines", "WITH l AS (SELECT doc_id, (u.i - 1)::INTEGER AS line_number, string_split(text, chr(10))[u.i] AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) u(i)) SELECT doc_id, line_number, CASE WHEN contains(lower(line), 'licensed') THEN 'license' ELSE 'unmatched' END AS route FROM l")
def route_lines(spark, sf_dir):
    return routing.route_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", {"license": "LICENSED"}, ignore_case=True).select("doc_id", "line_number", "route")


@register("route_04_distributed", "SELECT count(*) AS n, count(*) > 100 AS uneven FROM orders")
def distributed(spark, sf_dir):
    """Every row goes to one output, and three in four to the heavier one, within 6 deviations."""
    dealt = routing.distribute_load(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], {"a": 3, "b": 1})
    heavy = F.sum(F.when(c("output") == "a", 1).otherwise(0))
    known = F.sum(F.when(c("output").isin("a", "b"), 1).otherwise(0))
    n = F.count_distinct("o_orderkey")
    return dealt.agg(known.alias("n"), ((F.abs(heavy - n * 0.75) <= 6 * F.sqrt(n * 0.1875)) & (n > 100)).alias("uneven"))


@register("route_04_distribute_load")
def distribute_load(spark, sf_dir):
    return routing.distribute_load(load(spark, sf_dir, "orders"), ["o_orderkey"], {"a": 3, "b": 1}).groupBy("output").agg(F.count("*").alias("n"))


@register("route_05_partition", "SELECT o_orderpriority, 1::BIGINT AS partitions FROM orders GROUP BY o_orderpriority")
def partition_by(spark, sf_dir):
    out = routing.partition_by_attribute(load(spark, sf_dir, "orders"), 8, "o_orderpriority").withColumn("p", F.spark_partition_id())
    return out.groupBy("o_orderpriority").agg(F.count_distinct("p").alias("partitions"))
