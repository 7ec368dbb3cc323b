"""Queries of readers and writers: each writes the given tables to the shared folder and reads them back."""

from __future__ import annotations

import functools
from json import dumps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import lookup
from millrace.plans.registry import load, register
from millrace.scratch import scratch_path
from millrace.sources import avro, readers, versioned, writers

c = F.col
CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("src_01_snk_01_csv", CUSTOMER)
def csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(load(spark, sf_dir, "customer"), path)
    return readers.read_csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@register("src_01_csv_unknown_fields", "SELECT c_custkey, c_name, c_nationkey::VARCHAR AS unknown_field_index_2, c_mktsegment AS unknown_field_index_3 FROM customer")
def csv_unknown(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(load(spark, sf_dir, "customer").drop("c_acctbal"), path)
    return readers.read_csv(spark, path, "c_custkey bigint, c_name string", drop_unknown=False)


@register("src_02_csv_header", "SELECT c_custkey::VARCHAR AS c_custkey, c_name FROM customer")
def csv_header(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(load(spark, sf_dir, "customer").select("c_custkey", "c_name"), path, sep=";")
    return readers.read_csv_header(spark, path, ";")


@register("src_03_csv_inferred", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_acctbal FROM customer")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return readers.read_csv_inferred(spark, path).withColumn("c_acctbal", c("c_acctbal").cast("double"))


@register("src_04_snk_02_json", CUSTOMER)
def json(spark, sf_dir):
    path = scratch_path(spark, "json")
    writers.write_json(load(spark, sf_dir, "customer"), path, "array")
    return readers.read_json(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@register("src_05_json_paths", "SELECT c_custkey::VARCHAR AS k, c_name AS n FROM customer")
def json_paths(spark, sf_dir):
    path = scratch_path(spark, "json")
    writers.write_json(load(spark, sf_dir, "customer").select(F.struct("c_custkey", "c_name").alias("a")), path)
    return readers.read_json_paths(spark, path, {"k": "$.a.c_custkey", "n": "$.a.c_name"})


@register("src_07_snk_04_parquet", "SELECT * FROM orders")
def parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    writers.write_parquet(load(spark, sf_dir, "orders"), path, block_size=1 << 20, page_size=1 << 16, codec="zstd", version="v2")
    return readers.read_parquet(spark, path)


@register("snk_05_orc", "SELECT * FROM part")
def orc(spark, sf_dir):
    path = scratch_path(spark, "orc")
    writers.write_orc(load(spark, sf_dir, "part"), path)
    return readers.read_orc(spark, path)


@register("src_08_snk_06_xml", "SELECT p_partkey, p_name, p_size FROM part")
def xml(spark, sf_dir):
    path = scratch_path(spark, "xml")
    writers.write_xml(load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), path, "part")
    return readers.read_xml(spark, path, "part", "p_partkey bigint, p_name string, p_size int")


@register("src_09_snk_07_text", "SELECT c_name || ' of nation ' || c_nationkey || '.' AS value FROM customer")
def text(spark, sf_dir):
    path = scratch_path(spark, "text")
    writers.write_free_text(load(spark, sf_dir, "customer"), path, "${c_name} of ${what} ${c_nationkey}.", {"what": "nation", "c_name": "no"})
    return readers.read_text_lines(spark, path).select("value")


@register("src_09_binary", "SELECT sum(strlen(o_orderpriority) + 1)::BIGINT AS bytes FROM orders")
def binary(spark, sf_dir):
    path = scratch_path(spark, "binary")
    load(spark, sf_dir, "orders").select("o_orderpriority").write.text(path)
    return readers.read_binary(spark, path).agg(F.sum(F.octet_length("content")).alias("bytes"))


@register("src_10_snk_14_sequence_file", "SELECT c_custkey::VARCHAR AS key, c_name AS value FROM customer")
def sequence_file(spark, sf_dir):
    path = scratch_path(spark, "sequence")
    writers.write_sequence_file(load(spark, sf_dir, "customer"), path, "c_custkey", "c_name")
    return readers.read_sequence_file(spark, path)


@register("src_11_snk_13_object_store", "SELECT * FROM supplier")
def object_store(spark, sf_dir):
    path = scratch_path(spark, "store")
    uri = path if "://" in path else f"file://{path}"
    writers.write_object_store(load(spark, sf_dir, "supplier"), uri)
    return readers.read_object_store(spark, uri)


@register("src_12_list_files", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 1")
def list_files(spark, sf_dir):
    """Files that come after a listing, and only those, are listed the next time; their rows are read."""
    from millrace.scratch import written

    path, orders = scratch_path(spark, "files"), load(spark, sf_dir, "orders").select("o_orderkey")
    orders.filter("o_orderkey % 3 <> 1").write.parquet(path)
    known = written(readers.list_files(spark, path, pattern="*.parquet"), "listing")
    orders.filter("o_orderkey % 3 = 1").write.mode("append").parquet(path)
    fresh = readers.list_files(spark, path, known, "*.parquet")
    rows = spark.read.parquet(path).select("o_orderkey", c("_metadata.file_path").alias("path"))
    plain = lambda p: F.regexp_replace(p, "^file:/+", "/")
    return rows.withColumn("path", plain("path")).join(fresh.select(plain("path").alias("path")), "path", "left_semi").select("o_orderkey")


@register("src_13_snk_08_jdbc", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, -1.0 FROM customer WHERE c_custkey < 100")
def jdbc(spark, sf_dir):
    """Rows inserted in an embedded database and read by two statements; it lives in the driver's process, so this runs on a local master only."""
    import uuid

    url, options = f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = load(spark, sf_dir, "customer").select(c("c_custkey").alias("CK"), c("c_acctbal").alias("BAL"))
    writers.write_jdbc(df.limit(0), url, "CUST", options)
    writers.write_jdbc(df, url, "CUST", options)
    parts = readers.read_jdbc(spark, url, "SELECT CK, BAL FROM CUST WHERE MOD(CK, 2) = 0; SELECT CK, -1.0 AS BAL FROM CUST WHERE CK < 100", options)
    return parts[0].union(parts[1].select("CK", c("BAL").cast("double"))).toDF("c_custkey", "c_acctbal")


@register("src_14_table_slices", "WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders) SELECT low, low + 5000 AS high, 'o_orderkey >= ' || low || ' AND o_orderkey < ' || (low + 5000) AS predicate FROM b, range(a, b + 1, 5000) t(low)")
def table_slices(spark, sf_dir):
    return readers.table_slices(load(spark, sf_dir, "orders"), "o_orderkey", 5000)


@register("src_15_page", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 150")
def page(spark, sf_dir):
    return readers.read_page(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 50, 3)


@register("src_16_incremental", "SELECT event_id FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)")
def incremental(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    half = events.agg(F.expr("max(event_id) div 2").alias("m"))
    first = events.join(half, c("event_id") <= c("m")).select(*events.columns)
    _, state = readers.read_incremental(first, "event_id", None, "events")
    fresh, _ = readers.read_incremental(events, "event_id", state, "events")
    return fresh.select("event_id")


@register("src_17_19_snk_11_catalog", "SELECT c_custkey, c_name, CASE WHEN c_custkey < 50 THEN 'new' END AS note FROM customer UNION ALL SELECT c_custkey, c_name, NULL FROM customer WHERE c_custkey < 50")
def catalog(spark, sf_dir):
    import uuid

    name = f"t_{uuid.uuid4().hex}"
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    writers.write_table(customer.filter("c_custkey >= 50 OR c_custkey < 50"), name, path=scratch_path(spark, name))
    writers.write_table(customer.filter("c_custkey < 50").withColumn("note", F.lit("new")), name, evolve=True)
    if readers.list_tables(spark).filter(c("name") == name).isEmpty():
        raise AssertionError("the table is not listed")
    return readers.read_hive(spark, f"SELECT * FROM {name}")


@register("src_18_snk_12_kafka_rows", "SELECT event_id, user_id, event_type FROM events")
def kafka_rows(spark, sf_dir):
    """Messages as the writer makes them, read as the source gives them (the broker is not here)."""
    messages = writers.kafka_messages(load(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_id")
    rows = messages.select(c("key").cast("binary").alias("key"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"), c("value").cast("binary").alias("value"))
    return readers.kafka_rows(rows, "event_id bigint, user_id bigint, event_type string").select("event_id", "user_id", "event_type")


@register("src_21_generate", "SELECT n AS id, 'x' || n % 3 AS text, n * 2 AS a FROM (SELECT count(*) AS m FROM orders), range(m) t(n)")
def generate(spark, sf_dir):
    n = load(spark, sf_dir, "orders").count()
    return readers.generate_rows(spark, n, F.concat(F.lit("x"), F.col("id") % 3), {"a": F.col("id") * 2})


@register("snk_09_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT -1, 5.0")
def upsert(spark, sf_dir):
    target = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    source = target.filter("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(0.0)).union(target.filter("c_custkey = 0").select(F.lit(-1).cast("long"), F.lit(5.0)))
    return writers.upsert(target, source, ["c_custkey"])


@register("snk_09_10_repeated_keys", "SELECT c_custkey, max(o_orderkey) AS last, min(o_orderkey) AS first FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def repeated_keys(spark, sf_dir):
    """Orders put one after another in a table with a row for each customer: the last stays, or with insert-ignore the first."""
    source = load(spark, sf_dir, "orders").select(c("o_custkey").alias("c_custkey"), c("o_orderkey").alias("v"))
    none = load(spark, sf_dir, "customer").select("c_custkey", F.lit(-1).cast("long").alias("v")).filter("c_custkey < 0")
    put, ignored = writers.upsert(none, source, ["c_custkey"], "v"), writers.insert_ignore(none, source, ["c_custkey"], "v")
    return put.withColumnRenamed("v", "last").join(ignored.withColumnRenamed("v", "first"), "c_custkey").join(load(spark, sf_dir, "customer"), "c_custkey", "left_semi")


_CHANGED = "o_orderkey % 5000 < 50"


@register("snk_09_10_copy_on_write", f"SELECT o_orderkey, CASE WHEN {_CHANGED} THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders UNION ALL SELECT -o_orderkey - 1, 1.0 FROM orders WHERE {_CHANGED}")
def copy_on_write(spark, sf_dir):
    """An upsert of runs of keys, which are about 1 % of the orders, then new orders and known ones with insert-ignore, by file."""
    path = scratch_path(spark, "versioned")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", c("o_totalprice").cast("double").alias("o_totalprice"))
    versioned.create_table(orders, path, ["o_orderkey"], rows_per_file=10_000)
    changed = orders.filter(_CHANGED)
    versioned.merge_table(spark, path, changed.withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"])
    fresh = changed.withColumn("o_totalprice", F.lit(1.0))
    versioned.merge_table(spark, path, fresh.union(fresh.withColumn("o_orderkey", -c("o_orderkey") - 1)), ["o_orderkey"], ignore=True)
    return versioned.read_table(spark, path)


@register("snk_10_insert_ignore", "SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT -c_custkey, 0.0 FROM customer WHERE c_custkey > 0")
def insert_ignore(spark, sf_dir):
    target = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    source = target.select(-c("c_custkey"), F.lit(0.0)).toDF("c_custkey", "c_acctbal")
    return writers.insert_ignore(target, source, ["c_custkey"])


@register("snk_15_route_to_sink", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'O' WHEN 'F' THEN 'F' ELSE 'rest' END AS sink FROM orders")
def route_to_sink(spark, sf_dir):
    paths = {s: scratch_path(spark, f"sink-{s}") for s in ("O", "F", "rest")}
    write = lambda s: lambda df: df.write.parquet(paths[s])
    writers.route_to_sinks(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"O": write("O"), "F": write("F")}, write("rest"))
    parts = [spark.read.parquet(p).select("o_orderkey", F.lit(s).alias("sink")) for s, p in paths.items()]
    return parts[0].union(parts[1]).union(parts[2])


@register("snk_16_zero_rows", "SELECT o_orderstatus AS status, count(*) FILTER (o_totalprice > 450000) > 0 AS sent, count(*) FILTER (o_totalprice > 450000) AS n FROM orders GROUP BY o_orderstatus")
def zero_rows(spark, sf_dir):
    """The dear orders of each status to a sink of their own, which gets a call only if there are any; and zero rows too if asked."""
    orders, out = load(spark, sf_dir, "orders"), []
    for (status,) in orders.select("o_orderstatus").distinct().collect():
        dear = orders.filter((c("o_orderstatus") == status) & (c("o_totalprice") > 450000)).select("o_orderkey")
        path = scratch_path(spark, "zero")
        sent = writers.put_record(dear, lambda df, path=path: df.write.parquet(path))
        if not sent and not writers.put_record(dear, lambda df, path=path: df.write.parquet(path), send_zero=True):
            raise AssertionError("zero rows were asked for and not sent")
        out.append(spark.read.schema(dear.schema).parquet(path).agg(F.count("*").alias("n")).select(F.lit(status).alias("status"), F.lit(sent).alias("sent"), "n"))
    return functools.reduce(DataFrame.union, out)


@register("src_06_snk_03_avro", "SELECT * FROM orders")
def avro_round_trip(spark, sf_dir):
    path = scratch_path(spark, "avro")
    avro.write_avro(load(spark, sf_dir, "orders"), path)
    return avro.read_avro(spark, path)


@register("src_06_avro_other_schema", "SELECT o_orderkey::DOUBLE AS id, o_orderpriority AS priority, 'none' AS note, o_custkey AS key, o_orderstatus AS status FROM orders")
def avro_other_schema(spark, sf_dir):
    """Read by an outside schema: an alias, a wider number, a default and a nested record; fields that it does not name are passed over."""
    path = scratch_path(spark, "avro")
    nested = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.struct(c("o_custkey").alias("key"), F.array("o_orderstatus").alias("statuses")).alias("r"))
    avro.write_avro(nested, path, codec="null")
    fields = [
        {"name": "id", "aliases": ["o_orderkey"], "type": ["null", "double"]}, {"name": "o_orderpriority", "type": ["null", "string"]}, {"name": "note", "type": "string", "default": "none"},
        {"name": "r", "type": ["null", {"type": "record", "name": "r", "fields": [{"name": "key", "type": ["null", "long"]}, {"name": "statuses", "type": {"type": "array", "items": ["null", "string"]}}]}]},
    ]
    rows = avro.read_avro(spark, path, dumps({"type": "record", "name": "row", "fields": fields}))
    return rows.select("id", c("o_orderpriority").alias("priority"), "note", "r.key", c("r.statuses")[0].alias("status"))


@register("rec_15_convert_format", "SELECT * FROM supplier")
def convert_format(spark, sf_dir):
    path = scratch_path(spark, "converted")
    writers.convert_format(spark, f"{sf_dir}/supplier.parquet", "parquet", path, "orc", 3)
    return readers.read_orc(spark, path)


@register("join_02_04_lookup_files", "SELECT s_suppkey, n_name AS nation, n_name AS by_property FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def lookup_files(spark, sf_dir):
    path, properties = scratch_path(spark, "lookup-csv"), scratch_path(spark, "lookup-properties")
    nation = load(spark, sf_dir, "nation")
    writers.write_csv(nation, path)
    nation.select(F.concat_ws(" = ", "n_nationkey", "n_name")).toDF("v").write.text(properties)
    df = lookup.lookup_csv_value(load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", path, "n_nationkey", "n_name", "nation")
    return lookup.lookup_value(df, "s_nationkey", lookup.lookup_properties(spark, properties), "key", "value", "by_property").drop("s_nationkey")


@register("agg_16_since_last_run", "SELECT count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-09'")
def since_last_run(spark, sf_dir):
    import uuid

    from millrace.operators.analytics import query_since_last_run

    state = f"state_{uuid.uuid4().hex}"
    view = f"events_{uuid.uuid4().hex}"
    load(spark, sf_dir, "events").createOrReplaceTempView(view)
    sql = f"SELECT count(*) AS n FROM {view} WHERE ts > CAST(:start AS TIMESTAMP_NTZ) AND ts <= CAST(:end AS TIMESTAMP_NTZ)"
    query_since_last_run(spark, sql, state, "q", "2024-01-05 00:00:00", scratch_path(spark, state))
    return query_since_last_run(spark, sql, state, "q", "2024-01-09 00:00:00")
