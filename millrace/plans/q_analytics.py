"""Queries of lookups, aggregation, windows and the batch forms of stateful operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import addresses, analytics, lookup, records
from millrace.plans.registry import load, register

c = F.col


# --- lookups ---------------------------------------------------------------


@register("join_01_lookup_value", "SELECT s_suppkey, n_name AS nation FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 2 = 0")
def lookup_value(spark, sf_dir):
    nation = load(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0")
    return lookup.lookup_value(load(spark, sf_dir, "supplier"), "s_nationkey", nation, "n_nationkey", "n_name", "nation").select("s_suppkey", "nation")


@register("join_02_unique_keys", "SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def unique_keys(spark, sf_dir):
    table = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return lookup.unique_keys(table, "o_custkey", "last", "o_orderkey").select("o_custkey", "o_orderpriority")


@register("join_03_lookup_record", "SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def lookup_struct(spark, sf_dir):
    return lookup.lookup_struct(load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}).select("c_custkey", "record.n_name", "record.n_regionkey")


@register("join_05_matched", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS brand FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 20")
def matched(spark, sf_dir):
    part = load(spark, sf_dir, "part").filter("p_size > 20").select("p_partkey", "p_brand")
    found, _ = lookup.lookup_record(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), part, {"l_partkey": "p_partkey"}, {"p_brand": "brand"})
    return found


@register("join_05_unmatched", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 20)")
def unmatched(spark, sf_dir):
    part = load(spark, sf_dir, "part").filter("p_size > 20").select("p_partkey", "p_brand")
    _, rest = lookup.lookup_record(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), part, {"l_partkey": "p_partkey"})
    return rest


@register("join_06_lookup_attributes", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS brand, s_name AS supplier FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def lookup_attributes(spark, sf_dir):
    out = lookup.lookup_attributes(load(spark, sf_dir, "lineitem"), {"brand": ("l_partkey", load(spark, sf_dir, "part"), "p_partkey", "p_brand"), "supplier": ("l_suppkey", load(spark, sf_dir, "supplier"), "s_suppkey", "s_name")})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "brand", "supplier")


def _ranges(spark, sf_dir):
    """Price ranges of unlike widths, nested and apart, one for each nation."""
    n = c("n_nationkey").cast("long")
    start = n * n * 700
    return load(spark, sf_dir, "nation").select(start.alias("s"), (start + F.when(n % 3 == 0, 250000).otherwise(9000)).alias("e"), c("n_name").alias("band"))


_RANGES_SQL = "(SELECT n_nationkey::BIGINT * n_nationkey * 700 AS s, n_nationkey::BIGINT * n_nationkey * 700 + CASE WHEN n_nationkey % 3 = 0 THEN 250000 ELSE 9000 END AS e, n_name AS band FROM nation)"


@register("join_10_lookup_range", f"SELECT o_orderkey, (SELECT min_by(band, (e - s, s)) FROM {_RANGES_SQL} WHERE floor(o_totalprice)::BIGINT BETWEEN s AND e) AS band FROM orders")
def lookup_range(spark, sf_dir):
    return lookup.lookup_range(load(spark, sf_dir, "orders").select("o_orderkey", F.floor("o_totalprice").alias("p")), "p", _ranges(spark, sf_dir), "s", "e", ["band"], width=1024).drop("p")


def _ips(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", F.format_string("10.%d.%d.%d", c("user_id") % 40, c("event_id") % 256, c("event_id") % 7).alias("ip"))


def _ip_ranges(spark, sf_dir):
    n = c("n_nationkey")
    return load(spark, sf_dir, "nation").select(F.format_string("10.%d.0.0", n).alias("start_ip"), F.format_string("10.%d.%d.255", n, F.when(n % 2 == 0, 255).otherwise(99)).alias("end_ip"), c("n_name").alias("city"), (n % 2 == 0).alias("is_vpn"))


_HIT = "(user_id % 40 < 25 AND (user_id % 2 = 0 OR event_id % 256 < 100))"


@register("join_09_enrich_ip", f"SELECT event_id, CASE WHEN {_HIT} THEN n_name END AS city, {_HIT} AS found FROM events LEFT JOIN nation ON n_nationkey = user_id % 40")
def enrich_ip(spark, sf_dir):
    return lookup.enrich_ip(_ips(spark, sf_dir), "ip", _ip_ranges(spark, sf_dir), ["city"]).select("event_id", "city", "found")


def _mixed_ips(spark, sf_dir):
    """Addresses of both versions, some in another form, and some that are none."""
    n, e = c("user_id") % 40, c("event_id")
    v4 = F.format_string("10.%d.%d.%d", n, e % 256, e % 7)
    six = F.concat(F.lit("2001:db8:"), F.lower(F.hex(n)), F.lit("::"), F.lower(F.hex(e % 65536)))
    return load(spark, sf_dir, "events").select("event_id", F.when(e % 5 == 0, F.concat(F.lit("::ffff:"), v4)).when(e % 5 == 1, six).when(e % 5 == 2, F.upper(six)).when(e % 5 == 3, v4).otherwise(F.when(e % 2 == 0, "2001:db9::1").otherwise("10.1.2")).alias("ip"))


def _prefixes(spark, sf_dir):
    n = c("n_nationkey")
    v4, v6 = F.format_string("10.%d.0.0/16", n), F.concat(F.lit("2001:DB8:"), F.hex(n), F.lit("::/48"))
    own = load(spark, sf_dir, "nation").select(F.explode(F.array(v4, v6)).alias("cidr"), c("n_name").alias("city"))
    whole = load(spark, sf_dir, "nation").filter("n_nationkey < 2").select(F.when(n == 0, "10.0.0.0/8").otherwise("2001:db8::/33").alias("cidr"), F.lit("wide").alias("city"))
    return own.union(whole)


@register("join_09_longest_prefix", "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN coalesce(n_name, 'wide') END AS city, event_id % 5 < 4 AS found FROM events LEFT JOIN nation ON n_nationkey = user_id % 40")
def longest_prefix(spark, sf_dir):
    return addresses.lookup_prefix(_mixed_ips(spark, sf_dir), "ip", _prefixes(spark, sf_dir), "cidr", ["city"]).select("event_id", "city", "found")


@register("join_11_anonymous_ip", "SELECT event_id, user_id % 40 < 25 AND user_id % 2 = 0 AS is_vpn FROM events")
def anonymous_ip(spark, sf_dir):
    return lookup.anonymous_ip(_ips(spark, sf_dir), "ip", _ip_ranges(spark, sf_dir), ["is_vpn"]).select("event_id", "is_vpn")


@register("join_12_lookup_script", "SELECT c_custkey, 'n' || c_custkey * 2 AS v FROM customer")
def lookup_script(spark, sf_dir):
    return lookup.lookup_script(load(spark, sf_dir, "customer"), "c_custkey", lambda k: f"n{k * 2}", "v").select("c_custkey", "v")


@register("join_08_refreshed", "SELECT event_id, user_id * 10 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS v FROM events")
def refreshed(spark, sf_dir):
    """Even events meet the table as it was, odd ones come after it has changed and grown too old."""
    from millrace.scratch import written

    events, now, version = load(spark, sf_dir, "events").select("event_id", "user_id"), [0.0], [1]
    read = lambda: written(events.select("user_id").distinct().withColumn("v", c("user_id") * 10 + version[0]), "refreshing")
    table = lookup.RefreshingLookup(read, 60.0, lambda: now[0])
    meet = lambda part: part.join(written(table.get(), "refreshed"), "user_id").select("event_id", "v")
    early = meet(events.filter("event_id % 2 = 0"))
    version[0], now[0] = 2, 61.0
    return early.union(meet(events.filter("event_id % 2 <> 0")))


@register("join_13_cache", "SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN 'new' ELSE n_name END AS v FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def cache(spark, sf_dir):
    old = load(spark, sf_dir, "nation").select(c("n_nationkey").alias("k"), c("n_name").alias("v"))
    now = lookup.cache_put(old, old.filter("k < 10").withColumn("v", F.lit("new")), "k")
    return lookup.cache_fetch(load(spark, sf_dir, "supplier"), now, "s_nationkey", "k", "v", "v").select("s_suppkey", "v")


@register("join_14_sql_joins", "SELECT 'semi' AS kind, count(*) AS n FROM customer SEMI JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 'anti', count(*) FROM customer ANTI JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 'full', count(*) FROM customer FULL JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 'theta', count(*) FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def sql_joins(spark, sf_dir):
    views = {n: load(spark, sf_dir, n) for n in ("customer", "orders", "nation")}
    return spark.sql(
        "SELECT 'semi' AS kind, count(*) AS n FROM {customer} LEFT SEMI JOIN {orders} ON o_custkey = c_custkey UNION ALL SELECT 'anti', count(*) FROM {customer} LEFT ANTI JOIN {orders} ON o_custkey = c_custkey "
        "UNION ALL SELECT 'full', count(*) FROM {customer} FULL JOIN {orders} ON o_custkey = c_custkey UNION ALL SELECT 'theta', count(*) FROM {nation} a JOIN {nation} b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey", **views)


# --- aggregation and windows -----------------------------------------------


@register("agg_01_group", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, avg(l_extendedprice) AS price, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL HAVING count(*) > 10")
def group(spark, sf_dir):
    return analytics.group_aggregates(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {"n": F.count("*"), "qty": F.sum("l_quantity"), "price": F.avg("l_extendedprice"), "suppliers": F.count_distinct("l_suppkey")}, c("n") > 10)


@register("agg_01_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup(spark, sf_dir):
    return analytics.group_aggregates(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {"n": F.count("*")}, how="rollup")


@register("agg_02_row_number", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS row_number FROM orders")
def row_number(spark, sf_dir):
    return analytics.row_numbers(load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "row_number")


@register("agg_03_pages", "SELECT c_custkey, ((row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) // 100)::BIGINT AS page FROM customer")
def pages(spark, sf_dir):
    return analytics.pages(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 100).select("c_custkey", "page")


@register("agg_04_query_aggregations", "SELECT 'hit' AS kind, o_orderkey::VARCHAR AS k, NULL::BIGINT AS n FROM (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus")
def query_aggregations(spark, sf_dir):
    hits, tables = analytics.query_with_aggregations(load(spark, sf_dir, "orders"), c("o_totalprice") > 100000, {"status": ("o_orderstatus", F.count("*"))}, [F.desc("o_totalprice"), "o_orderkey"], 10)
    return hits.select(F.lit("hit").alias("kind"), c("o_orderkey").cast("string").alias("k"), F.lit(None).cast("long").alias("n")).union(tables["status"].select(F.lit("status"), "o_orderstatus", "status"))


@register("agg_05_update_delete", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE NOT o_custkey < 20")
def update_delete(spark, sf_dir):
    df = analytics.delete_by_query(load(spark, sf_dir, "orders"), c("o_custkey") < 20)
    return analytics.update_by_query(df, c("o_totalprice") > 100000, {"o_orderstatus": F.lit("X")}).select("o_orderkey", "o_orderstatus")


@register("agg_06_limit", "SELECT 10::BIGINT AS n")
def limit(spark, sf_dir):
    return analytics.limit_rows(load(spark, sf_dir, "orders"), 10).agg(F.count("*").alias("n"))


@register("agg_07_prioritized", "SELECT event_id, value FROM events")
def prioritized(spark, sf_dir):
    return analytics.prioritized(load(spark, sf_dir, "events"), "attribute", "user_id", tie="event_id").select("event_id", "value")


@register("agg_08_rolling_bins", "WITH b AS (SELECT user_id, (floor(epoch(ts) / 3600) * 3600)::BIGINT AS bin, sum(value) AS total, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, bin, total, n, sum(total) OVER w AS rolling_total, (sum(n) OVER w)::BIGINT AS rolling_n FROM b WINDOW w AS (PARTITION BY user_id ORDER BY bin RANGE BETWEEN 82800 PRECEDING AND CURRENT ROW)")
def rolling_bins(spark, sf_dir):
    return analytics.rolling_bins(load(spark, sf_dir, "events"), "user_id", "ts", "value", 3600, 24)


@register("agg_09_snapshots", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05') WHERE n <= 3")
def snapshots(spark, sf_dir):
    return analytics.snapshot_history(load(spark, sf_dir, "events"), "user_id", "ts", 3, "2024-01-05").select("event_id")


@register("agg_10_trend", "WITH t AS (SELECT l_returnflag, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem GROUP BY l_returnflag) SELECT l_returnflag, n, round(slope, 3) AS slope, round(intercept, 2) AS intercept, round(r2, 6) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS adjusted_r2, round(intercept + 10 * slope, 2) AS at_ten FROM t")
def trend(spark, sf_dir):
    t = analytics.linear_trend(load(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    r = lambda name, n: F.round(name, n).alias(name)
    return t.select("l_returnflag", "n", r("slope", 3), r("intercept", 2), r("r2", 6), r("adjusted_r2", 6), F.round(analytics.predict_y(F.lit(10)), 2).alias("at_ten"))


@register("agg_11_backpressure", "WITH q AS (SELECT user_id, epoch(ts) AS x, sum(value) OVER (PARTITION BY user_id ORDER BY ts) AS y FROM events), t AS (SELECT user_id, regr_slope(y, x - 1704067200) AS m, regr_intercept(y, x - 1704067200) AS b, max(x) - 1704067200 AS last FROM q GROUP BY user_id) SELECT user_id, round(greatest(m * (last + 3600) + b, 0), 1) AS predicted, least(round(greatest(m * (last + 3600) + b, 0) / 10000 * 100), 100)::INTEGER AS predicted_percent, CASE WHEN m > 0 AND (10000 - b) / m - last >= 0 THEN round(round((10000 - b) / m - last), -2) ELSE -1 END::BIGINT AS seconds_to_threshold FROM t")
def backpressure(spark, sf_dir):
    """Queue sizes are running sums of the event values of each user."""
    from pyspark.sql import Window

    queue = load(spark, sf_dir, "events").withColumn("queued", F.sum("value").over(Window.partitionBy("user_id").orderBy("ts")))
    out = analytics.backpressure_prediction(queue, "user_id", "ts", "queued", 10000.0, 3600.0)
    # to a digit that no order of summing changes
    seconds = F.when(c("seconds_to_threshold") >= 0, F.round("seconds_to_threshold", -2)).otherwise(-1).cast("long")
    return out.withColumns({"predicted": F.round("predicted", 1), "seconds_to_threshold": seconds})


@register("agg_12_connection_status", "SELECT o_orderkey, (o_custkey % 3 * 100 > 0 AND o_custkey % 3 * 100 <= o_custkey) OR (200000 <= o_totalprice) AS is_back_pressure_enabled FROM orders")
def connection_status(spark, sf_dir):
    df = load(spark, sf_dir, "orders").withColumns({"count_limit": c("o_custkey") % 3 * 100, "size_limit": F.lit(200000)})
    return analytics.connection_status(df, "o_custkey", "o_totalprice", "count_limit", "size_limit").select("o_orderkey", "is_back_pressure_enabled")


@register("agg_13_processor_status", "SELECT s_nationkey AS group_id, s_suppkey AS id, s_acctbal AS metric FROM supplier")
def processor_status(spark, sf_dir):
    groups = load(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.struct(c("s_suppkey").alias("id"), c("s_acctbal").alias("metric"))).alias("p"))
    return analytics.processor_status(groups, "s_nationkey", "p")


@register("agg_14_group_status", "WITH RECURSIVE g AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN c_custkey // 4 END AS parent, c_custkey AS flow FROM customer), t(top, member) AS (SELECT id, id FROM g UNION ALL SELECT t.top, g.id FROM t JOIN g ON g.parent = t.member) SELECT g.id, g.parent, s.total AS total_flow FROM g JOIN (SELECT top, sum(flow)::BIGINT AS total FROM t JOIN g ON g.id = member GROUP BY top) s ON s.top = g.id")
def group_status(spark, sf_dir):
    groups = load(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), F.expr("if(c_custkey > 0, c_custkey div 4, NULL)").alias("parent"), c("c_custkey").alias("flow"))
    return analytics.group_status(groups, "id", "parent", ["flow"]).select("id", "parent", "total_flow")


@register("agg_14_group_chain", "WITH g AS (SELECT o_orderkey AS id, (o_orderkey % 97)::BIGINT AS flow FROM orders), h AS (SELECT id, row_number() OVER (ORDER BY id) AS i, flow FROM g) SELECT id, sum(flow) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS total_flow FROM h")
def group_chain(spark, sf_dir):
    """Each order is the parent of the next: as deep as the table is long."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", (c("o_orderkey") % 97).alias("flow"))
    at = records.numbered(orders, ["o_orderkey"], "i")
    groups = at.join(at.select((c("i") + 1).alias("i"), c("o_orderkey").alias("parent")), "i", "left")
    return analytics.group_status(groups, "o_orderkey", "parent", ["flow"]).select(c("o_orderkey").alias("id"), "total_flow")


@register("agg_15_bulletins", "SELECT event_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def bulletins(spark, sf_dir):
    log = load(spark, sf_dir, "events").withColumn("level", F.when(c("event_type") == "error", "ERROR").otherwise("INFO"))
    return analytics.bulletins(log, ["ERROR"], "2024-01-10", "2024-01-20").select("event_id")


@register("agg_17_metrics_rules", "SELECT user_id, 'busy' AS rule, 'alert' AS action FROM events GROUP BY user_id HAVING count(*) > 60")
def metrics_rules(spark, sf_dir):
    metrics = load(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return analytics.metrics_to_actions(metrics, [("busy", 1, c("n") > 60, "alert")], {"alert": lambda rows: None}).select("user_id", "rule", "action")


@register("agg_18_provenance_filter", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND regexp_full_match('user' || user_id, 'user1.*') AND user_id <> 11")
def provenance(spark, sf_dir):
    df = load(spark, sf_dir, "events").withColumn("component_name", F.concat(F.lit("user"), c("user_id")))
    return analytics.filter_provenance(df, {"event_type": ["click", "view"], "component_name": "user1.*"}, {"user_id": [11]}).select("event_id")


@register("agg_19_lineage", "WITH RECURSIVE e AS (SELECT c_custkey // 3 AS parent, c_custkey AS child FROM customer WHERE c_custkey > 0 AND c_custkey % 7 <> 1), b AS (SELECT parent AS u, child AS v FROM e UNION SELECT child, parent FROM e), r(item) AS (SELECT 5::BIGINT UNION SELECT v FROM r JOIN b ON b.u = r.item) SELECT item FROM r")
def lineage(spark, sf_dir):
    edges = load(spark, sf_dir, "customer").filter("c_custkey > 0 AND c_custkey % 7 <> 1").select(F.expr("c_custkey div 3").alias("parent"), c("c_custkey").alias("child"))
    return analytics.lineage(edges, load(spark, sf_dir, "customer").filter("c_custkey = 5").select("c_custkey")).select("item")


@register("agg_19_lineage_chain", "WITH h AS (SELECT o_orderkey AS item, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) SELECT item, abs(i - 5)::INTEGER AS depth FROM h UNION ALL SELECT -item - 1, (abs(i - 5) + 1)::INTEGER FROM h WHERE i % 3 = 0")
def lineage_chain(spark, sf_dir):
    """A chain of all orders, from its sixth, with an item that hangs off every third."""
    at = records.numbered(load(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "i").select("i", c("o_orderkey").alias("child"))
    chain = at.join(at.select((c("i") + 1).alias("i"), c("child").alias("parent")), "i").select("parent", "child")
    edges = chain.union(at.filter("i % 3 = 0").select("child", -c("child") - 1))
    return analytics.lineage(edges, at.filter("i = 5").select("child"))


@register("agg_20_set_operations", "SELECT 'union' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)")
def set_operations(spark, sf_dir):
    a, b = load(spark, sf_dir, "customer").select(c("c_nationkey").alias("k")), load(spark, sf_dir, "supplier").select(c("s_nationkey").alias("k"))
    parts = [analytics.set_operation(a, b, how, how != "union").agg(F.lit(how).alias("kind"), F.count("*").alias("n")) for how in ("union", "intersect", "except")]
    return parts[0].union(parts[1]).union(parts[2])


# --- batch forms of stateful operators -------------------------------------


@register("str_01_detect_duplicate", "SELECT event_id, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) <= 86400000000, false) AS is_duplicate FROM events")
def detect_duplicate(spark, sf_dir):
    return analytics.detect_duplicates(load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", 86400, "event_id").select("event_id", "is_duplicate")


@register("str_02_rolling_window", "SELECT event_id, count(value) OVER w AS rolling_count, round(sum(value) OVER w, 4) AS rolling_sum, round(avg(value) OVER w, 7) AS rolling_mean FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)")
def rolling_window(spark, sf_dir):
    out = analytics.rolling_window(load(spark, sf_dir, "events"), "user_id", "ts", "value", 86400)
    return out.select("event_id", "rolling_count", F.round("rolling_sum", 4).alias("rolling_sum"), F.round("rolling_mean", 7).alias("rolling_mean"))


@register("str_03_batches_by_key", "SELECT conv_id, (n // 4)::BIGINT AS batch, md5(string_agg(text, chr(10) ORDER BY n)) AS content FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS n FROM conversations) GROUP BY ALL")
def batches(spark, sf_dir):
    return analytics.batches_by_key(load(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"], "text", 4).select("conv_id", "batch", F.md5("content").alias("content"))


@register("str_04_enforce_order", "WITH t AS (SELECT conv_id, turn FROM conversations WHERE NOT (conv_id % 3 = 0 AND turn = 2)), r AS (SELECT conv_id, turn, dense_rank() OVER w - 1 AS k, lag(turn) OVER w AS p FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, CASE WHEN p = turn THEN 'skipped' WHEN turn = k THEN 'released' ELSE 'waiting' END AS outcome FROM r")
def enforce_order(spark, sf_dir):
    df = load(spark, sf_dir, "conversations").filter("NOT (conv_id % 3 = 0 AND turn = 2)").select("conv_id", "turn")
    return analytics.enforce_order(df, "conv_id", "turn")


@register("str_04_enforce_order_from", "WITH t AS (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 1 AND turn = 3 THEN NULL ELSE turn END AS seq FROM conversations), r AS (SELECT conv_id, turn, seq, dense_rank() OVER w - 1 AS k, lag(seq) OVER w AS p FROM t WHERE seq >= 1 WINDOW w AS (PARTITION BY conv_id ORDER BY seq)) SELECT conv_id, turn, CASE WHEN p = seq THEN 'skipped' WHEN seq - 1 = k THEN 'released' ELSE 'waiting' END AS outcome FROM r UNION ALL SELECT conv_id, turn, CASE WHEN seq IS NULL THEN 'invalid' ELSE 'skipped' END FROM t WHERE seq IS NULL OR seq < 1")
def enforce_order_from(spark, sf_dir):
    """From turn 1 on: turn 0 has passed, and some rows have no sequence."""
    df = load(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr("if(conv_id % 5 = 1 AND turn = 3, NULL, turn)").alias("seq"))
    return analytics.enforce_order(df, "conv_id", "seq", 1).select("conv_id", "turn", "outcome")


@register("str_05_wait_notify", "SELECT c_custkey, coalesce(n >= 10, false) AS released FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def wait_notify(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select(c("c_custkey").alias("signal"), "c_custkey")
    return analytics.wait_for_signal(rows, load(spark, sf_dir, "orders").select(c("o_custkey").alias("signal")), "signal", 10).select("c_custkey", "released")


@register("str_06_monitor_activity", "SELECT user_id, inactive_from, restored_at FROM (SELECT user_id, ts AS inactive_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS restored_at FROM events) WHERE epoch_us(restored_at) - epoch_us(inactive_from) > 86400000000")
def monitor_activity(spark, sf_dir):
    return analytics.monitor_activity(load(spark, sf_dir, "events"), "user_id", "ts", 86400).drop("gap_seconds")


@register("str_08_session_window", "WITH g AS (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) >= 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)) SELECT user_id, count(*) AS n, min(ts) AS first, max(ts) AS last FROM g GROUP BY user_id, s")
def session_window(spark, sf_dir):
    return analytics.session_bins(load(spark, sf_dir, "events"), "user_id", "ts", "6 hours")


_OP = "CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END"


@register("str_09_apply_cdc", f"SELECT user_id, value FROM (SELECT user_id, value, {_OP} AS op, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 AND op <> 'delete'")
def apply_cdc(spark, sf_dir):
    return analytics.apply_cdc(load(spark, sf_dir, "events").withColumn("op", F.expr(_OP)), ["user_id"], "event_id", "op", ["value"])


@register("str_09_merge_cdc", f"WITH l AS (SELECT user_id, value, {_OP} AS op, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE user_id < 100) SELECT c_custkey AS user_id, c_acctbal AS value FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM l) UNION ALL SELECT user_id, value FROM l WHERE n = 1 AND op <> 'delete'")
def merge_cdc(spark, sf_dir):
    table = load(spark, sf_dir, "customer").select(c("c_custkey").alias("user_id"), c("c_acctbal").alias("value"))
    events = load(spark, sf_dir, "events").filter("user_id < 100").withColumn("op", F.expr(_OP))
    return analytics.merge_cdc(table, events, ["user_id"], "event_id", "op", ["value"])


_KIND = "CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update' WHEN 'view' THEN 'ddl' ELSE 'begin' END"


@register("str_09_merge_other_events", f"WITH e AS (SELECT user_id, event_id, value, {_KIND} AS op FROM events), l AS (SELECT user_id, value, op, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM e WHERE op IN ('insert', 'update', 'delete')) SELECT c_custkey AS user_id, c_acctbal AS value FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM l) UNION ALL SELECT user_id, value FROM l WHERE n = 1 AND op <> 'delete'")
def merge_other_events(spark, sf_dir):
    """Events that change no row, some of them the only or the last ones of their key."""
    table = load(spark, sf_dir, "customer").select(c("c_custkey").alias("user_id"), c("c_acctbal").alias("value"))
    return analytics.merge_cdc(table, load(spark, sf_dir, "events").withColumn("op", F.expr(_KIND)), ["user_id"], "event_id", "op", ["value"])


@register("src_20_cdc_columns", "SELECT event_id, event_type AS type, 'value' AS name, (value - 1)::DOUBLE AS last_value, value FROM events")
def cdc_columns(spark, sf_dir):
    column = F.struct(F.lit(1).alias("id"), F.lit("value").alias("name"), F.lit(8).alias("column_type"), (c("value") - 1).cast("string").alias("last_value"), c("value").cast("string").alias("value"))
    events = load(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(c("event_type").alias("type"), F.lit("db").alias("database"), F.lit("t").alias("table_name"), F.array(column).alias("columns"))).alias("e"))
    return analytics.cdc_columns(events, "e", ["event_id"]).select("event_id", "type", "name", c("last_value").cast("double").alias("last_value"), c("value").cast("double").alias("value"))


@register("str_10_change_tracking", "SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'd' ELSE 'u' END AS event, max(ts) AS changed FROM events GROUP BY user_id")
def change_tracking(spark, sf_dir):
    return analytics.change_tracking(load(spark, sf_dir, "events").withColumn("op", F.expr(_OP)), "user_id", "op", "ts")


@register("str_11_counters", "SELECT event_type AS counter, sum(user_id)::BIGINT AS value FROM events GROUP BY event_type")
def counters(spark, sf_dir):
    return analytics.counters(load(spark, sf_dir, "events"), c("event_type"), c("user_id"))
