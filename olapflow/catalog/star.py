"""Joins, lookups, aggregates, windows, sorts and sets over the star tables."""

from pyspark.sql import functions as F

from olapflow.catalog.base import iso_day, iso_time, money, query, total
from olapflow.operators import agg, join, sets, window

# ---------------------------------------------------------------- joins


@query("e01_lookup_surrogate_key", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, c_custkey + 1000 AS customer_tk
FROM orders JOIN customer ON o_custkey = c_custkey""")
def e01(t):
    from olapflow.functions.dates import date_key

    dim = t.customer.select("c_custkey", (F.col("c_custkey") + 1000).alias("customer_tk"))
    out = join.lookup_key(t.orders, dim, {"o_custkey": "c_custkey"}, "customer_tk")
    return out.select("o_orderkey", date_key("o_orderdate").alias("date_key"), "customer_tk")


@query("e02_null_safe_join", """
WITH a AS (SELECT doc_id, nullif(quality, 0) AS q FROM labels), b AS (SELECT DISTINCT nullif(toxic, 0) AS q FROM labels)
SELECT doc_id, a.q AS q FROM a JOIN b ON a.q IS NOT DISTINCT FROM b.q""")
def e02(t):
    a = t.labels.select("doc_id", F.nullif("quality", F.lit(0)).alias("q"))
    b = t.labels.select(F.nullif("toxic", F.lit(0)).alias("q")).distinct()
    return join.null_safe_join(a, b, ["q"])


@query("e03_left_merge_join", """
SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def e03(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return join.merge_join(t.customer.select("c_custkey", "c_name"), orders, ["c_custkey"], "left")


@query("e04_inner_merge_join", """
SELECT o_orderkey, l_linenumber, l_partkey, o_orderstatus FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def e04(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return join.merge_join(t.orders.select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey"])


@query("e05_stream_lookup_first_match", """
WITH first_order AS (SELECT o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(status, 'none') AS first_status FROM customer LEFT JOIN first_order ON c_custkey = o_custkey""")
def e05(t):
    out = join.stream_lookup(
        t.customer.select("c_custkey"),
        t.orders,
        {"c_custkey": "o_custkey"},
        {"first_status": "o_orderstatus"},
        ["o_orderdate", "o_orderkey"],
        {"first_status": "none"},
    )
    return out


@query("e06_role_playing_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey""")
def e06(t):
    lines = join.star_join(
        t.lineitem,
        [
            (t.orders, {"l_orderkey": "o_orderkey"}),
            (t.customer, {"o_custkey": "c_custkey"}),
            (t.supplier, {"l_suppkey": "s_suppkey"}),
        ],
    )
    out = join.lookup(lines, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "customer_nation"})
    out = join.lookup(out, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "supplier_nation"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "customer_nation", "supplier_nation")


@query("e07_database_join", """
SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 50""")
def e07(t):
    customer, orders = t.customer, t.orders
    residual = orders["o_totalprice"] > customer["c_acctbal"] * 50
    return join.db_join(customer, orders, {"c_custkey": "o_custkey"}, residual).select("c_custkey", "o_orderkey")


@query("e08_conditional_product", """
SELECT r_name, p_partkey FROM region CROSS JOIN part WHERE p_size % 5 >= r_regionkey""")
def e08(t):
    out = join.cross(t.part, t.region, F.col("p_size") % 5 >= F.col("r_regionkey"))
    return out.select("r_name", "p_partkey")


SQL_EVENT_SPANS = """sp AS (SELECT user_id, event_type, ts AS lo,
  lead(ts, 1, TIMESTAMP '2024-01-31') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hi FROM events)"""


@query("e09_range_join", f"""WITH {SQL_EVENT_SPANS},
pr AS (SELECT event_id, user_id, ts + INTERVAL 2 HOUR AS moment FROM events WHERE event_type = 'purchase')
SELECT event_id, sp.event_type AS state_then FROM pr JOIN sp ON pr.user_id = sp.user_id AND moment >= lo AND moment < hi""")
def e09(t):
    from olapflow.plans.snapshot import to_intervals

    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    spans = to_intervals(t.events, "user_id", ["ts", "event_id"], ["event_type"], as_of)
    points = t.events.where("event_type = 'purchase'").select(
        "event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("at")
    )
    spans = spans.select("user_id", "event_type", F.col("valid_from").alias("lo"), F.col("valid_to").alias("hi"))
    out = join.range_join(points, spans, "at", "lo", "hi", 14_400, on=["user_id"])
    return out.select("event_id", F.col("event_type").alias("state_then"))


@query("e09_range_join_long_spans", """
WITH sp AS (SELECT event_id AS span_id, user_id, ts AS lo, CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL 731 DAY
    WHEN event_id % 10 = 0 THEN ts + INTERVAL 90 MINUTE ELSE ts + INTERVAL 1 SECOND END AS hi FROM events)
SELECT event_id, span_id FROM (SELECT event_id, user_id, ts + INTERVAL 500 MILLISECOND AS moment FROM events) e
JOIN sp ON e.user_id = sp.user_id AND moment >= lo AND moment < hi""")
def e09_long(t):
    """Spans of a second, of an hour and a half, and of two years in one table."""
    ts = F.col("ts")
    hi = F.when(F.col("event_id") % 50 == 0, ts + F.expr("INTERVAL 731 DAYS")).when(
        F.col("event_id") % 10 == 0, ts + F.expr("INTERVAL 90 MINUTES")
    ).otherwise(ts + F.expr("INTERVAL 1 SECOND"))
    spans = t.events.select(F.col("event_id").alias("span_id"), "user_id", ts.alias("lo"), hi.alias("hi"))
    points = t.events.select("event_id", "user_id", F.timestamp_add("MICROSECOND", F.lit(500_000), ts).alias("at"))
    return join.range_join_any(points, spans, "at", "lo", "hi", on=["user_id"]).select("event_id", "span_id")


@query("e10_anti_join", "SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def e10(t):
    return join.anti(t.documents.select("doc_id"), t.labels, ["doc_id"])


@query("e11_semi_join", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def e11(t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return join.semi(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query("e12_group_winners", """
SELECT n_name, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE (n_name, c_acctbal) IN (SELECT n_name, max(c_acctbal) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)""")
def e12(t):
    both = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return join.winners(both, ["n_name"], "c_acctbal").select("n_name", "c_custkey", "c_acctbal")


@query("e13_star_join", """
SELECT r_name, n_name, c_mktsegment, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""")
def e13(t):
    star = join.star_join(
        t.orders,
        [
            (t.customer, {"o_custkey": "c_custkey"}),
            (t.nation, {"c_nationkey": "n_nationkey"}),
            (t.region, {"n_regionkey": "r_regionkey"}),
        ],
    )
    return star.groupBy("r_name", "n_name", "c_mktsegment").agg(total("o_totalprice").alias("revenue"), F.count("*").alias("n"))


@query("e15_nested_xml", """
SELECT o_custkey, 0 AS part, '<customer key="' || o_custkey || '">' || string_agg('<order key="' || o_orderkey || '">' || o_orderstatus || '</order>', '' ORDER BY o_orderkey) || '</customer>' AS xml
FROM orders GROUP BY o_custkey""")
def e15(t):
    parents = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    nested = join.nest_children(
        parents, t.orders, "o_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], "items"
    ).where(F.size("items") > 0)
    inner = F.transform(
        "items", lambda x: join.xml_element("order", {"key": x.o_orderkey}, join.xml_escape(x.o_orderstatus))
    )
    # a customer's parts, put together in order, are one document
    opening = F.when(F.col("part") == 0, join.xml_open("customer", {"key": F.col("o_custkey")})).otherwise("")
    closing = F.when(F.col("is_last"), F.lit("</customer>")).otherwise("")
    xml = F.concat(opening, F.array_join(inner, ""), closing)
    return nested.select("o_custkey", F.col("part").cast("int").alias("part"), xml.alias("xml"))


@query("e16_detect_empty", """
SELECT CAST(-1 AS BIGINT) AS o_orderkey, 'none' AS o_orderstatus WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice < 0""")
def e16(t):
    none = t.orders.where("o_totalprice < 0").select("o_orderkey", "o_orderstatus")
    return join.detect_empty(none, {"o_orderkey": F.lit(-1), "o_orderstatus": F.lit("none")})


# ---------------------------------------------------------------- aggregates


@query("f01_group_by", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_price, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def f01(t):
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(total("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_price"), F.count("*").alias("n"))
    )


@query("f02_group_step", """
SELECT n_regionkey, count(*) AS n, count(q) AS filled, sum(q) AS qsum, arg_min(n_name, n_nationkey) AS first_name
FROM (SELECT n_regionkey, n_nationkey, n_name, nullif(CAST(n_nationkey AS BIGINT), 7) AS q FROM nation) GROUP BY 1""".replace("sum(q)", "CAST(sum(q) AS BIGINT)"))
def f02(t):
    df = t.nation.withColumn("q", F.nullif(F.col("n_nationkey").cast("bigint"), F.lit(7).cast("bigint")))
    aggs = {
        "n": ("COUNT_ANY", "*"),
        "filled": ("COUNT_ALL", "q"),
        "qsum": ("SUM", "q"),
        "first_name": ("FIRST", "n_name"),
    }
    return agg.group_by(df, ["n_regionkey"], aggs, order=["n_nationkey"])


@query("f02_concat_string", """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY l_orderkey""")
def f02_concat(t):
    parts = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    return agg.concat_string(parts, ["l_orderkey"], "l_partkey", ",", ["l_partkey"], F.expr("l_partkey div 100000"), "parts")


@query("f02_whole_stream", """
SELECT count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance, arg_min(c_name, c_custkey) AS first_name FROM customer""")
def f02_whole(t):
    df = t.customer.withColumn("bal", money("c_acctbal"))
    aggs = {"n": ("COUNT_ANY", "*"), "balance": ("SUM", "bal"), "first_name": ("FIRST", "c_name")}
    return agg.group_by(df, [], aggs, order=["c_custkey"]).withColumn("balance", F.col("balance").cast("double"))


@query("f03_count_distinct_semi", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) GROUP BY 1""")
def f03(t):
    large = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return agg.count_distinct(join.semi(t.orders, large, ["o_orderkey"]), ["o_orderpriority"], "o_custkey", "customers")


@query("f03_count_distinct_approx", "SELECT DISTINCT o_orderpriority, 1 AS close FROM orders")
def f03_approx(t):
    """The sketch lies within three standard errors of the exact count."""
    keys = ["o_orderpriority"]
    sketch = agg.count_distinct(t.orders, keys, "o_custkey", "about", approx=True)
    exact = agg.count_distinct(t.orders, keys, "o_custkey", "exactly")
    close = F.abs(F.col("about") - F.col("exactly")) <= 0.15 * F.col("exactly")
    return sketch.join(exact, keys).select(*keys, close.cast("int").alias("close"))


@query("f04_time_bucket", """
SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket, event_type, count(*) AS n,
       max(value) AS max_value, max(user_id) AS max_user FROM events GROUP BY 1, 2""")
def f04(t):
    aggs = [F.count("*").alias("n"), F.max("value").alias("max_value"), F.max("user_id").alias("max_user")]
    out = agg.time_bucket(t.events, "ts", "15 minutes", ["event_type"], aggs)
    return out.withColumn("bucket", iso_time("bucket"))


@query("f05_with_global", """
SELECT o_orderkey, strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m-%d') AS max_day,
       (SELECT max(o_orderkey) FROM orders) + 1 AS next_key FROM orders""")
def f05(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    out = agg.with_global(df, {"max_day": iso_day(F.max("o_orderdate")), "next_key": F.max("o_orderkey") + 1})
    return out.drop("o_orderdate")


@query("f06_unique_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def f06(t):
    return agg.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey"))


@query("f06_unique_by_key", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""")
def f06_key(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return agg.distinct_rows(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


AGG_KEYS = ["n_name", "c_mktsegment"]
SQL_AGG = """agg AS (SELECT n_name, c_mktsegment, sum(CAST(b AS DECIMAL(12,2))) AS bal_sum, count(b) AS bal_count, count(*) AS row_count
FROM (SELECT n_name, c_mktsegment, CASE WHEN c_acctbal > 1000 THEN c_acctbal END AS b FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2)"""


def _aggregate(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.build_aggregate(df, AGG_KEYS, {"bal": F.when(F.col("c_acctbal") > 1000, money("c_acctbal"))})


@query("f07_aggregate_table", f"""WITH {SQL_AGG}
SELECT n_name, c_mktsegment, CAST(bal_sum AS DOUBLE) AS bal_sum, CAST(bal_sum AS DOUBLE) / bal_count AS bal_avg, bal_count, row_count FROM agg""")
def f07(t):
    return _aggregate(t).withColumn("bal_sum", F.col("bal_sum").cast("double"))


@query("f08_rollup_average_from_sum", f"""WITH {SQL_AGG}
SELECT n_name, CAST(sum(bal_sum) AS DOUBLE) / sum(bal_count) AS bal FROM agg GROUP BY 1""")
def f08(t):
    return agg.rollup_avg(_aggregate(t), ["n_name"], "bal", "AvgFromSum")


@query("f08_rollup_average_from_avg", f"""WITH {SQL_AGG}
SELECT c_mktsegment, round(sum(CAST(bal_sum AS DOUBLE) / bal_count * bal_count) / sum(bal_count), 4) AS bal FROM agg GROUP BY 1""")
def f08_avg(t):
    out = agg.rollup_avg(_aggregate(t), ["c_mktsegment"], "bal", "AvgFromAvg")
    return out.withColumn("bal", F.round(F.col("bal").cast("double"), 4))


@query("f08_rollup_sum_from_avg", f"""WITH {SQL_AGG}
SELECT c_mktsegment, round(sum(CAST(bal_sum AS DOUBLE) / bal_count * bal_count), 2) AS bal FROM agg GROUP BY 1""")
def f08_sum(t):
    out = agg.rollup_avg(_aggregate(t), ["c_mktsegment"], "bal", "SumFromAvg")
    return out.withColumn("bal", F.round(F.col("bal").cast("double"), 2))


@query("f09_summarize_all", """
SELECT p_brand, count(*) AS count, sum(p_size) AS total_p_size, avg(p_size) AS avg_p_size,
       CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS total_p_retailprice,
       CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_p_retailprice
FROM part GROUP BY 1""".replace("sum(p_size)", "CAST(sum(p_size) AS BIGINT)"))
def f09(t):
    df = t.part.withColumn("p_retailprice", money("p_retailprice"))
    out = agg.summarize_all(df, ["p_brand"], skip=["p_partkey"])
    return out.withColumn("total_p_retailprice", F.col("total_p_retailprice").cast("double"))


SALES = {"revenue": ("sum", "price"), "orders": ("count", "*"), "average": ("avg", "price")}


def _sales(t):
    return t.orders.select(
        F.year("o_orderdate").alias("y"),
        F.quarter("o_orderdate").alias("q"),
        F.month("o_orderdate").alias("m"),
        "o_orderstatus",
        "o_orderpriority",
        money("o_totalprice").alias("price"),
    )


def _as_double(df):
    return df.withColumn("revenue", F.col("revenue").cast("double"))


@query("f10_rollup_levels", """
WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(o_totalprice AS DECIMAL(12,2)) AS p FROM orders)
SELECT y, q, m, CAST(3 - grouping(y) - grouping(q) - grouping(m) AS INTEGER) AS level_no,
       CASE 3 - grouping(y) - grouping(q) - grouping(m) WHEN 0 THEN 'all' WHEN 1 THEN 'y' WHEN 2 THEN 'q' ELSE 'm' END AS level_name,
       CAST(sum(p) AS DOUBLE) AS revenue, count(*) AS orders, CAST(sum(p) AS DOUBLE) / count(*) AS average
FROM s GROUP BY ROLLUP (y, q, m)""")
def f10(t):
    return _as_double(agg.rollup_levels(_sales(t), ["y", "q", "m"], SALES))


@query("f11_cube_levels", """
WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS p FROM orders)
SELECT y, o_orderstatus, CAST(grouping(y) AS INTEGER) AS a_all, CAST(grouping(o_orderstatus) AS INTEGER) AS b_all,
       CAST(sum(p) AS DOUBLE) AS revenue, count(*) AS orders, CAST(sum(p) AS DOUBLE) / count(*) AS average
FROM s GROUP BY CUBE (y, o_orderstatus)""")
def f11(t):
    return _as_double(agg.cube_levels(_sales(t), ["y"], ["o_orderstatus"], SALES))


TYPES = ["view", "click", "signup", "purchase", "error"]


@query("f12_denormalise", "SELECT user_id, " + ", ".join(
    f"max(value) FILTER (event_type = '{k}') AS {k}" for k in TYPES) + " FROM events GROUP BY user_id")
def f12(t):
    return agg.denormalise(t.events, ["user_id"], "event_type", "value", TYPES)


@query("f13_crosstab", "SELECT o_orderpriority, " + ", ".join(
    f"nullif(count(*) FILTER (o_orderstatus = '{s}'), 0) AS {s}" for s in "FOP") + " FROM orders GROUP BY 1")
def f13(t):
    return agg.to_crosstab(t.orders, "o_orderpriority", "o_orderstatus", F.count(F.lit(1)), ["F", "O", "P"])


@query("f13_crosstab_swapped", "SELECT o_orderstatus, " + ", ".join(
    f"nullif(count(*) FILTER (o_orderpriority = '{p}'), 0) AS \"{p}\"" for p in ["1-URGENT", "2-HIGH"]) + " FROM orders GROUP BY 1")
def f13_swapped(t):
    return agg.to_crosstab(
        t.orders, "o_orderpriority", "o_orderstatus", F.count(F.lit(1)), ["1-URGENT", "2-HIGH"], series_in_rows=True
    )


@query("f13_relational", "SELECT o_orderpriority, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def f13_relational(t):
    wide = agg.to_crosstab(t.orders, "o_orderpriority", "o_orderstatus", F.count(F.lit(1)), ["F", "O", "P"])
    return agg.to_relational(wide, ["o_orderpriority"], "status", "n")


@query("f14_flow_links", """
SELECT event_type AS source, target, count(*) AS value FROM (
  SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM events)
WHERE target IS NOT NULL GROUP BY 1, 2""")
def f14(t):
    return agg.flow_links(t.events, "user_id", ["ts", "event_id"], "event_type")


@query("f14_flow_nodes", """
SELECT DISTINCT unnest([event_type, target]) AS node FROM (
  SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM events)
WHERE target IS NOT NULL""")
def f14_nodes(t):
    return agg.flow_nodes(agg.flow_links(t.events, "user_id", ["ts", "event_id"], "event_type"))


@query("f15_quantize", """
WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT c_custkey, CAST(least(floor((c_acctbal - lo) * 7 / (hi - lo)) + 1, 7) AS INTEGER) AS class FROM customer, b""")
def f15(t):
    return agg.quantize(t.customer, "c_acctbal", 7).select("c_custkey", "class")


@query("f16_partitioned_group_by", """
SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""")
def f16(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


# ---------------------------------------------------------------- windows

EV = ["ts", "event_id"]


@query("w01_next_event", """
SELECT event_id, strftime(lead(ts, 1, TIMESTAMP '2024-01-31') OVER (PARTITION BY user_id ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS next_event FROM events""")
def w01(t):
    out = window.next_event(t.events, "user_id", EV, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    return out.select("event_id", iso_time("next_event").alias("next_event"))


@query("w02_row_number_per_key_day", """
SELECT event_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS no FROM events""")
def w02(t):
    df = t.events.withColumn("day", F.to_date("ts"))
    return window.row_index(df, ["user_id", "day"], EV, "no").select("event_id", "no")


@query("w03_running_sum", """
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS running FROM events""")
def w03(t):
    out = window.running_sum(t.events, ["user_id"], EV, money("value"))
    return out.select("event_id", F.col("running").cast("double").alias("running"))


@query("w04_running_working_days", """
SELECT event_id, CAST(sum(CASE WHEN isodow(ts) < 6 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS working_days FROM events""")
def w04(t):
    flag = (F.weekday("ts") < 5).cast("bigint")
    return window.running_sum(t.events, ["user_id", "event_type"], EV, flag, "working_days").select("event_id", "working_days")


@query("w07_latest_per_key", """
SELECT user_id, max(event_id) FILTER (rn = 1) AS event_id, max(event_type) FILTER (rn = 1) AS event_type
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) GROUP BY 1""")
def w07(t):
    return window.latest_per_key(t.events, ["user_id"], EV).select("user_id", "event_id", "event_type")


@query("w08_previous_status", """
SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_status FROM events""")
def w08(t):
    return window.previous_status(t.events, ["user_id"], EV, "event_type").select("event_id", "prev_status")


@query("w09_valid_to", """
SELECT event_id, strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS valid_to FROM events""")
def w09(t):
    from olapflow.plans.snapshot import to_intervals

    out = to_intervals(t.events, "user_id", EV, ["event_id"])
    return out.select("event_id", iso_time("valid_to").alias("valid_to"))


# ---------------------------------------------------------------- sorts and top-n


@query("h01_multi_key_sort", """
SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS s FROM orders ORDER BY s ASC NULLS LAST, o_orderpriority DESC, o_orderkey""")
def h01(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return agg.sort_by(df, [("s", True, True), ("o_orderpriority", False, True), ("o_orderkey", True, True)])


@query("h02_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def h02(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    return agg.sort_by(df, [("o_totalprice", False, True), ("o_orderkey", True, True)]).limit(25)


@query("h03_top_count", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS measure FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def h03(t):
    return agg.top_count(t.orders, "o_custkey", total("o_totalprice"), 10)


@query("h04_top_count_total", """
SELECT CAST(sum(m) AS DOUBLE) AS total FROM (SELECT sum(CAST(o_totalprice AS DECIMAL(12,2))) AS m FROM orders GROUP BY o_orderdate ORDER BY m DESC, o_orderdate LIMIT 3)""")
def h04(t):
    out = agg.top_count_total(t.orders, "o_orderdate", F.sum(money("o_totalprice")), 3)
    return out.select(F.col("total").cast("double").alias("total"))


@query("h04_top_count_total_per_member", """
SELECT o_orderpriority, CAST(sum(m) AS DOUBLE) AS total FROM (
  SELECT o_orderpriority, m, row_number() OVER (PARTITION BY o_orderpriority ORDER BY m DESC, o_orderdate) AS rn FROM (
    SELECT o_orderpriority, o_orderdate, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS m FROM orders GROUP BY 1, 2)) WHERE rn <= 3 GROUP BY 1""")
def h04_per(t):
    out = agg.top_count_total(t.orders, "o_orderdate", F.sum(money("o_totalprice")), 3, per=["o_orderpriority"])
    return out.withColumn("total", F.col("total").cast("double"))


@query("h05_top_per_group", """
SELECT c_nationkey, c_custkey, c_acctbal, CAST(rn AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 3""")
def h05(t):
    out = agg.top_per_group(t.customer, ["c_nationkey"], "c_acctbal", 3, ["c_custkey"], "place")
    return out.select("c_nationkey", "c_custkey", "c_acctbal", "place")


@query("h06_hierarchical_order", """
SELECT r_name, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)
ORDER BY r_name NULLS FIRST, n_name NULLS FIRST""")
def h06(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    df = df.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    members = agg.rollup_levels(df, ["r_name", "n_name"], {"customers": ("count", "*")})
    return agg.hierarchize(members, ["r_name", "n_name"]).select("r_name", "n_name", "customers")


# ---------------------------------------------------------------- sets


@query("s01_union_all", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def s01(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return sets.union_all(a, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("s02_except_members", """
SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def s02(t):
    a = t.customer.select("c_nationkey").distinct()
    b = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return sets.except_members(a, b, ["c_nationkey"])


@query("s03_intersect_members", """
SELECT l_partkey AS part FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 45""")
def s03(t):
    a = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("part"))
    return sets.intersect_members(a, t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("part")))


@query("s03_generate_distinct", """
SELECT DISTINCT n_regionkey, c_mktsegment FROM nation JOIN customer ON n_nationkey = c_nationkey""")
def s03_generate(t):
    members = t.nation.select("n_nationkey", "n_regionkey")
    segments = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return sets.generate(members, lambda m: m.join(segments, "n_nationkey").select("n_regionkey", "c_mktsegment"))


@query("s04_generate_all", """
SELECT n_regionkey, c_mktsegment FROM nation JOIN customer ON n_nationkey = c_nationkey""")
def s04(t):
    members = t.nation.select("n_nationkey", "n_regionkey")
    segments = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return sets.generate(
        members, lambda m: m.join(segments, "n_nationkey").select("n_regionkey", "c_mktsegment"), keep_all=True
    )


@query("s05_generate_text", """
SELECT r_name, string_agg(DISTINCT n_name, '-' ORDER BY n_name) AS members FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def s05(t):
    return sets.generate_text(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), ["r_name"], "n_name")


@query("s06_member_range", """
SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key FROM orders
WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN 199611 AND 199802""")
def s06(t):
    months = t.orders.select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month_key")).distinct()
    return sets.member_range(months, "month_key", 199611, 199802)


SQL_CELLS = """weeks AS (SELECT DISTINCT strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week FROM orders),
cells AS (SELECT c_nationkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _week():
    return iso_day(F.date_trunc("week", "o_orderdate")).alias("week")


def _cells(t):
    sales = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return sales.groupBy("c_nationkey", _week()).agg(F.count("*").alias("n"))


def _axes(t):
    return t.nation.select(F.col("n_nationkey").alias("c_nationkey")), t.orders.select(_week()).distinct()


@query("s07_cross_members", f"""WITH {SQL_CELLS}
SELECT a.n_nationkey AS c_nationkey, b.week AS week, n
FROM nation a CROSS JOIN weeks b LEFT JOIN cells c ON c.c_nationkey = a.n_nationkey AND c.week = b.week""")
def s07(t):
    a, b = _axes(t)
    return sets.cross_members(a, b, _cells(t), ["c_nationkey", "week"])


@query("s07_cross_members_non_empty", f"""WITH {SQL_CELLS}
SELECT n_nationkey AS c_nationkey, b.week AS week, n
FROM nation CROSS JOIN weeks b LEFT JOIN cells c ON c.c_nationkey = n_nationkey AND c.week = b.week WHERE n IS NOT NULL""")
def s07_non_empty(t):
    a, b = _axes(t)
    return sets.cross_members(a, b, _cells(t), non_empty=True)
