"""Bridges, hierarchies and cube measures."""

from pyspark.sql import functions as F

from olapflow.catalog.base import money, query, total
from olapflow.operators import agg
from olapflow.plans import bridge, cube, hierarchy

# ---------------------------------------------------------------- bridges

SQL_BRIDGE = """bridge AS (SELECT l_orderkey, l_partkey, CAST(1.0 / count(*) OVER (PARTITION BY l_orderkey) AS DECIMAL(18,9)) AS weight
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)),
fact AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders)"""


def _bridge(t):
    out = bridge.weighted_bridge(t.lineitem, "l_orderkey", "l_partkey")
    # ten digits are all a weight needs; a wider type would make Spark cut product digits
    return out.withColumn("weight", F.col("weight").cast("decimal(10,9)"))


def _fact(t):
    return t.orders.select(F.col("o_orderkey").alias("l_orderkey"), money("o_totalprice").alias("price"))


def _four_digits(column):
    return F.col(column).cast("decimal(28,4)").cast("double")


@query("c01_weighted_allocation", f"""WITH {SQL_BRIDGE}
SELECT l_partkey, CAST(CAST(sum(price * weight) AS DECIMAL(28,4)) AS DOUBLE) AS price
FROM fact JOIN bridge ON o_orderkey = l_orderkey GROUP BY 1""")
def c01(t):
    out = bridge.allocate_totals(_fact(t), _bridge(t), "l_orderkey", "l_partkey", ["price"])
    return out.withColumn("price", _four_digits("price"))


@query("c01_allocated_rows", f"""WITH {SQL_BRIDGE}
SELECT l_orderkey, l_partkey, CAST(CAST(price * weight AS DECIMAL(28,4)) AS DOUBLE) AS price FROM fact JOIN bridge ON o_orderkey = l_orderkey""")
def c01_rows(t):
    out = bridge.allocate(_fact(t), _bridge(t), "l_orderkey", ["price"])
    return out.select("l_orderkey", "l_partkey", _four_digits("price").alias("price"))


@query("c01_totals_preserved", """
SELECT o_orderkey AS l_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def c01_preserved(t):
    """Shares to the cent add up to each order's price again."""
    shares = bridge.allocate_exact(_fact(t), t.lineitem, "l_orderkey", "l_partkey", ["price"])
    return shares.groupBy("l_orderkey").agg(F.sum("price").cast("double").alias("price"))


@query("c01_exact_allocation", """
WITH b AS (SELECT l_orderkey, l_partkey, count(*) OVER g AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS place
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) WINDOW g AS (PARTITION BY l_orderkey)),
f AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents FROM orders)
SELECT l_partkey, CAST(CAST(sum(cents // n + CASE WHEN place <= cents % n THEN 1 ELSE 0 END) AS DECIMAL(28,2)) / 100 AS DOUBLE) AS price
FROM f JOIN b ON o_orderkey = l_orderkey GROUP BY 1""")
def c01_exact(t):
    shares = bridge.allocate_exact(_fact(t), t.lineitem, "l_orderkey", "l_partkey", ["price"])
    return shares.groupBy("l_partkey").agg(F.sum("price").cast("double").alias("price"))


@query("c02_impact_report", f"""WITH {SQL_BRIDGE}
SELECT l_partkey, CAST(sum(price) AS DOUBLE) AS price FROM fact JOIN bridge ON o_orderkey = l_orderkey GROUP BY 1""")
def c02(t):
    out = bridge.impact(_fact(t), _bridge(t), "l_orderkey", "l_partkey", ["price"])
    return out.withColumn("price", F.col("price").cast("double"))


@query("c07_match_groups", """
WITH s AS (SELECT l_orderkey, list(DISTINCT l_suppkey ORDER BY l_suppkey) AS items FROM lineitem GROUP BY 1)
SELECT l_orderkey, min(l_orderkey) OVER (PARTITION BY items) AS matched_group FROM s""")
def c07(t):
    pairs = t.lineitem.select("l_orderkey", "l_suppkey")
    have = pairs.withColumnRenamed("l_orderkey", "group_key")
    return bridge.match_groups(have, "group_key", "l_suppkey", pairs, "l_orderkey")


@query("c07_match_supersets_do_not_count", """
WITH s AS (SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS items FROM events GROUP BY 1),
b AS (SELECT user_id * 31 + day(ts) AS g, list(DISTINCT event_type ORDER BY event_type) AS items FROM events GROUP BY 1)
SELECT user_id, min(g) AS matched_group FROM s LEFT JOIN b ON s.items = b.items GROUP BY user_id""")
def c07_sets(t):
    have = t.events.select((F.col("user_id") * 31 + F.dayofmonth("ts")).alias("g"), "event_type")
    want = t.events.select("user_id", "event_type")
    return bridge.match_groups(have, "g", "event_type", want, "user_id")


SQL_MAINTAIN = """recs AS (SELECT user_id * 100 + day(ts) AS rec, day(ts) <= 10 AS early,
  list(DISTINCT event_type ORDER BY event_type) AS items FROM events GROUP BY 1, 2),
old AS (SELECT items, row_number() OVER (ORDER BY min(rec)) AS g FROM recs WHERE early GROUP BY items),
new AS (SELECT items, row_number() OVER (ORDER BY min(rec)) + (SELECT max(g) FROM old) AS g
        FROM recs WHERE NOT early AND items NOT IN (SELECT items FROM old) GROUP BY items)"""


def _maintained(t):
    recs = t.events.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("rec"), F.dayofmonth("ts").alias("dom"), "event_type"
    )
    names = {"record": "rec", "name": "event_type", "order": ["event_type"], "name_chunk": F.substring("event_type", 1, 1)}
    no_dim = recs.limit(0).select(F.lit(None).cast("bigint").alias("item_tk"), "event_type")
    no_bridge = recs.limit(0).select(
        F.lit(None).cast("bigint").alias("group_tk"), F.lit(None).cast("bigint").alias("item_tk"),
        F.lit(None).cast("double").alias("weight"),
    )
    dim, first, _ = bridge.maintain_bridge(no_bridge, no_dim, recs.where("dom <= 10"), **names)
    return bridge.maintain_bridge(first, dim, recs.where("dom > 10"), **names), first


@query("c08_bridge_maintenance_groups", f"""WITH {SQL_MAINTAIN}
SELECT rec, g AS group_tk FROM recs JOIN (SELECT * FROM old UNION ALL SELECT * FROM new) b ON recs.items = b.items WHERE NOT early""")
def c08_groups(t):
    (_, _, groups), _ = _maintained(t)
    return groups


@query("c08_bridge_maintenance_rows", f"""WITH {SQL_MAINTAIN},
names AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS item_tk FROM (SELECT DISTINCT event_type FROM events))
SELECT g AS group_tk, item_tk, 1.0::DOUBLE / len(items) AS weight
FROM (SELECT g, items, unnest(items) AS item FROM (SELECT * FROM old UNION ALL SELECT * FROM new)) JOIN names ON event_type = item""")
def c08_rows(t):
    (_, added, _), first = _maintained(t)
    return first.select("group_tk", "item_tk", "weight").unionByName(added.select("group_tk", "item_tk", "weight"))


@query("c08_null_items", """
WITH recs AS (SELECT user_id * 100 + day(ts) AS rec, list(DISTINCT coalesce(nullif(event_type, 'click'), '-') ORDER BY coalesce(nullif(event_type, 'click'), '-')) AS items
  FROM events GROUP BY 1),
g AS (SELECT items, row_number() OVER (ORDER BY min(rec)) AS group_tk FROM recs GROUP BY items)
SELECT rec, group_tk FROM recs JOIN g USING (items)""")
def c08_null(t):
    recs = t.events.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("rec"), F.nullif("event_type", F.lit("click")).alias("event_type")
    )
    no_dim = recs.limit(0).select(F.lit(None).cast("bigint").alias("item_tk"), "event_type")
    no_bridge = recs.limit(0).select(
        F.lit(None).cast("bigint").alias("group_tk"), F.lit(None).cast("bigint").alias("item_tk"),
        F.lit(None).cast("double").alias("weight"),
    )
    return bridge.maintain_bridge(no_bridge, no_dim, recs, "rec", "event_type")[2]


@query("c09_drill_across", """
WITH a AS (SELECT o_custkey AS cust, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM orders
           WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) GROUP BY 1),
b AS (SELECT user_id AS cust, count(*) AS clicks FROM events
      WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) GROUP BY 1)
SELECT coalesce(a.cust, b.cust) AS cust, orders, revenue, clicks FROM a FULL JOIN b ON a.cust = b.cust""")
def c09(t):
    chosen = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("cust"))
    sales = t.orders.withColumnRenamed("o_custkey", "cust").join(chosen, "cust", "left_semi")
    visits = t.events.withColumnRenamed("user_id", "cust").join(chosen, "cust", "left_semi")
    return bridge.drill_across(
        [
            (sales, {"orders": F.count("*"), "revenue": total("o_totalprice")}),
            (visits, {"clicks": F.count("*")}),
        ],
        ["cust"],
    )


@query("c10_exploded_attribute", """
SELECT o_orderkey, user_id AS cust, event_type FROM orders JOIN (SELECT DISTINCT user_id, event_type FROM events) ON o_custkey = user_id""")
def c10(t):
    interests = t.events.select(F.col("user_id").alias("cust"), "event_type").distinct()
    sales = t.orders.select("o_orderkey", F.col("o_custkey").alias("cust"))
    return bridge.explode_attribute(sales, interests, "cust")


@query("c11_valid_measure", """
WITH s AS (SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1)
SELECT user_id AS cust, event_type, n, orders, revenue
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) LEFT JOIN s ON user_id = o_custkey""")
def c11(t):
    target = t.events.groupBy(F.col("user_id").alias("cust"), "event_type").agg(F.count("*").alias("n"))
    sales = t.orders.withColumnRenamed("o_custkey", "cust")
    return bridge.valid_measure(target, sales, ["cust"], {"orders": F.count("*"), "revenue": total("o_totalprice")})


# ---------------------------------------------------------------- trees

SQL_TREE = """tree AS (
  SELECT p_partkey AS ancestor, p_partkey AS descendant, CAST(0 AS INTEGER) AS distance FROM part
  UNION ALL SELECT ancestor // 4, descendant, distance + 1 FROM tree WHERE ancestor > 0),
own AS (SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS v FROM lineitem GROUP BY 1)"""


def _edges(t):
    parent = F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 4"))
    return t.part.select(F.col("p_partkey").alias("child"), parent.alias("parent"))


def _tree(t):
    return hierarchy.closure(_edges(t), "child", "parent")


def _part_sales(t):
    return t.lineitem.select("l_partkey", money("l_extendedprice").alias("v"))


@query("c03_closure_table", f"WITH RECURSIVE {SQL_TREE} SELECT ancestor, descendant, distance FROM tree")
def c03(t):
    return _tree(t)


@query("c03_closure_update", """
WITH RECURSIVE keys AS (
  SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 3 THEN p_partkey // 5 WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey > 0 THEN p_partkey // 4 END AS up FROM part
  UNION ALL SELECT -p_partkey, p_partkey FROM part WHERE p_partkey % 9 = 1
  UNION ALL SELECT -p_partkey - 1000000000, -p_partkey FROM part WHERE p_partkey % 90 = 1),
n AS (SELECT k, up FROM keys UNION ALL SELECT 0, NULL WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = 0)),
tree AS (SELECT k AS ancestor, k AS descendant, CAST(0 AS INTEGER) AS distance FROM n
  UNION ALL SELECT n.up, descendant, distance + 1 FROM tree JOIN n ON n.k = ancestor WHERE n.up IS NOT NULL)
SELECT ancestor, descendant, distance FROM tree""")
def c03_update(t):
    """Subtrees moved and cut off, also below one another, and new nodes in two levels."""
    key = F.col("p_partkey")
    moved = t.part.where("p_partkey % 10 = 3").select(key.alias("child"), F.expr("p_partkey div 5").alias("parent"))
    cut = t.part.where("p_partkey % 50 = 7").select(key.alias("child"), F.lit(None).cast("bigint").alias("parent"))
    new = t.part.where("p_partkey % 9 = 1").select((-key).alias("child"), key.alias("parent"))
    newer = t.part.where("p_partkey % 90 = 1").select((-key - 1_000_000_000).alias("child"), (-key).alias("parent"))
    moves = moved.union(cut).union(new).union(newer)
    return hierarchy.update_closure(_tree(t), moves, "child", "parent")


@query("c04_rollup_tree", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, CAST(sum(v) AS DOUBLE) AS v FROM tree JOIN own ON descendant = l_partkey GROUP BY 1""")
def c04(t):
    out = hierarchy.rollup_edges(_part_sales(t), _edges(t), "child", "parent", "l_partkey", ["v"])
    return out.withColumn("v", F.col("v").cast("double"))


@query("c04_rollup_over_closure", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, CAST(sum(v) AS DOUBLE) AS v FROM tree JOIN own ON descendant = l_partkey GROUP BY 1""")
def c04_closure(t):
    out = hierarchy.rollup_tree(_part_sales(t), _tree(t), "l_partkey", ["v"])
    return out.withColumn("v", F.col("v").cast("double"))


@query("c05_rollup_set", f"""WITH RECURSIVE {SQL_TREE}
SELECT CAST(sum(v) AS DOUBLE) AS v FROM own WHERE l_partkey IN (SELECT descendant FROM tree WHERE ancestor IN (
  SELECT p_partkey FROM part WHERE p_brand = 'Brand#7'))""")
def c05(t):
    chosen = t.part.where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("ancestor"))
    out = hierarchy.rollup_set(_part_sales(t), _tree(t), "l_partkey", chosen, ["v"])
    return out.withColumn("v", F.col("v").cast("double"))


@query("c06_own_and_total", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, CAST(sum(v) FILTER (distance = 0) AS DOUBLE) AS own, CAST(sum(v) AS DOUBLE) AS total
FROM tree JOIN own ON descendant = l_partkey GROUP BY 1""")
def c06(t):
    out = hierarchy.own_and_total(_part_sales(t), _tree(t), "l_partkey", "v")
    return out.withColumns({"own": F.col("own").cast("double"), "total": F.col("total").cast("double")})


@query("c19_descendants_to_depth", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, descendant, distance FROM tree WHERE distance <= 2 AND ancestor IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')""")
def c19(t):
    chosen = t.part.where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("ancestor"))
    return hierarchy.descendants(_tree(t), chosen, 2)


@query("c19_ascendants", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, descendant, distance FROM tree WHERE descendant IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')""")
def c19_up(t):
    chosen = t.part.where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("descendant"))
    return hierarchy.ascendants(_tree(t), chosen)


@query("c19_children", f"""WITH RECURSIVE {SQL_TREE}
SELECT ancestor, descendant, distance FROM tree WHERE distance = 1 AND ancestor IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')""")
def c19_children(t):
    chosen = t.part.where("p_brand = 'Brand#7'").select(F.col("p_partkey").alias("ancestor"))
    return hierarchy.children(_tree(t), chosen)


# ---------------------------------------------------------------- level hierarchies

GEO_LEVELS = ["r_name", "n_name", "c_mktsegment"]


def _customers(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


def _geo_sales(t):
    return t.orders.join(_customers(t), F.col("o_custkey") == F.col("c_custkey")).withColumn("price", money("o_totalprice"))


SQL_GEO = """geo AS (SELECT r_name, n_name, c_mktsegment, c_custkey, c_acctbal, CAST(c_acctbal AS DECIMAL(12,2)) AS bal FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
sales AS (SELECT geo.*, o_orderkey, o_orderdate, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders JOIN geo ON o_custkey = c_custkey)"""

SQL_ROLLED = SQL_GEO + """,
rolled AS (SELECT r_name, n_name, c_mktsegment, CAST(3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment) AS INTEGER) AS level_no,
  count(*) AS customers FROM geo GROUP BY ROLLUP (r_name, n_name, c_mktsegment))"""


def _expanded(t):
    regions = t.region.where("r_name IN ('ASIA', 'EUROPE')").select("r_name", F.lit(None).cast("string").alias("n_name"))
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where("n_name IN ('NATION_2', 'NATION_3', 'NATION_5')")
    both = regions.unionByName(nations.select("r_name", "n_name"))
    return both.withColumn("c_mktsegment", F.lit(None).cast("string"))


@query("c20_drill_down", f"""WITH {SQL_ROLLED}
SELECT r_name, n_name, c_mktsegment, level_no, customers FROM rolled
WHERE level_no <= 1 OR (level_no = 2 AND r_name IN ('ASIA', 'EUROPE'))
   OR (level_no = 3 AND r_name IN ('ASIA', 'EUROPE') AND n_name IN ('NATION_2', 'NATION_3', 'NATION_5'))""")
def c20(t):
    rolled = agg.rollup_levels(_customers(t), GEO_LEVELS, {"customers": ("count", "*")}).drop("level_name")
    return hierarchy.drill(rolled, GEO_LEVELS, _expanded(t))


@query("c21_toggle_drill_state", f"""WITH {SQL_ROLLED}
SELECT r_name, n_name, c_mktsegment, level_no, customers FROM rolled
WHERE level_no <= 1 OR (level_no = 2 AND r_name IN ('ASIA', 'AFRICA'))
   OR (level_no = 3 AND r_name IN ('ASIA', 'AFRICA') AND n_name IN ('NATION_2', 'NATION_3', 'NATION_5'))""")
def c21(t):
    rolled = agg.rollup_levels(_customers(t), GEO_LEVELS, {"customers": ("count", "*")}).drop("level_name")
    none = F.lit(None).cast("string")
    clicked = t.region.where("r_name IN ('EUROPE', 'AFRICA')").select("r_name", none.alias("n_name"), none.alias("c_mktsegment"))
    return hierarchy.drill(rolled, GEO_LEVELS, hierarchy.toggle(_expanded(t), clicked))


@query("c22_null_members", """
WITH geo AS (SELECT DISTINCT CASE WHEN r_name <> 'ASIA' THEN r_name END AS r, CASE WHEN n_nationkey % 4 > 0 THEN n_name END AS n
  FROM nation JOIN region ON n_regionkey = r_regionkey),
rs AS (SELECT r, count(*) AS kids FROM geo GROUP BY r)
SELECT 0 AS level_no, 'All' AS name, '[All]' AS unique_name, CAST(NULL AS VARCHAR) AS parent_unique_name, (SELECT count(*) FROM rs) AS child_count
UNION ALL SELECT 1, coalesce(r, '#null'), '[All].[' || coalesce(r, '#null') || ']', '[All]', kids FROM rs
UNION ALL SELECT 2, coalesce(n, '#null'), '[All].[' || coalesce(r, '#null') || '].[' || coalesce(n, '#null') || ']',
  '[All].[' || coalesce(r, '#null') || ']', 0 FROM geo""")
def c22_null(t):
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    geo = geo.select(
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("r"), F.when(F.col("n_nationkey") % 4 > 0, F.col("n_name")).alias("n")
    )
    return hierarchy.members(geo, ["r", "n"]).drop("ordinal", "level_name")


@query("c22_member_properties", """
WITH geo AS (SELECT r_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT DISTINCT r_name, n_name FROM geo UNION SELECT DISTINCT r_name, NULL FROM geo UNION SELECT NULL, NULL)
SELECT CAST((r_name IS NOT NULL)::INT + (n_name IS NOT NULL)::INT AS INTEGER) AS level_no,
  CASE WHEN r_name IS NULL THEN 'all' WHEN n_name IS NULL THEN 'r_name' ELSE 'n_name' END AS level_name,
  coalesce(n_name, r_name, 'All') AS name,
  '[All]' || coalesce('.[' || r_name || ']', '') || coalesce('.[' || n_name || ']', '') AS unique_name,
  CASE WHEN r_name IS NULL THEN NULL WHEN n_name IS NULL THEN '[All]' ELSE '[All].[' || r_name || ']' END AS parent_unique_name,
  row_number() OVER (ORDER BY r_name NULLS FIRST, n_name NULLS FIRST) - 1 AS ordinal,
  CASE WHEN r_name IS NULL THEN (SELECT count(DISTINCT r_name) FROM geo)
       WHEN n_name IS NULL THEN (SELECT count(DISTINCT g.n_name) FROM geo g WHERE g.r_name = m.r_name) ELSE 0 END AS child_count
FROM m""")
def c22(t):
    return hierarchy.members(_customers(t), ["r_name", "n_name"])


@query("c23_member_property_filter", """
SELECT l_partkey, p_brand, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 20 GROUP BY 1, 2""")
def c23(t):
    parts = t.part.where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    quantity = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    return quantity.join(parts, "l_partkey").select("l_partkey", "p_brand", "quantity")


@query("c26_ragged_hierarchy", """
WITH r AS (SELECT c_custkey, [r_name, CASE WHEN r_name = 'ASIA' THEN ' ' ELSE n_name END, CASE WHEN c_acctbal < 2000 THEN '' ELSE c_mktsegment END] AS l
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT c_custkey, list_filter(l, lambda x: trim(x) <> '') AS path FROM r)
SELECT c_custkey, array_to_string(path, '/') AS path, path[len(path) - 1] AS parent FROM p""")
def c26(t):
    df = _customers(t).select(
        "c_custkey",
        "r_name",
        F.when(F.col("r_name") == "ASIA", " ").otherwise(F.col("n_name")).alias("n"),
        F.when(F.col("c_acctbal") < 2000, "").otherwise(F.col("c_mktsegment")).alias("s"),
    )
    levels = ["r_name", "n", "s"]
    path = F.array_join(hierarchy.ragged_path(levels), "/")
    return df.select("c_custkey", path.alias("path"), hierarchy.ragged_parent(levels).alias("parent"))


# ---------------------------------------------------------------- measures


def _daily_sales(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("c_nationkey", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("price"))


SQL_DAILY = """daily AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS v
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _sql_periods(pick, levels):
    return " UNION ALL ".join(
        f"SELECT c_nationkey, '{name}' AS level, CAST({period} AS VARCHAR) AS period, {pick}(v, d) AS value FROM daily GROUP BY ALL"
        for name, period in levels.items()
    )


SQL_MONTHLY = {"year": "year(d)", "quarter": "year(d) * 10 + quarter(d)", "month": "year(d) * 100 + month(d)"}
SQL_WEEKLY = {"iso_year": "isoyear(d)", "iso_week": "isoyear(d) * 100 + week(d)"}


@query("c12_semi_additive_closing", f"WITH {SQL_DAILY} " + _sql_periods("arg_max", SQL_MONTHLY))
def c12(t):
    out = cube.semi_additive(_daily_sales(t), "day", cube.monthly_hierarchy("day"), F.sum("price"), ["c_nationkey"])
    return out.withColumn("value", F.col("value").cast("double"))


@query("c12_semi_additive_opening", f"WITH {SQL_DAILY} " + _sql_periods("arg_min", SQL_MONTHLY))
def c12_first(t):
    out = cube.semi_additive(_daily_sales(t), "day", cube.monthly_hierarchy("day"), F.sum("price"), ["c_nationkey"], "first")
    return out.withColumn("value", F.col("value").cast("double"))


@query("c13_semi_additive_weekly", f"WITH {SQL_DAILY} " + _sql_periods("arg_max", SQL_WEEKLY))
def c13(t):
    out = cube.semi_additive_in(_daily_sales(t), "day", "weekly", F.sum("price"), ["c_nationkey"])
    return out.withColumn("value", F.col("value").cast("double"))


@query("c14_ratio_measure", f"""WITH {SQL_GEO}
SELECT r_name, CAST(sum(price) AS DOUBLE) / count(*) AS ratio FROM sales GROUP BY 1""")
def c14(t):
    return cube.ratio_measure(_geo_sales(t), ["r_name"], total("o_totalprice"), F.count("*"))


SQL_SCENARIO = f"""WITH {SQL_GEO},
w AS (SELECT n_name, CAST(sum(price) AS DOUBLE) AS actual, CAST(coalesce(sum(price) FILTER (o_orderstatus <> 'P'), 0) AS DOUBLE) AS budget FROM sales GROUP BY 1)
SELECT n_name, 'Actual' AS scenario, actual AS value FROM w UNION ALL SELECT n_name, 'Budget', budget FROM w"""


@query("c15_scenario_dimension", SQL_SCENARIO)
def c15(t):
    budget = F.coalesce(F.sum(F.when(F.col("o_orderstatus") != "P", F.col("price"))), F.lit(0)).cast("double")
    return cube.scenario(_geo_sales(t), ["n_name"], {"Actual": total("o_totalprice"), "Budget": budget})


@query("c16_what_if", f"""WITH {SQL_GEO}
SELECT r_name, revenue, rate, revenue * (1.0::DOUBLE + rate) AS projected
FROM (SELECT r_name, CAST(sum(price) AS DOUBLE) AS revenue FROM sales GROUP BY 1),
     (SELECT unnest([0.0, 0.1, 0.2]::DOUBLE[]) AS rate)""")
def c16(t):
    revenue = _geo_sales(t).groupBy("r_name").agg(total("o_totalprice").alias("revenue"))
    return cube.what_if(revenue, "revenue", [0.0, 0.1, 0.2])


@query("c17_curated_rollup", f"""WITH {SQL_GEO}
SELECT r_name, n_name, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level_no,
  CAST(sum(price) FILTER (n_name NOT IN ('NATION_3', 'NATION_8')) AS DOUBLE) AS revenue,
  count(*) FILTER (n_name NOT IN ('NATION_3', 'NATION_8')) AS orders FROM sales GROUP BY ROLLUP (r_name, n_name)""")
def c17(t):
    keep = ~F.col("n_name").isin("NATION_3", "NATION_8")
    out = cube.curated_rollup(
        _geo_sales(t), ["r_name", "n_name"], {"revenue": ("sum", "price"), "orders": ("count", "*")}, keep
    )
    return out.withColumn("revenue", F.col("revenue").cast("double")).drop("level_name")


@query("c18_fixed_measure", f"""WITH {SQL_GEO}, w AS (SELECT n_name, CAST(sum(price) AS DOUBLE) AS revenue FROM sales GROUP BY 1)
SELECT n_name, revenue, (SELECT revenue FROM w WHERE n_name = 'NATION_3') AS nation_3 FROM w""")
def c18(t):
    revenue = _geo_sales(t).groupBy("n_name").agg(total("o_totalprice").alias("revenue"))
    return cube.fixed_measure(revenue, "nation_3", F.max("revenue"), F.col("n_name") == "NATION_3")


@query("c24_slicer", f"""WITH {SQL_GEO}
SELECT n_name, c_mktsegment, count(*) AS orders FROM sales WHERE r_name = 'ASIA' AND c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1, 2""")
def c24(t):
    df = cube.slice_by(
        _geo_sales(t), {"r_name": "ASIA", "c_mktsegment": ["BUILDING", "MACHINERY"], "n_name": cube.ALL}
    )
    return df.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("orders"))


@query("c25_filter_members", """
SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY 1 HAVING count(*) > 12""")
def c25(t):
    return cube.filter_members(
        t.orders, ["o_custkey"], {"orders": F.count("*"), "revenue": total("o_totalprice")}, F.col("orders") > 12
    )


def _cube(t):
    return cube.Cube(
        t.orders.withColumn("price", money("o_totalprice")),
        {
            "customer": cube.Dimension(
                _customers(t), {"o_custkey": "c_custkey"}, ["r_name", "n_name", "c_mktsegment"]
            )
        },
        {"revenue": ("sum", "price"), "orders": ("count", "*"), "dearest": ("max", "price")},
        {"revenue": "%.2f"},
    )


def _as_doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("revenue", "dearest") if c in df.columns})


@query("c27_cube_query", f"""WITH {SQL_GEO}
SELECT r_name, o_orderstatus, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS orders, CAST(max(price) AS DOUBLE) AS dearest,
  CAST(CAST(sum(price) AS DECIMAL(28,2)) AS VARCHAR) AS revenue_text
FROM sales WHERE c_mktsegment = 'BUILDING' GROUP BY 1, 2""")
def c27(t):
    model = _cube(t)
    out = model.query(["r_name"], ["o_orderstatus"], {"c_mktsegment": "BUILDING"})
    return model.formatted(_as_doubles(out))


@query("c27_cube_query_totals", f"""WITH {SQL_GEO}
SELECT r_name, n_name, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level_no,
  CASE 2 - grouping(r_name) - grouping(n_name) WHEN 0 THEN 'all' WHEN 1 THEN 'r_name' ELSE 'n_name' END AS level_name,
  CAST(sum(price) AS DOUBLE) AS revenue FROM sales GROUP BY ROLLUP (r_name, n_name)""")
def c27_totals(t):
    return _as_doubles(_cube(t).query(["r_name", "n_name"], measures=["revenue"], totals=True))


@query("c27_cube_composite_key", """
SELECT l_returnflag || l_linestatus AS label, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1""")
def c27_composite(t):
    """A dimension that the fact refers to by two columns."""
    kinds = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).distinct()
    kinds = kinds.withColumn("label", F.concat("flag", "status"))
    model = cube.Cube(
        t.lineitem.withColumn("quantity", money("l_quantity")),
        {"kind": cube.Dimension(kinds, {"l_returnflag": "flag", "l_linestatus": "status"}, ["label"])},
        {"lines": ("count", "*"), "quantity": ("sum", "quantity")},
    )
    out = model.query(["label"])
    return out.withColumn("quantity", F.col("quantity").cast("double"))


@query("c28_derived_dimension", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def c28(t):
    return cube.derive_dim(t.orders, ["o_orderpriority", "o_orderstatus"])


SQL_CHANGE = """m AS (SELECT c_nationkey, {period} AS period_no, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT a.c_nationkey, a.period_no, a.value, CASE WHEN b.value <> 0 THEN a.value - b.value END AS change
FROM m a LEFT JOIN m b ON a.c_nationkey = b.c_nationkey AND a.period_no = b.period_no + 1"""


def _sales_by(t, period):
    sales = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return sales.groupBy("c_nationkey", period.alias("period_no")).agg(total("o_totalprice").alias("value"))


@query("c29_period_change_monthly", "WITH " + SQL_CHANGE.format(period="year(o_orderdate) * 12 + month(o_orderdate)"))
def c29(t):
    months = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("bigint")
    return cube.period_change(_sales_by(t, months), "period_no", "value", ["c_nationkey"])


@query("c29_period_change_weekly", "WITH " + SQL_CHANGE.format(
    period="(date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', o_orderdate) AS DATE))) // 7"))
def c29_weekly(t):
    monday = F.to_date(F.date_trunc("week", "o_orderdate"))
    weeks = F.floor(F.datediff(monday, F.lit("1970-01-05").cast("date")) / F.lit(7))
    return cube.period_change(_sales_by(t, weeks), "period_no", "value", ["c_nationkey"])
