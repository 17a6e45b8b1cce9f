"""Spatial queries on coordinates derived from keys."""

from pyspark.sql import functions as F

from olapflow.catalog.base import money, query, total
from olapflow.functions import geo as geo_columns
from olapflow.operators import geo


def _points(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        money("o_totalprice").alias("price"),
        (key * 37 % 400 - 200 + F.lit(0.25)).cast("double").alias("lon"),
        (key * 17 % 200 - 100 + F.lit(0.5)).cast("double").alias("lat"),
    )


def _regions(t):
    """Overlapping slanted quadrilaterals on a 5 x 5 grid, one per nation."""
    x = (F.col("n_nationkey") % 5 * 72 - 180).cast("double")
    y = (F.floor(F.col("n_nationkey") / 5) * 36 - 90).cast("double")

    def corner(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    ring = F.array(corner(0.0, 0.0), corner(90.0, 0.0), corner(100.0, 36.0), corner(10.0, 36.0))
    return t.nation.select("n_nationkey", "n_name", ring.alias("ring"))


SQL_POINTS = """pts AS (SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
  CAST(o_orderkey * 37 % 400 - 200 + 0.25 AS DOUBLE) AS lon, CAST(o_orderkey * 17 % 200 - 100 + 0.5 AS DOUBLE) AS lat FROM orders)"""

SQL_COVER = SQL_POINTS + """,
quad AS (SELECT n_nationkey, n_name, CAST(n_nationkey % 5 * 72 - 180 AS DOUBLE) AS x, CAST(n_nationkey // 5 * 36 - 90 AS DOUBLE) AS y FROM nation),
edge AS (SELECT n_nationkey, x AS ax, y AS ay, x + 90 AS bx, y AS b_y FROM quad
   UNION ALL SELECT n_nationkey, x + 90, y, x + 100, y + 36 FROM quad
   UNION ALL SELECT n_nationkey, x + 100, y + 36, x + 10, y + 36 FROM quad
   UNION ALL SELECT n_nationkey, x + 10, y + 36, x, y FROM quad),
hit AS (SELECT o_orderkey, n_nationkey FROM pts, edge GROUP BY 1, 2
   HAVING count(*) FILTER ((ay > lat) <> (b_y > lat) AND lon < (bx - ax) * (lat - ay) / (b_y - ay) + ax) % 2 = 1),
cover AS (SELECT o_orderkey, min(n_nationkey) AS n_nationkey FROM hit GROUP BY 1)"""


@query("k01_make_point", f"WITH {SQL_POINTS} SELECT o_orderkey, lon AS x, lat AS y FROM pts WHERE abs(lon) <= 180 AND abs(lat) <= 90")
def k01(t):
    return geo.make_point(_points(t), "lon", "lat").select("o_orderkey", "geom.x", "geom.y")


@query("k02_within_bbox", f"WITH {SQL_POINTS} SELECT o_orderkey FROM pts WHERE lon BETWEEN -20 AND 45.25 AND lat BETWEEN 10.5 AND 60")
def k02(t):
    return geo.within_bbox(_points(t), "lon", "lat", -20.0, 10.5, 45.25, 60.0).select("o_orderkey")


SQL_DURING = f"""WITH {SQL_POINTS}, w AS (SELECT * FROM pts WHERE lon BETWEEN -90 AND 90 AND lat BETWEEN -45 AND 45
  AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01')"""


def _during(t):
    lo = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return geo.within_bbox_during(_points(t), "lon", "lat", (-90.0, -45.0, 90.0, 45.0), "o_orderdate", lo, hi)


@query("k03_within_bbox_during", f"{SQL_DURING} SELECT o_orderkey FROM w")
def k03(t):
    return _during(t).select("o_orderkey")


@query("k04_count_by_day", f"{SQL_DURING} SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM w GROUP BY 1")
def k04(t):
    return geo.count_by_day(_during(t), "o_orderdate")


@query("k05_covering_join", f"WITH {SQL_COVER} SELECT o_orderkey, n_nationkey FROM cover")
def k05(t):
    points = _points(t).select("o_orderkey", "lon", "lat")
    out = geo.covering_join(points, "lon", "lat", _regions(t), "n_nationkey", "ring")
    return out.select("o_orderkey", "n_nationkey")


SQL_COVER_HOLES = SQL_COVER.replace("edge AS (", """edge AS (
   SELECT n_nationkey, x + 30 AS ax, y + 9 AS ay, x + 50 AS bx, y + 9 AS b_y FROM quad
   UNION ALL SELECT n_nationkey, x + 50, y + 9, x + 55, y + 27 FROM quad
   UNION ALL SELECT n_nationkey, x + 55, y + 27, x + 35, y + 27 FROM quad
   UNION ALL SELECT n_nationkey, x + 35, y + 27, x + 30, y + 9 FROM quad UNION ALL """)


@query("k05_covering_join_multipolygon", f"WITH {SQL_COVER_HOLES} SELECT o_orderkey, n_nationkey FROM cover")
def k05_holes(t):
    """The same regions, each with a hole."""
    corner = lambda dx, dy: F.struct((F.col("ring")[0].x + dx).alias("x"), (F.col("ring")[0].y + dy).alias("y"))
    hole = F.array(corner(30.0, 9.0), corner(50.0, 9.0), corner(55.0, 27.0), corner(35.0, 27.0))
    shapes = _regions(t).select("n_nationkey", F.array(F.array("ring", hole)).alias("shape"))
    return geo.covering_join(
        _points(t).select("o_orderkey", "lon", "lat"), "lon", "lat", shapes, "n_nationkey", "shape"
    ).select("o_orderkey", "n_nationkey")


SQL_MIXED = f"""{SQL_POINTS},
block AS (SELECT s_suppkey AS k, CAST(s_suppkey * 37 % 400 - 200 AS DOUBLE) AS x, CAST(s_suppkey * 17 % 200 - 100 AS DOUBLE) AS y FROM supplier WHERE s_suppkey % 3 > 0),
box AS (SELECT k, x, y, x + 0.7::DOUBLE AS x1, y + 0.7::DOUBLE AS y1 FROM block
  UNION ALL SELECT 2000000000, -170, -80, 170, 80),
cover AS (SELECT o_orderkey, min(k) AS region FROM pts JOIN box ON lon >= x AND lon < x1 AND lat >= y AND lat < y1 GROUP BY 1)"""


def _mixed_regions(t):
    """A continent and small blocks for two suppliers in three; a block goes before the continent."""
    k = F.col("s_suppkey")
    blocks = t.supplier.where("s_suppkey % 3 > 0").select(
        k.alias("region"), (k * 37 % 400 - 200).cast("double").alias("x"), (k * 17 % 200 - 100).cast("double").alias("y"), F.lit(0.7).alias("w"), F.lit(0.7).alias("h")
    )
    land = t.region.where("r_regionkey = 0").select(F.lit(2_000_000_000).cast("bigint"), F.lit(-170.0), F.lit(-80.0), F.lit(340.0), F.lit(160.0))
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    none, w, h = F.lit(0.0), F.col("w"), F.col("h")
    return blocks.union(land).select("region", F.array(corner(none, none), corner(w, none), corner(w, h), corner(none, h)).alias("ring"))


@query("k05_covering_join_mixed_sizes", f"WITH {SQL_MIXED} SELECT o_orderkey, region FROM cover")
def k05_mixed(t):
    out = geo.covering_join_tree(_points(t).select("o_orderkey", "lon", "lat"), "lon", "lat", _mixed_regions(t), "region", "ring")
    return out.select("o_orderkey", "region")


@query("k06_covering_summary_mixed_sizes", f"""WITH {SQL_MIXED}
SELECT region, count(*) AS count, CAST(sum(price) AS DOUBLE) AS total_price FROM cover JOIN pts USING (o_orderkey) GROUP BY 1""")
def k06_mixed(t):
    out = geo.covering_summary(
        _points(t), "lon", "lat", _mixed_regions(t), "region", "ring", skip=["o_orderkey", "o_custkey"], mixed_sizes=True
    )
    return out.select("region", "count", F.col("total_price").cast("double").alias("total_price"))


SQL_SUMMARY = f"""WITH {SQL_COVER}
SELECT n_nationkey, count(*) AS count, CAST(sum(price) AS DOUBLE) AS total_price, CAST(sum(price) AS DOUBLE) / count(*) AS avg_price
FROM cover JOIN pts USING (o_orderkey) GROUP BY 1"""


def _summary(t):
    out = geo.covering_summary(
        _points(t), "lon", "lat", _regions(t).drop("n_name"), "n_nationkey", "ring", skip=["o_orderkey", "o_custkey"]
    )
    return out.withColumn("total_price", F.col("total_price").cast("double"))


@query("k06_covering_summary", SQL_SUMMARY)
def k06(t):
    return _summary(t).drop("ring")


SQL_CELL = SQL_POINTS + """,
c AS (SELECT CAST(least(floor((lon + 180) * (8192 / 360.0)), 8191) AS BIGINT) AS cx, CAST(least(floor((lat + 90) * (4096 / 180.0)), 4095) AS BIGINT) AS cy
      FROM pts WHERE abs(lon) <= 180 AND abs(lat) <= 90),
cells AS (SELECT CAST(list_sum([((cx >> (12 - i)) & 1) << (24 - 2 * i) FOR i IN range(13)]) + list_sum([((cy >> (11 - i)) & 1) << (23 - 2 * i) FOR i IN range(12)]) AS BIGINT) AS cell,
       count(*) AS n FROM c GROUP BY 1)"""


@query("k07_density", f"WITH {SQL_CELL} SELECT cell, n FROM cells")
def k07(t):
    return geo.density(geo.make_point(_points(t), "lon", "lat"), "lon", "lat")


@query("k07_geohash_text", f"""WITH {SQL_CELL}
SELECT list_aggregate([substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST((cell >> (20 - 5 * i)) & 31 AS INTEGER) + 1, 1) FOR i IN range(5)], 'string_agg', '') AS geohash, n FROM cells""")
def k07_text(t):
    cells = geo.density(geo.make_point(_points(t), "lon", "lat"), "lon", "lat")
    return cells.select(geo_columns.geohash_text(F.col("cell")).alias("geohash"), "n")


@query("k08_geojson", f"""WITH {SQL_COVER},
s AS (SELECT n_nationkey, count(*) AS n FROM cover GROUP BY 1)
SELECT n_nationkey, n AS count, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[[' || x || ',' || y || '],[' || (x + 90) || ',' || y || '],[' || (x + 100) || ',' || (y + 36) || '],[' || (x + 10) || ',' || (y + 36) || '],[' || x || ',' || y || ']]]}},"properties":{{"n_nationkey":' || n_nationkey || ',"count":' || n || '}}}}' AS feature
FROM s JOIN quad USING (n_nationkey)""")
def k08(t):
    return geo.to_geojson(_summary(t), "ring", ["n_nationkey", "count"])


@query("k09_choropleth", """
WITH s AS (SELECT c_nationkey, CAST(sum(CASE WHEN c_nationkey <> 4 THEN CAST(o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS revenue
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
b AS (SELECT min(revenue) AS lo, max(revenue) AS hi FROM s)
SELECT n_nationkey, n_name, revenue,
  CASE WHEN revenue IS NOT NULL THEN CAST(least(floor((revenue - lo) * 5 / (hi - lo)) + 1, 5) AS INTEGER) END AS class
FROM nation CROSS JOIN b LEFT JOIN s ON n_nationkey = c_nationkey""")
def k09(t):
    stats = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    known = total(F.when(F.col("c_nationkey") != 4, money("o_totalprice")))  # one region without a value
    stats = stats.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(known.alias("revenue"))
    features = t.nation.select("n_nationkey", "n_name")
    return geo.choropleth(features, stats, "n_nationkey", "revenue", 5)
