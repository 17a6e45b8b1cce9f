"""Bridges, trees, cubes and spatial operators on small data with known results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from olapflow.functions import geo as geo_columns
from olapflow.operators import agg, geo, window
from olapflow.plans import bridge, cube, hierarchy
from olapflow.session import stored
from tests.helpers import rows

ITEMS = {1: "sports", 2: "fashion", 3: "technology", 4: "fashion week", 5: "travel"}


@pytest.fixture(scope="module")
def interests(spark):
    """Two groups: {1, 3, 5} under key 2 and {2, 3} under key 1."""
    data = [(1, 2), (1, 3), (2, 1), (2, 3), (2, 5)]
    pairs = spark.createDataFrame(data, "group_tk bigint, item_tk bigint")
    return bridge.weighted_bridge(pairs, "group_tk", "item_tk")


@pytest.fixture(scope="module")
def campaigns(spark):
    data = [("Sale", 2, 512000), ("TV Offer", 1, 230200)]
    return spark.createDataFrame(data, "campaign string, group_tk bigint, impressions int")


def test_weighted_totals_are_preserved(interests, campaigns):
    out = bridge.allocate(campaigns, interests, "group_tk", ["impressions"])
    totals = dict(rows(out.groupBy("campaign").agg(F.round(F.sum("impressions"), 6))))
    assert totals == {"Sale": 512000.0, "TV Offer": 230200.0}
    spread = bridge.allocate_totals(campaigns, interests, "group_tk", "item_tk", ["impressions"])
    assert round(spread.agg(F.sum("impressions")).first()[0], 6) == 742200.0


def test_impact_counts_the_whole_measure(interests, campaigns):
    out = dict(rows(bridge.impact(campaigns, interests, "group_tk", "item_tk", ["impressions"])))
    assert out == {1: 512000, 2: 230200, 3: 742200, 5: 512000}


def test_group_match_is_exact(interests):
    assert rows(bridge.match_group(interests, "group_tk", "item_tk", [5, 1, 3])) == [(2,)]
    assert rows(bridge.match_group(interests, "group_tk", "item_tk", [1, 3])) == []
    assert rows(bridge.match_group(interests, "group_tk", "item_tk", [1, 3, 99])) == []


def test_bridge_maintenance(spark, interests):
    dim = spark.createDataFrame([(k, v) for k, v in ITEMS.items()], "item_tk bigint, interest string")
    incoming = spark.createDataFrame(
        [("a", "travel"), ("a", "sports"), ("a", "technology"), ("a", "sports"), ("b", "art"), ("b", "sports"), ("c", "sports"), ("c", "art")],
        "rec string, interest string",
    )
    new_dim, added, groups = bridge.maintain_bridge(
        interests, dim, incoming, "rec", "interest", order=["interest"], name_chunk=F.substring("interest", 1, 1)
    )
    assert rows(new_dim.where("item_tk > 5"), "item_tk", "interest") == [(6, "art")]
    assert rows(groups) == [("a", 2), ("b", 3), ("c", 3)]
    assert rows(added, "group_tk", "item_tk", "weight") == [(3, 1, 0.5), (3, 6, 0.5)]


EDGES = [(1, None), (2, 1), (3, 1), (4, 2), (5, 2), (6, 4)]


@pytest.fixture(scope="module")
def tree(spark):
    return hierarchy.closure(spark.createDataFrame(EDGES, "child int, parent int"), "child", "parent")


def brute_closure(edges):
    parent = dict(edges)
    out = []
    for node in parent:
        up, distance = node, 0
        while up is not None:
            out.append((up, node, distance))
            up, distance = parent.get(up), distance + 1
    return sorted(out)


def test_closure(tree):
    assert sorted(tuple(r) for r in tree.select("ancestor", "descendant", "distance").collect()) == brute_closure(EDGES)


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_closure_of_larger_trees(spark, shape):
    rng = random.Random(5)
    up = {"chain": lambda i: i - 1, "random": lambda i: rng.randrange(i), "star": lambda i: 0}[shape]
    edges = [(0, None)] + [(i, up(i)) for i in range(1, 40)]
    out = hierarchy.closure(spark.createDataFrame(edges, "child int, parent int"), "child", "parent")
    assert sorted(tuple(r) for r in out.select("ancestor", "descendant", "distance").collect()) == brute_closure(edges)


def test_cycles_are_reported(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "child int, parent int")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.closure(edges, "child", "parent")


def test_a_cycle_is_named_before_pairs_are_made(spark, monkeypatch):
    """A million nodes hang on a two-node cycle; the pointers alone find it."""
    n = 1_000_000
    edges = spark.range(2, n).selectExpr("id AS child", "id div 2 AS parent").union(spark.createDataFrame([(1, n), (n, 1)], "child long, parent long"))
    written = []
    monkeypatch.setattr(hierarchy, "stored", lambda df, label: written.append(label) or stored(df, label))
    with pytest.raises(ValueError, match=f"cycle, among others of 1, {n}"):
        hierarchy.closure(edges, "child", "parent")
    assert set(written) == {"pointers"} and len(written) < 25


def test_updates_of_pairs(spark):
    rng = random.Random(9)
    for _ in range(3):
        up = {0: None} | {i: rng.randrange(i) for i in range(1, 30)}
        pairs = hierarchy.closure(spark.createDataFrame(list(up.items()), "child int, parent int"), "child", "parent")
        # moves to smaller numbers make no cycle; 30 to 34 are new, one is cut off
        moves = {i: rng.randrange(i) for i in rng.sample(range(1, 30), 6)} | {i: rng.randrange(i) for i in range(30, 35)}
        moves[rng.randrange(1, 30)] = None
        out = hierarchy.update_closure(pairs, spark.createDataFrame(list(moves.items()), "child int, parent int"), "child", "parent")
        assert rows(out, "ancestor", "descendant", "distance") == sorted(brute_closure(list((up | moves).items())), key=lambda t: tuple(map(str, t)))
    chain = hierarchy.closure(spark.createDataFrame([(1, None), (2, 1), (3, 2)], "child int, parent int"), "child", "parent")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.update_closure(chain, spark.createDataFrame([(1, 3)], "child int, parent int"), "child", "parent")


def test_member_order_with_one_top_member(spark, monkeypatch):
    monkeypatch.setattr(window, "CHUNK_ROWS", 50)
    dim = spark.range(1_000).selectExpr("'all of it' AS a", "lpad(cast(id * 37 % 1000 as string), 4, '0') AS b")
    out = {r.name: r.ordinal for r in hierarchy.members(dim, ["a", "b"]).collect()}
    assert out == {"All": 0, "all of it": 1} | {f"{i:04d}": i + 2 for i in range(1_000)}


def test_a_tree_of_any_depth(spark):
    depth = 3_000
    links = spark.range(1, depth + 1).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent"))
    pairs = hierarchy.closure(links, "child", "parent")
    assert pairs.agg(F.max("distance")).first()[0] == depth


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_totals_from_edges_equal_those_over_pairs(spark, shape):
    rng = random.Random(6)
    up = {"chain": lambda i: i - 1, "random": lambda i: rng.randrange(i), "star": lambda i: 0}[shape]
    edges = spark.createDataFrame([(0, None)] + [(i, up(i)) for i in range(1, 40)], "child int, parent int")
    sales = spark.createDataFrame([(rng.randrange(45), rng.randrange(100)) for _ in range(60)], "node int, v int")
    pairs = hierarchy.closure(edges, "child", "parent")
    assert rows(hierarchy.rollup_edges(sales, edges, "child", "parent", "node", ["v"])) == rows(hierarchy.rollup_tree(sales, pairs, "node", ["v"]))
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.rollup_edges(sales, edges.where("child > 0").selectExpr("child", "CASE WHEN child = 1 THEN 39 ELSE parent END AS parent").where(
            "parent is not null").union(spark.createDataFrame([(39, 1)], "child int, parent int")), "child", "parent", "node", ["v"])


def test_tree_totals(spark, tree):
    sales = spark.createDataFrame([(2, 10), (4, 5), (6, 1), (3, 7)], "node int, v int")
    assert dict(rows(hierarchy.rollup_tree(sales, tree, "node", ["v"]))) == {1: 23, 2: 16, 3: 7, 4: 6, 6: 1}
    chosen = spark.createDataFrame([(2,), (4,)], "ancestor int")
    assert rows(hierarchy.rollup_set(sales, tree, "node", chosen, ["v"])) == [(16,)]
    own = {r.ancestor: (r.own, r.total) for r in hierarchy.own_and_total(sales, tree, "node", "v").collect()}
    assert own[1] == (None, 23) and own[4] == (5, 6)


def test_toggle(spark):
    expanded = spark.createDataFrame([("a", None), ("b", None)], "l1 string, l2 string")
    clicked = spark.createDataFrame([("b", None), ("c", None)], "l1 string, l2 string")
    assert rows(hierarchy.toggle(expanded, clicked)) == [("a", None), ("c", None)]


def test_drill_needs_every_ancestor_open(spark):
    df = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "z", "3")], "l1 string, l2 string, l3 string")
    rolled = agg.rollup_levels(df, ["l1", "l2", "l3"], {"n": ("count", "*")})
    opened = spark.createDataFrame([("a", None, None), ("a", "x", None), ("b", "z", None)], "l1 string, l2 string, l3 string")
    seen = rows(hierarchy.drill(rolled, ["l1", "l2", "l3"], opened), "l1", "l2", "l3")
    assert set(seen) == {(None,) * 3, ("a", None, None), ("b", None, None), ("a", "x", None), ("a", "y", None), ("a", "x", "1")}


def test_multi_valued_attribute(spark):
    sales = spark.createDataFrame([("joe", 2, 6), ("joe", 4, 10), ("ann", 1, 3)], "client string, units int, spent int")
    likes = spark.createDataFrame([("joe", "fishing"), ("joe", "photography"), ("joe", "cooking")], "client string, interest string")
    out = bridge.valid_measure(likes, sales, ["client"], {"units": F.sum("units"), "revenue": F.sum("spent")})
    assert rows(out, "client", "interest", "units", "revenue") == [
        ("joe", "cooking", 6, 16), ("joe", "fishing", 6, 16), ("joe", "photography", 6, 16)
    ]
    across = bridge.drill_across([(sales, {"units": F.sum("units")}), (likes, {"n": F.count("*")})], ["client"])
    assert rows(across) == [("ann", 1, None), ("joe", 6, 3)]


def test_semi_additive_never_adds_days(spark):
    df = spark.createDataFrame([("2014-08-30", 5), ("2014-08-31", 7), ("2014-08-31", 1), ("2014-09-01", 9)], "d string, v int")
    df = df.withColumn("day", F.to_date("d"))
    out = {(r.level, r.period): r.value for r in cube.semi_additive_in(df, "day", "monthly", F.sum("v")).collect()}
    assert out[("month", "201408")] == 8 and out[("quarter", "20143")] == 9 and out[("year", "2014")] == 9


def test_period_change_does_not_skip_gaps(spark):
    df = spark.createDataFrame([(1, 10), (2, 15), (4, 20), (5, 0), (6, 8), (7, None)], "p int, v int")
    out = dict(rows(cube.period_change(df, "p", "v"), "p", "change"))
    assert out == {1: None, 2: 5, 4: None, 5: -20, 6: None, 7: None}


def test_what_if(spark):
    df = spark.createDataFrame([("a", 100.0)], "k string, v double")
    assert [round(r.projected, 6) for r in cube.what_if(df, "v", [0.0, 0.1, 0.2]).collect()] == [100.0, 110.0, 120.0]


def ray(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


RINGS = {
    3: [(0, 0), (20, 0), (20, 20), (10, 8), (0, 20)],
    1: [(15, 5), (40, 5), (40, 30), (15, 30)],
    2: [(-30, -30), (-10, -25), (-20, 0)],
    9: [(-60, -60), (60, -60), (60, -50), (-60, -50)],
}


@pytest.mark.parametrize("size", [7.0, None])
@pytest.mark.parametrize("bound", [1 << 26, -1])
def test_covering_join_equals_brute_force(spark, monkeypatch, size, bound):
    monkeypatch.setattr(geo, "BROADCAST_BYTES", bound)
    rng = random.Random(3)
    points = [(i, rng.uniform(-62, 62), rng.uniform(-62, 62)) for i in range(400)]
    points += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (10, 10), (15, 5), (20, 10), (-20, -20)])]
    want = []
    for i, x, y in points:
        keys = sorted(k for k, ring in RINGS.items() if ray(ring, x, y))
        want += [(i % 7 or None, keys[0])] if keys else []
    ring_type = "array<struct<x:double,y:double>>"
    regions = spark.createDataFrame([(k, [(float(a), float(b)) for a, b in r]) for k, r in RINGS.items()], f"k int, ring {ring_type}")
    points = [(i % 7 or None, x, y) for i, x, y in points]  # repeated and null ids
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    out = geo.covering_join(df, "lon", "lat", regions, "k", "ring", size=size)
    assert sorted(((r.id, r.k) for r in out.collect()), key=str) == sorted(want, key=str)


def test_holes_and_several_polygons(spark):
    square = lambda x, y, n: [(float(x), float(y)), (float(x + n), float(y)), (float(x + n), float(y + n)), (float(x), float(y + n))]
    shape = [[square(0, 0, 30), square(10, 10, 10)], [square(50, 0, 5)]]  # one polygon with a hole, and another
    kind = "array<array<array<struct<x:double,y:double>>>>"
    regions = spark.createDataFrame([(1, shape), (2, [[square(12, 12, 3)]])], f"k int, shape {kind}")
    places = {"in": (5, 5), "hole": (18, 18), "other": (52, 2), "island": (13, 13), "out": (40, 40)}
    points = spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in places.items()], "n string, lon double, lat double")
    got = {r.n: r.k for r in geo.covering_join(points, "lon", "lat", regions, "k", "shape").collect()}
    assert got == {"in": 1, "other": 1, "island": 2}
    feature = geo.to_geojson(regions.where("k = 2"), "shape", ["k"]).first().feature
    assert feature.startswith('{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":[[[[12.0,12.0],')


def test_single_point_regions_are_kept(spark):
    regions = spark.createDataFrame([(1, [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)])], "k int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 1.0, 1.0, 4.0)], "id int, lon double, lat double, v double")
    out = geo.covering_summary(points, "lon", "lat", regions, "k", "ring", skip=["id"]).first()
    assert (out["count"], out.total_v, out.avg_v) == (1, 4.0, 4.0)


def test_geohash_of_a_known_place(spark):
    df = spark.createDataFrame([(10.40744, 57.64911)], "lon double, lat double")
    cell = geo_columns.geohash_bits(F.col("lon"), F.col("lat"))
    assert df.select(geo_columns.geohash_text(cell)).first()[0] == "u4pru"


def test_impossible_points_are_dropped(spark):
    df = spark.createDataFrame([(1, 10.0, 91.0), (2, 181.0, 0.0), (3, None, 1.0), (4, 180.0, -90.0)], "id int, lon double, lat double")
    assert rows(geo.make_point(df, "lon", "lat"), "id") == [(4,)]


def ring_of(n, x, y, r):
    return [(x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)) for i in range(n)]


def inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def test_regions_of_very_different_size(spark):
    rng = random.Random(8)
    shapes = {10_000: ring_of(400, 0.0, 0.0, 80.0)} | {k: ring_of(5, rng.uniform(-90, 90), rng.uniform(-60, 60), 10 ** rng.uniform(-2, 0)) for k in range(200)}
    frame = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in r]) for k, r in shapes.items()], "k int, ring array<struct<x:double,y:double>>")
    near = [(x + rng.uniform(-0.05, 0.05), y + rng.uniform(-0.05, 0.05)) for k, r in list(shapes.items())[1:] for x, y in r[:2]]
    points = near + [(rng.uniform(-100, 100), rng.uniform(-90, 90)) for _ in range(300)] + [(None, 1.0), (1.0, None), near[0]]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    got = sorted((r.i, r.k) for r in geo.covering_join_tree(df, "x", "y", frame, "k", "ring").collect())
    want = []
    for i, (x, y) in enumerate(points):
        hit = [k for k, r in shapes.items() if None not in (x, y) and inside(r, x, y)]
        want += [(i, min(hit))] if hit else []
    assert got == want
    tree, _ = geo.quadtree(frame, "k", "ring")
    cells, edges = tree.count(), sum(map(len, shapes.values()))
    assert cells < 12 * edges and tree.select("level").distinct().count() > 3
    assert tree.select(F.sum(F.aggregate("__regions", F.lit(0), lambda n, r: n + F.size(r.edges)))).first()[0] < 30 * edges
    assert geo.covering_join_tree(df, "x", "y", frame.limit(0), "k", "ring").count() == 0


def test_holes_in_a_quadtree(spark):
    square = lambda a, b: [{"x": a, "y": a}, {"x": b, "y": a}, {"x": b, "y": b}, {"x": a, "y": b}]
    frame = spark.createDataFrame([(1, [square(0.0, 10.0), square(4.0, 6.0)])], "k int, shape array<array<struct<x:double,y:double>>>")
    df = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 11.0, 1.0), (4, 6.5, 5.0)], "i int, x double, y double")
    assert [r.i for r in geo.covering_join_tree(df, "x", "y", frame, "k", "shape").orderBy("i").collect()] == [2, 4]


def test_regions_upon_each_other_end_the_cuts(spark):
    """Copies of blocks, exact and shifted by next to nothing, on and in a continent."""
    rng = random.Random(9)
    block = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    shapes = {500 + i: block(10.0 * (i % 7) + (i // 7 % 2) * i * 1e-9, 10.0 * (i % 3), 0.7) for i in range(300)}
    shapes |= {10_000: block(-80.0, -80.0, 160.0), 20_000: block(1.0, 1.0, 30.0), 400: block(40.0, -5.0, 9.0)}
    frame = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in r]) for k, r in shapes.items()], "k int, ring array<struct<x:double,y:double>>")
    points = [(x + rng.uniform(-0.1, 0.8), y + rng.uniform(-0.1, 0.8)) for r in shapes.values() for x, y in r[:1]]
    points += [(rng.uniform(-90, 90), rng.uniform(-90, 90)) for _ in range(200)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    got = sorted((r.i, r.k) for r in geo.covering_join_tree(df, "x", "y", frame, "k", "ring").collect())
    want = []
    for i, (x, y) in enumerate(points):
        hit = [k for k, r in shapes.items() if inside(r, x, y)]
        want += [(i, min(hit))] if hit else []
    assert got == want
    tree, _ = geo.quadtree(frame, "k", "ring")
    assert tree.agg(F.max("level")).first()[0] < 16 and tree.count() < 12 * 4 * len(shapes)


def test_summary_of_regions_upon_each_other(spark):
    """Forty copies of a block on a continent: the lowest has the points, and the tree stays small."""
    block = lambda k, x, w: (k, [{"x": a, "y": b} for a, b in ((x, x), (x + w, x), (x + w, x + w), (x, x + w))])
    frame = spark.createDataFrame([block(100 + i, 0.0, 1.0) for i in range(40)] + [block(900, -50.0, 100.0)], "k int, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(1, 0.5, 0.5, 2.0), (2, 0.25, 0.75, 3.0), (3, 30.0, 30.0, 5.0), (4, 99.0, 0.0, 7.0)], "i int, x double, y double, v double")
    out = geo.covering_summary(df, "x", "y", frame, "k", "ring", skip=["i"], mixed_sizes=True)
    assert sorted((r["k"], r["count"], r["total_v"]) for r in out.collect()) == [(100, 2, 5.0), (900, 1, 5.0)]
    assert geo.quadtree(frame, "k", "ring")[0].count() < 200


def test_few_jobs_make_a_tree(spark):
    """401 shapes, the blocks with copies, in few jobs: short jobs were most of the time."""
    block = lambda k, x, y, w, h: (k, [{"x": a, "y": b} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])
    blocks = [block(k, k * 37 % 400 - 200.0, k * 17 % 200 - 100.0, 0.7, 0.7) for k in range(1200)]
    frame = spark.createDataFrame([*blocks, block(9999, -170.0, -80.0, 340.0, 160.0)], "k int, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(k, k * 37 % 400 - 199.75, k * 17 % 200 - 99.5) for k in range(1200)] + [(-1, 0.9, 0.9), (-2, 300.0, 0.0)], "i int, x double, y double")
    spark.sparkContext.setJobGroup("tree", "tree")
    try:
        out = geo.covering_join_tree(df, "x", "y", frame, "k", "ring")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("tree")) <= 30
    assert {r.i: r.k for r in out.collect()} == {k: k % 400 for k in range(1200)} | {-1: 9999}
