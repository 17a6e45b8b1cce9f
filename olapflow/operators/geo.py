"""Spatial filters, covering joins and densities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.functions import geo
from olapflow.operators.agg import quantize, summarize_all
from olapflow.session import checkpointed, stored, stored_measured


def make_point(df: DataFrame, lon: str, lat: str, name: str = "geom") -> DataFrame:
    """Add a point; rows without valid coordinates are dropped."""
    return df.withColumn(name, geo.point(F.col(lon), F.col(lat))).where(F.col(name).isNotNull())


def within_bbox(df: DataFrame, lon: str, lat: str, minx, miny, maxx, maxy) -> DataFrame:
    return df.where(geo.in_bbox(F.col(lon), F.col(lat), minx, miny, maxx, maxy))


def within_bbox_during(df: DataFrame, lon: str, lat: str, box: Sequence[float], ts: str, start: Column, end: Column) -> DataFrame:
    """Inside a box and strictly between two instants."""
    return within_bbox(df, lon, lat, *box).where((F.col(ts) > start) & (F.col(ts) < end))


def count_by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.date_format(ts, "yyyyMMdd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


#: Bytes of the grid up to which it is offered for a broadcast; what it must not exceed is
#: known from the counted edges.
BROADCAST_BYTES = 64 << 20


def rings_of(regions: DataFrame, geometry: str) -> Column:
    """Rings of a geometry: an array of points is one ring, an array of rings a polygon
    with its holes, an array of those a multipolygon. Inside follows the even-odd rule."""
    inner = regions.schema[geometry].dataType.elementType
    if not isinstance(inner, T.ArrayType):
        return F.array(geometry)
    return F.flatten(geometry) if isinstance(inner.elementType, T.ArrayType) else F.col(geometry)


def _edges(rings: Column) -> Column:
    """All edges of all rings; a ring need not repeat its first point."""

    def of_ring(ring: Column) -> Column:
        return F.transform(ring, lambda p, i: F.struct(
            p.x.alias("ax"), p.y.alias("ay"),
            F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0))).x.alias("bx"),
            F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0))).y.alias("by"),
        ))

    return F.flatten(F.transform(rings, of_ring))


def edges_contain(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right crosses an odd number of the edges."""
    crosses = lambda e: ((e.ay > y) != (e.by > y)) & (
        x < (e.bx - e.ax) * (y - e.ay) / (e.by - e.ay) + e.ax
    )
    return F.size(F.filter(edges, crosses)) % 2 == 1


def grid_size(regions: DataFrame, geometry: str) -> float:
    """Cell size that suits the regions: half of their mean extent, so that most regions
    touch a few cells and most cells few regions."""
    points = F.flatten(rings_of(regions, geometry))
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    extent = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))
    mean = regions.agg(F.avg(extent)).first()[0]
    return max((mean or 1.0) / 2, 1e-6)


def _grid(regions: DataFrame, key: str, geometry: str, size: float) -> DataFrame:
    """One row per grid cell: the regions that may cover its points, lowest key first.

    A region brings only the edges of the cell's row that a ray from the cell can meet. A
    cell that no edge touches lies inside or outside as a whole and brings none.
    """
    side = F.lit(size)
    own = regions.select(F.col(key).alias("key"), _edges(rings_of(regions, geometry)).alias("edges"))
    low = lambda e: F.floor(F.least(e.ay, e.by) / side)
    high = lambda e: F.floor(F.greatest(e.ay, e.by) / side)
    by_edge = own.select("key", F.explode("edges").alias("e"))
    rows = by_edge.select("key", "e", F.explode(F.sequence(low(F.col("e")), high(F.col("e")))).alias("cy"))
    bands = rows.groupBy("key", "cy").agg(
        F.collect_list("e").alias("edges"),
        F.min(F.floor(F.least("e.ax", "e.bx") / side)).alias("first"), F.max(F.floor(F.greatest("e.ax", "e.bx") / side)).alias("last"),
    )
    cells = bands.select("key", "cy", "edges", F.explode(F.sequence("first", "last")).alias("cx"))
    left, bottom = F.col("cx") * side, F.col("cy") * side
    ahead = F.filter("edges", lambda e: F.greatest(e.ax, e.bx) >= left)
    near = F.exists("edges", lambda e: (
        (F.greatest(e.ax, e.bx) >= left) & (F.least(e.ax, e.bx) <= left + side)
        & (F.greatest(e.ay, e.by) >= bottom) & (F.least(e.ay, e.by) <= bottom + side)
    ))
    whole = ~near & edges_contain(F.col("edges"), left + side / 2, bottom + side / 2)
    region = F.struct("key", whole.alias("whole"), F.when(near, ahead).otherwise(F.slice(ahead, 1, 0)).alias("edges"))
    return (
        cells.where(near | whole)
        .groupBy("cx", "cy")
        .agg(F.array_sort(F.collect_list(region)).alias("__regions"))
        .select(F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), "__regions")
    )


def covering_join(
    points: DataFrame, lon: str, lat: str, regions: DataFrame, key: str, geometry: str, size: float | None = None,
) -> DataFrame:
    """Points with the key of the region that covers them; uncovered points are dropped.

    Regions are rings or lists of rings (polygons with holes, multipolygons). Where they
    overlap the lowest key wins. Regions are laid out on a grid of cells of ``size``
    degrees, by default from their own extents; a point meets the regions of its cell
    only, and ray casting over that cell's edges decides. The grid is broadcast if its
    counted size allows it and joined by cell otherwise, with the same rows either way:
    every point is kept or dropped on its own, repeated and null ids included.
    """
    size = size or grid_size(regions, geometry)
    grid = checkpointed(_grid(regions, key, geometry, size))
    held = grid.agg(F.sum(F.aggregate("__regions", F.lit(64), lambda n, r: n + 64 + 40 * F.size(r.edges)).cast("bigint"))).first()[0]
    if (held or 0) <= BROADCAST_BYTES:
        grid = F.broadcast(grid)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    placed = points.withColumns({"__cx": F.floor(x / F.lit(size)), "__cy": F.floor(y / F.lit(size))})
    covers = F.filter("__regions", lambda r: r.whole | edges_contain(r.edges, x, y))
    hits = placed.join(grid, ["__cx", "__cy"])
    first = hits.select(*points.columns, F.explode(F.slice(covers, 1, 1)).alias("__r"))
    return first.select(*points.columns, F.col("__r.key").alias(key))


#: Edges that a cell of the tree holds before it is cut, levels of halving at most, and copies
#: of an edge in cells still too full, on average, beyond which no cell is cut.
CELL_EDGES, MOST_LEVELS, MOST_COPIES = 16, 30, 32


def quadtree(regions: DataFrame, key: str, geometry: str, cell_edges: int = CELL_EDGES) -> tuple[DataFrame | None, tuple]:
    """Cells that lie side by side, each with the regions that may cover its points, and
    the frame (x, y, side) they are cut from.

    The frame is cut into 4 x 4 cells, and a cell with more than ``cell_edges`` edges is
    cut again, so cells are small where there is much detail and large elsewhere. A
    region brings a cell the edges that a ray from it can meet, or none if no edge touches
    the cell and it lies inside. A round works on the cells still too full, one row per
    region and cell; no row holds more than one region's edges.

    What the lowest key decides is settled here: of regions of the same shape one is left,
    and of those behind a region that holds a cell as a whole none. A cell stays as it is
    where a cut does not part its edges, because they lie upon each other or meet in a
    point: where most of them would be in one part and in others too.
    """
    own = regions.select(F.col(key).alias("key"), _edges(rings_of(regions, geometry)).alias("edges"))
    lowest = F.min(F.struct("key")).alias("low")
    low = lambda a, b: F.min(F.array_min(F.transform("edges", lambda e: F.least(e[a], e[b]))))
    high = lambda a, b: F.max(F.array_max(F.transform("edges", lambda e: F.greatest(e[a], e[b]))))
    own, ends = stored_measured(
        own.where(F.size("edges") > 0).groupBy("edges").agg(lowest).select("low.key", "edges"), "regions",
        x0=low("ax", "bx"), y0=low("ay", "by"), x1=high("ax", "bx"), y1=high("ay", "by"), edges=F.sum(F.size("edges")),
    )
    x0, y0 = ends["x0"], ends["y0"]
    if x0 is None:
        return None, (0.0, 0.0, 1.0)
    side = max(ends["x1"] - x0, ends["y1"] - y0, 1e-9) * 1.001
    u = lambda x: (x - F.lit(x0)) / F.lit(side)
    v = lambda y: (y - F.lit(y0)) / F.lit(side)
    root = {"level": F.lit(0), "size": F.lit(1.0), "cx": F.lit(0).cast("bigint"), "cy": F.lit(0).cast("bigint"), "whole": F.lit(False), "was": F.lit(ends["edges"]).cast("bigint")}

    def cut_once(cells: DataFrame) -> DataFrame:
        """The 4 x 4 parts of every cell, with the regions that touch or hold them. Level and
        size are columns and not literals, so the code made for one round serves them all."""
        cut = cells.select("key", "whole", "edges", "was", "cx", "cy", (F.col("level") + 2).alias("level"), (F.col("size") / 4).alias("size"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("q"))
        cut = cut.withColumns({"cx": F.col("cx") * 4 + F.col("q") % 4, "cy": F.col("cy") * 4 + F.expr("q div 4")})
        cut = cut.withColumns({"left": F.col("cx") * F.col("size"), "bottom": F.col("cy") * F.col("size")})
        left, bottom, size = F.col("left"), F.col("bottom"), F.col("size")
        ahead = F.filter("edges", lambda e: (
            (u(F.greatest(e.ax, e.bx)) >= left) & (v(F.greatest(e.ay, e.by)) >= bottom) & (v(F.least(e.ay, e.by)) <= bottom + size)
        ))
        cut = cut.withColumn("ahead", ahead)
        near = F.exists("ahead", lambda e: u(F.least(e.ax, e.bx)) <= left + size)
        middle = edges_contain(F.col("ahead"), (left + size / 2) * F.lit(side) + F.lit(x0), (bottom + size / 2) * F.lit(side) + F.lit(y0))
        cut = cut.withColumns({"near": ~F.col("whole") & near, "inside": F.col("whole") | (~near & middle)}).where("near or inside")
        kept = F.when(F.col("inside"), F.slice("ahead", 1, 0)).otherwise(F.col("ahead"))
        return cut.select("key", "level", "size", "cx", "cy", kept.alias("edges"), F.col("inside").alias("whole"), "was")

    cells, leaves, level = own.withColumns(root), [], 0
    if ends["edges"] >= 64 * cell_edges:  # 16 cells would be too full on average: none is kept
        cells, level = cut_once(cells), 2
    while True:
        level += 2
        made = stored(cut_once(cells), "cells")
        front = made.where("whole").groupBy("cx", "cy").agg(lowest)
        seen = F.col("low").isNull() | (F.struct("key") <= F.col("low"))
        parent = [F.floor(F.col(c) / 4).alias(f"p{c}") for c in ("cx", "cy")]
        counts = made.join(front, ["cx", "cy"], "left").where(seen).groupBy("cx", "cy", *parent).agg(
            F.sum(F.size("edges")).alias("n"), F.max("was").alias("was"), F.min("low").alias("low")
        )
        family = counts.groupBy("pcx", "pcy").agg(F.sum("n").alias("family"), F.collect_list(F.struct("cx", "cy", "n", "was", "low")).alias("parts"))
        parted = (F.col("n") * 4 < F.col("was") * 3) | (F.col("family") < F.col("was") * 2)
        counts = family.select("family", F.inline("parts")).select("cx", "cy", "n", "low", ((F.col("n") > cell_edges) & parted).alias("full"))
        counts, found = stored_measured(counts, "cell-counts", copies=F.sum(F.when(F.col("full"), F.col("n"))))
        sized = made.drop("was").join(counts, ["cx", "cy"]).where(seen).withColumnRenamed("n", "was")
        copies = found["copies"] or 0
        if level >= MOST_LEVELS or not copies or copies > MOST_COPIES * ends["edges"]:
            leaves.append(sized.select("key", "level", "cx", "cy", "edges", "whole"))
            break
        leaves.append(sized.where("not full").select("key", "level", "cx", "cy", "edges", "whole"))
        cells = sized.where("full").select(made.columns)
    bottom, top = F.array_min(F.transform("edges", lambda e: F.least(e.ay, e.by))), F.array_max(F.transform("edges", lambda e: F.greatest(e.ay, e.by)))
    region = F.struct("key", "whole", "edges", bottom.alias("bottom"), top.alias("top"))
    return reduce(DataFrame.unionByName, leaves).groupBy("level", "cx", "cy").agg(F.array_sort(F.collect_list(region)).alias("__regions")), (x0, y0, side)


def covering_join_tree(
    points: DataFrame, lon: str, lat: str, regions: DataFrame, key: str, geometry: str, cell_edges: int = CELL_EDGES
) -> DataFrame:
    """``covering_join`` for regions of very different size and detail in one layer, such as
    continents with the blocks of their cities.

    The cells come from ``quadtree``, so their number follows the edges and not the ratio
    of the largest region to the smallest. Cells do not overlap; a point looks up its cell
    in each size in use (15 at most) and is found in one. Rules for overlaps, holes, null
    coordinates and repeated points are those of ``covering_join``.
    """
    tree, (x0, y0, side) = quadtree(regions, key, geometry, cell_edges)
    kind = regions.schema[key].dataType
    if tree is None:
        return points.limit(0).withColumn(key, F.lit(None).cast(kind))
    held = F.sum(F.aggregate("__regions", F.lit(64), lambda n, r: n + 64 + 40 * F.size(r.edges)).cast("bigint"))
    used = {f"level{n}": F.count(F.when(F.col("__level") == n, 1)) for n in range(2, MOST_LEVELS + 1, 2)}
    tree, found = stored_measured(tree.withColumnsRenamed({"level": "__level", "cx": "__cx", "cy": "__cy"}), "quadtree", held=held, **used)
    levels = [n for n in range(2, MOST_LEVELS + 1, 2) if found[f"level{n}"]]
    if (found["held"] or 0) <= BROADCAST_BYTES:
        tree = F.broadcast(tree)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    places = [
        F.struct(
            F.lit(level).alias("__level"), F.floor((x - F.lit(x0)) / F.lit(side) * F.lit(2.0**level)).alias("__cx"),
            F.floor((y - F.lit(y0)) / F.lit(side) * F.lit(2.0**level)).alias("__cy"),
        )
        for level in levels
    ]
    hits = points.select("*", F.inline(F.array(*places))).join(tree, ["__level", "__cx", "__cy"])
    # no edge is crossed below or above them all, so most regions of a cell cost two comparisons
    covers = F.filter("__regions", lambda r: r.whole | ((r.bottom <= y) & (y < r.top) & edges_contain(r.edges, x, y)))
    first = hits.select(*points.columns, F.explode(F.slice(covers, 1, 1)).alias("__r"))
    return first.select(*points.columns, F.col("__r.key").alias(key))


def covering_summary(
    points: DataFrame, lon: str, lat: str, regions: DataFrame, key: str, geometry: str,
    size: float | None = None, skip: Sequence[str] = (), mixed_sizes: bool = False,
) -> DataFrame:
    """Count, totals and averages of numeric columns per covering region, geometry attached.
    ``mixed_sizes`` takes the quadtree, for regions of very different size."""
    if mixed_sizes:
        covered = covering_join_tree(points, lon, lat, regions, key, geometry)
    else:
        covered = covering_join(points, lon, lat, regions, key, geometry, size)
    stats = summarize_all(covered, [key], skip=[lon, lat, *skip])
    return stats.join(regions.select(key, geometry), key)


def density(df: DataFrame, lon: str, lat: str, bits: int = 25) -> DataFrame:
    """Number of points per grid cell."""
    return df.groupBy(geo.geohash_bits(F.col(lon), F.col(lat), bits).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def to_geojson(df: DataFrame, geometry: str, props: Sequence[str], name: str = "feature") -> DataFrame:
    """One GeoJSON feature per row: a Polygon for one ring or a list of rings (outer ring
    first, then holes), a MultiPolygon for a list of polygons."""

    def closed(ring: Column) -> Column:
        line = F.transform(ring, lambda p: F.array(p.x, p.y))
        return F.when(F.element_at(line, 1) == F.element_at(line, -1), line).otherwise(
            F.concat(line, F.array(F.element_at(line, 1)))
        )

    depth, kind = 0, df.schema[geometry].dataType
    while isinstance(kind, T.ArrayType):
        depth, kind = depth + 1, kind.elementType
    shape = {
        1: lambda g: F.array(closed(g)),
        2: lambda g: F.transform(g, closed),
        3: lambda g: F.transform(g, lambda polygon: F.transform(polygon, closed)),
    }[depth]
    body = F.struct(
        F.lit("MultiPolygon" if depth == 3 else "Polygon").alias("type"), shape(F.col(geometry)).alias("coordinates")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"), body.alias("geometry"), F.struct(*props).alias("properties")
    )
    return df.select(*props, F.to_json(feature).alias(name))


def choropleth(features: DataFrame, stats: DataFrame, code: str, value: str, n: int) -> DataFrame:
    """Map features with their value and colour class; features without a value keep null."""
    return features.join(quantize(stats, value, n).select(code, value, "class"), code, "left")
