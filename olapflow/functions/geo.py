"""Points, boxes, rings and grid cells as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the geohash alphabet
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def point(lon: Column, lat: Column) -> Column:
    """Struct (x, y); null for missing or impossible coordinates."""
    fits = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return F.when(fits, F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y")))


def in_bbox(lon: Column, lat: Column, minx: float, miny: float, maxx: float, maxy: float) -> Column:
    """Inside a box, edges included. Plain column ranges, so the file scan can skip blocks."""
    return lon.between(minx, maxx) & lat.between(miny, maxy)


def ring_contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring (array of x, y structs, open or closed) encloses a point.

    Counts the edges a ray to the right crosses; an odd number means inside.
    """
    n = F.size(ring)

    def crossings(acc, i):
        a = F.element_at(ring, i)
        b = F.element_at(ring, F.pmod(i, n) + 1)
        spans = (a.y > y) != (b.y > y)
        at = (b.x - a.x) * (y - a.y) / (b.y - a.y) + a.x
        return acc + F.when(spans, F.when(x < at, 1).otherwise(0)).otherwise(0)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), crossings), F.lit(2)) == 1


def edge_boxes_touch(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether the bounding box of any edge of the ring touches a box."""
    n = F.size(ring)

    def touches(i):
        a = F.element_at(ring, i)
        b = F.element_at(ring, F.pmod(i, n) + 1)
        return (
            (F.least(a.x, b.x) <= x1)
            & (F.greatest(a.x, b.x) >= x0)
            & (F.least(a.y, b.y) <= y1)
            & (F.greatest(a.y, b.y) >= y0)
        )

    return F.exists(F.sequence(F.lit(1), n), touches)


def geohash_bits(lon: Column, lat: Column, bits: int = 25) -> Column:
    """Interleaved cell number of ``bits`` bits, longitude first (25 = 13 lon + 12 lat)."""
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def index(value, low, span, width):
        cells = 1 << width
        return F.least(F.floor((value - low) * (cells / span)), F.lit(cells - 1)).cast("bigint")

    cell = {"lon": index(lon, -180.0, 360.0, lon_bits), "lat": index(lat, -90.0, 180.0, lat_bits)}
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        axis, width = ("lon", lon_bits) if i % 2 == 0 else ("lat", lat_bits)
        bit = F.shiftright(cell[axis], width - 1 - i // 2).bitwiseAND(F.lit(1))
        out = out.bitwiseOR(F.shiftleft(bit, bits - 1 - i))
    return out


def geohash_text(cell: Column, bits: int = 25) -> Column:
    """Base-32 text of a cell number whose bits are a multiple of five."""
    digits = [
        F.substring(F.lit(GEOHASH_DIGITS), F.shiftright(cell, shift).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
        for shift in range(bits - 5, -1, -5)
    ]
    return F.concat(*digits)
