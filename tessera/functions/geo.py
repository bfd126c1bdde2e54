"""Geometry that expressions can do: projection, bounds, area, pixels, cells, sizes."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Half the world's width in centimetres, and degrees of one unit.
HALF_WORLD = 2003750834
DEGREE = 1e-7
MAX_ZOOM = 24


def in_range(lat: Column, lng: Column) -> Column:
    """Whether a position can be projected."""
    return lat.between(-900_000_000, 900_000_000) & lng.between(-1_800_000_000, 1_800_000_000)


def mercator_x(lng: Column) -> Column:
    return (lng.cast("double") * DEGREE / 180.0 * float(HALF_WORLD)).cast("int")


def mercator_y(lat: Column) -> Column:
    """Clamped to the square world before it becomes a whole number."""
    y = F.ln(F.tan((F.lit(90.0) + lat.cast("double") * DEGREE) * (math.pi / 360.0))) / math.pi * float(HALF_WORLD)
    return F.least(F.greatest(y, F.lit(float(-HALF_WORLD))), F.lit(float(HALF_WORLD))).cast("int")


def project(refs: Column) -> Column:
    """(x, y) of an array of positions; those not located, or out of range, are left out."""
    located = F.filter(refs, lambda r: r["lat"].isNotNull() & r["lng"].isNotNull() & in_range(r["lat"], r["lng"]))
    return F.transform(located, lambda r: F.struct(mercator_x(r["lng"]).alias("x"), mercator_y(r["lat"]).alias("y")))


def is_closed(points: Column, a: str = "lat", b: str = "lng") -> Column:
    """More than three positions, the first and the last the same by coordinate."""
    first, last = F.try_element_at(points, F.lit(1)), F.try_element_at(points, F.lit(-1))
    return F.coalesce((F.size(points) > 3) & (first[a] == last[a]) & (first[b] == last[b]), F.lit(False))


def bounds(points: Column) -> Column:
    """(xmin, xmax, ymin, ymax) of an array of points, null where it is empty."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    box = F.struct(F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"), F.array_min(ys).alias("ymin"), F.array_max(ys).alias("ymax"))
    return F.when(F.size(points) > 0, box)


def ring_area(points: Column) -> Column:
    """Area by the shoelace formula in doubles, 0 for a ring that is not closed."""
    after = F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    before = F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0)))
    double = lambda c: c.cast("double")
    cross = F.zip_with(before, after, lambda p, q: double(p["x"]) * double(q["y"]) - double(q["x"]) * double(p["y"]))
    return F.when(is_closed(points, "x", "y"), F.abs(F.aggregate(cross, F.lit(0.0), lambda a, c: a + c)) / 2.0).otherwise(F.lit(0.0))


def overlaps(a: Column, b: Column) -> Column:
    """Whether two bounds share a point, edges included; null bounds share none."""
    return F.coalesce((a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"]), F.lit(False))


def contains(a: Column, b: Column) -> Column:
    """Whether the first bounds hold the second."""
    return F.coalesce((a["xmin"] <= b["xmin"]) & (a["xmax"] >= b["xmax"]) & (a["ymin"] <= b["ymin"]) & (a["ymax"] >= b["ymax"]), F.lit(False))


def valid(box: Column) -> Column:
    return F.coalesce((box["xmin"] <= box["xmax"]) & (box["ymin"] <= box["ymax"]), F.lit(False))


def diagonal(box: Column) -> Column:
    width, height = (box[f"{c}max"].cast("double") - box[f"{c}min"].cast("double") for c in "xy")
    return F.sqrt(width * width + height * height)


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = ax.cast("double") - bx.cast("double"), ay.cast("double") - by.cast("double")
    return F.sqrt(dx * dx + dy * dy)


def square(c: Column) -> Column:
    """To the power of 2 by the C library, as SQL's power is. It is off by a last digit now and then, where
    c * c is not; after rounding to whole units that shows."""

    @F.arrow_udf("double")
    def power(values: pa.Array) -> pa.Array:
        return pc.power(values, 2.0)

    return power(c)


def line_distance_squared(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column, square: Callable[[Column], Column] = lambda c: c * c) -> Column:
    """Squared distance of p to the line through a and b, to a where these are one point."""
    px, py, ax, ay, bx, by = (c.cast("double") for c in (px, py, ax, ay, bx, by))
    cross = (bx - ax) * (ay - py) - (ax - px) * (by - ay)
    length = square(bx - ax) + square(by - ay)
    return F.when(length == 0, square(px - ax) + square(py - ay)).otherwise(square(cross) / length)


def pixel(zoom: int | Column) -> Column | float:
    """Width of a pixel at a zoom, in centimetres."""
    return 2.0 * HALF_WORLD / (256 * 2**zoom) if isinstance(zoom, int) else F.lit(2.0 * HALF_WORLD) / (F.lit(256.0) * F.pow(F.lit(2.0), zoom))


def varuint_size(n: Column) -> Column:
    """Bytes of an unsigned number at seven bits a byte, one at least."""
    return F.ceil(F.length(F.bin(n)) / F.lit(7.0)).cast("int")


def degrees(text: Column) -> Column:
    """Whole 1e-7 degrees of a decimal text, null where it is none."""
    return (text.try_cast("decimal(12,7)") * 10_000_000).try_cast("int")


def geometry_bytes(points: Column, tags: Column) -> Column:
    """What a feature weighs: its points, its tags and a header."""
    text = F.aggregate(F.map_entries(F.coalesce(tags, F.create_map().cast("map<string,string>"))), F.lit(0), lambda a, e: a + F.octet_length(e["key"]) + F.octet_length(e["value"]) + 2)
    return (F.lit(16) + 8 * F.size(points) + text).cast("bigint")
