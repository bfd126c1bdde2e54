"""Multipolygons of relations: rings in Arrow batches of relations, tags by expressions.

Rings are assembled, healed, joined where they touch or overlap, ordered by what contains what, and
flattened to outer rings with holes. Coordinates are (lat, lng) while rings are built and projected
to (x, y) on the way out; outer rings run counter-clockwise there, holes clockwise.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tags as T
from ..functions.geo import mercator_x, mercator_y
from . import overlay, resolve
from .rings import assemble

#: What a union may lose of its area by rounding.
_KEPT_AREA = 0.99999999999999


@dataclass
class Ring:
    points: list
    ways: list[int]
    holes: list[Ring] = field(default_factory=list)

    @property
    def area(self) -> float:
        return overlay.area(self.points)

    def key(self) -> tuple:
        """Largest first, then by ways and place: the same order whatever the input's."""
        return -self.area, sorted(self.ways), min(self.points)


def merge(a: Ring, b: Ring, how: overlay.Relation) -> list[Ring] | None:
    """One from two that touch: the rest where one holds the other, else both; None if not one piece."""
    if how.within:
        found = overlay.difference(b.points, a.points)
    elif how.contains:
        found = overlay.difference(a.points, b.points)
    else:
        found = overlay.union(a.points, b.points)
        if sum(overlay.signed_area(r) > 0 for r in found) != 1:
            return None
    ways = list(dict.fromkeys([*a.ways, *b.ways]))
    return [Ring(r, list(ways)) for r in found if overlay.signed_area(r) != 0]


def meeting(rings: list[Ring]) -> list[tuple[int, int]]:
    """Pairs of rings (by place) whose bounds meet, from an order by their left ends."""
    if len(rings) < 2:
        return []
    box = np.array([[f(float(p[k]) for p in r.points) for k in (0, 1) for f in (min, max)] for r in rings])
    order = np.argsort(box[:, 0], kind="stable")
    box = box[order]
    last = np.searchsorted(box[:, 0], box[:, 1], "right")
    out = []
    for k in range(len(rings)):
        near = box[k + 1 : last[k]]
        for m in np.flatnonzero((near[:, 2] <= box[k, 3]) & (near[:, 3] >= box[k, 2])):
            out.append((int(order[k]), int(order[k + 1 + m])))
    return out


def parts(n: int, pairs: list[tuple[int, int]]) -> list[list[int]]:
    """Places that pairs connect, in order."""
    root = list(range(n))

    def top(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for a, b in pairs:
        root[top(a)] = top(b)
    out: dict[int, list[int]] = {}
    for i in range(n):
        out.setdefault(top(i), []).append(i)
    return list(out.values())


def united(group: list[Ring]) -> tuple[list[Ring], list[str]]:
    """A group that overlaps or shares edges as rings that do not, largest first, and what could not be done.

    Each ring settles against those settled before it; where it touches one, both make way for what
    they are together.
    """
    todo = [(r.key(), k, r) for k, r in enumerate(group)]
    heapify(todo)
    settled: list[Ring] = []
    warnings, apart, count = [], set(), len(todo)
    while todo:
        _, _, ring = heappop(todo)
        for other in settled:
            if (id(other), id(ring)) in apart or not overlay.boxes_meet(other.points, ring.points):
                continue
            how = overlay.Relation(other.points, ring.points)
            if how.equal:
                other.ways = list(dict.fromkeys([*other.ways, *ring.ways]))
                warnings.append(f"identical rings of ways {other.ways}")
                break
            if not (how.overlap or how.shared_edge):
                continue
            if (both := merge(other, ring, how)) is None:
                apart.add((id(other), id(ring)))
                warnings.append(f"rings of ways {other.ways} and {ring.ways} have no single union")
                continue
            settled.remove(other)
            for new in both:
                heappush(todo, (new.key(), count := count + 1, new))
            break
        else:
            settled.append(ring)
    return settled, warnings


def join_adjacent(rings: list[Ring]) -> tuple[list[Ring], list[str]]:
    """Rings of which none overlap or share an edge: those that do are found at once, each connected
    group of them is united by itself."""
    touching = []
    for a, b in meeting(rings):
        how = overlay.Relation(rings[a].points, rings[b].points)
        if how.overlap or how.shared_edge or how.equal:
            touching.append((a, b))
    out, warnings = [], []
    for group in parts(len(rings), touching):
        own, more = united([rings[k] for k in group]) if len(group) > 1 else ([rings[group[0]]], [])
        out += own
        warnings += more
    return out, warnings


def polygons(rings: list[Ring]) -> list[Ring]:
    """Rings at even depth as outer rings, those directly inside them as their holes.

    The least ring that holds another is its parent. A ring that barely reaches out of another is
    taken into it instead.
    """
    order = sorted(rings, key=Ring.key)
    near: dict[int, list[int]] = {}
    for a, b in meeting(order):
        near.setdefault(max(a, b), []).append(min(a, b))
    depth: dict[int, int] = {}
    out = []
    for k, ring in enumerate(order):
        parent = None
        for m in sorted(near.get(k, ()), reverse=True):  # the smallest first
            if m not in depth:
                continue
            how = overlay.Relation(order[m].points, ring.points)
            if how.contains:
                parent = m
                break
            if how.both and (whole := _taken_in(order[m], ring)):
                order[m].points = whole
                order[m].ways = list(dict.fromkeys([*order[m].ways, *ring.ways]))
                break
        else:
            depth[k] = 0
            out.append(ring)
        if parent is not None:
            depth[k] = depth[parent] + 1
            (order[parent].holes if depth[k] % 2 else out).append(ring)
    return out


def _taken_in(large: Ring, small: Ring) -> list | None:
    """The outer ring of both, where there is one that keeps the larger's area."""
    outer = [r for r in overlay.union(large.points, small.points) if overlay.signed_area(r) > 0]
    return outer[0] if len(outer) == 1 and overlay.area(outer[0]) >= large.area * _KEPT_AREA else None


def build(ways: list[tuple[int, list[tuple[int, int]]]], close_gaps: bool = True) -> tuple[list[Ring], list[str]]:
    """Outer rings with holes of (way id, positions) in member order, and what went wrong."""
    segments, open_ends = assemble(ways, close_gaps)
    warnings = [f"open ends at {open_ends}"] if open_ends else []
    rings = []
    for s in segments:
        rings += [Ring(p, list(s.ways)) for p in (overlay.counter_clockwise(r) for r in overlay.healed(s.points))]
    rings, more = join_adjacent(rings)
    return polygons(rings), warnings + more


OUT = "rel_id bigint, poly_no int, lines array<array<struct<a:int,b:int>>>, way_ids array<bigint>, warnings array<string>"


def _rounded(points: list, first: bool) -> list[dict]:
    """Whole positions in order, an outer ring or a hole: (lat, lng) runs against (lng, lat)."""
    ccw = overlay.counter_clockwise(points)
    return [{"a": round(a), "b": round(b)} for a, b in (ccw[::-1] if first else ccw)]


_PLACES = pa.list_(pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))


def assemble_relations(copies: DataFrame) -> DataFrame:
    """Rings of way copies (rel_id, pos, way_id, refs): OUT, poly_no -1 where nothing but warnings came.

    A relation's ways meet in one row; rows go to Python in batches of many relations.
    """
    located = F.filter("refs", lambda r: r["lat"].isNotNull())
    points = F.transform(located, lambda r: F.struct(r["lat"].alias("a"), r["lng"].alias("b")))
    ways = F.sort_array(F.collect_list(F.struct("pos", "way_id", points.alias("points")))).alias("ways")

    def run(batches):
        for batch in batches:
            rows = []
            for rel_id, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, warnings_ = build([(w["way_id"], [(p["a"], p["b"]) for p in w["points"]]) for w in own])
                rows += [(rel_id, k, [_rounded(r.points, True), *(_rounded(h.points, False) for h in r.holes)], r.ways, warnings_ if not k else []) for k, r in enumerate(found)]
                if not found and warnings_:
                    rows.append((rel_id, -1, [], [], warnings_))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), _PLACES, pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["rel_id", "poly_no", "lines", "way_ids", "warnings"])

    return copies.groupBy("rel_id").agg(ways).mapInArrow(run, OUT)


def resolved_tags(polygons_: DataFrame, relations: DataFrame, members: DataFrame, ways: DataFrame) -> DataFrame:
    """polygons (rel_id, poly_no, way_ids, …) with the tags that fit best.

    The relation's own; else those of the only way; else of the only member with role outer; else
    what all ways agree on. Ways are joined once, for polygons whose relation has no tags of its own.
    Whole tables of ways and relations are merged: the size of their files says little of that of
    maps in memory, so none is broadcast by it.
    """
    own = relations.select(F.col("id").alias("rel_id"), T.without(F.col("tags"), "type").alias("own")).hint("merge")
    found = members.where("type = 'WAY'").join(ways.select(F.col("id").alias("ref")).hint("merge"), "ref", "left_semi")
    outer = resolve.unique_outer(resolve.first_members(found)).where("outer_ref IS NOT NULL").select("rel_id", "outer_ref")
    shapes = polygons_.join(own, "rel_id", "left").join(outer, "rel_id", "left")
    has_own = F.coalesce(F.size("own") > 0, F.lit(False))
    # The outer member comes after the ways, at the place that is their number.
    n_ways, way_ids = F.size("way_ids"), F.col("way_ids")
    needed = F.when(F.col("outer_ref").isNull() | (n_ways == 1), way_ids).otherwise(F.concat(way_ids, F.array("outer_ref")))
    ids = shapes.where(~has_own).select("rel_id", "poly_no", F.posexplode(needed).alias("k", "way_id"))
    wt = ways.select(F.col("id").alias("way_id"), F.map_entries("tags").alias("e")).hint("merge")
    grouped = ids.join(wt, "way_id").groupBy("rel_id", "poly_no").agg(F.sort_array(F.collect_list(F.struct("k", "e"))).alias("es"))
    joined = shapes.join(grouped, ["rel_id", "poly_no"], "left")
    maps = F.transform(F.filter("es", lambda s: s["k"] < n_ways), lambda s: F.map_from_entries(s["e"]))
    outer_tags = F.map_from_entries(F.try_element_at(F.filter("es", lambda s: s["k"] == n_ways), F.lit(1))["e"])
    empty = F.create_map().cast("map<string,string>")
    tags = (
        F.when(has_own, F.col("own"))
        .when(n_ways == 1, F.try_element_at(maps, F.lit(1)))
        .when(F.size(outer_tags) > 0, outer_tags)
        .otherwise(T.in_all(maps))
    )
    return joined.withColumn("tags", F.coalesce(tags, empty)).drop("own", "outer_ref", "es")


def tagged(built: DataFrame, relations: DataFrame, members: DataFrame, ways: DataFrame) -> DataFrame:
    """schemas.MULTIPOLYGONS of assembled rings, in (x, y)."""
    out = resolved_tags(built.where("poly_no >= 0"), relations, members, ways)
    rings = F.transform("lines", lambda r: F.transform(r, lambda p: F.struct(mercator_x(p["b"]).alias("x"), mercator_y(p["a"]).alias("y"))))
    return out.select("rel_id", "poly_no", rings.alias("rings"), "way_ids", "tags")


def multipolygons(copies: DataFrame, relations: DataFrame, members: DataFrame, ways: DataFrame) -> DataFrame:
    """schemas.MULTIPOLYGONS of way copies."""
    return tagged(assemble_relations(copies), relations, members, ways)


def warnings(built: DataFrame) -> DataFrame:
    """(rel_id, warning): open ends, identical rings and unions that failed."""
    return built.select("rel_id", F.explode("warnings").alias("warning"))


def open_ends(copies: DataFrame) -> DataFrame:
    """(rel_id, lat, lng) where an odd number of a relation's ways end that do not close themselves."""
    located = F.filter("refs", lambda r: r["lat"].isNotNull())
    ways = copies.dropDuplicates(["rel_id", "way_id"]).select("rel_id", located.alias("refs")).where(F.size("refs") > 0)
    place = lambda r: F.struct(r["lat"].alias("lat"), r["lng"].alias("lng"))
    both = ways.select("rel_id", F.explode(F.array(place(F.get("refs", F.lit(0))), place(F.element_at("refs", -1)))).alias("p"))
    return both.groupBy("rel_id", "p.lat", "p.lng").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("rel_id", "lat", "lng")


def nearest_ends(copies: DataFrame) -> DataFrame:
    """(rel_id, distance): of the closest two open ends of a relation, in whole units; ends meet by an
    equality join on the relation."""
    ends = open_ends(copies)
    a, b = ends.alias("a"), ends.alias("b")
    before = (F.col("a.lat") < F.col("b.lat")) | ((F.col("a.lat") == F.col("b.lat")) & (F.col("a.lng") < F.col("b.lng")))
    pairs = a.join(b, (F.col("a.rel_id") == F.col("b.rel_id")) & before)
    squared = F.pow(F.col("a.lat").cast("double") - F.col("b.lat"), 2) + F.pow(F.col("a.lng").cast("double") - F.col("b.lng"), 2)
    return pairs.groupBy(F.col("a.rel_id").alias("rel_id")).agg(F.round(F.min(F.sqrt(squared))).cast("bigint").alias("distance"))
