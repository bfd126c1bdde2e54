"""Thematic layers as declared rules, and features by layer and zoom.

A rule is tried in order; the first that holds gives the coarsest zoom and the tags it adds. All
layers of a feature come out of one expression, so features are read once whatever the layers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags as T
from ..functions.geo import MAX_ZOOM

#: Level of a feature that a layer does not take.
NO_LEVEL = -1


@dataclass(frozen=True)
class Rule:
    """key in values (any value where none are given) and all of `also` -> level, with added tags."""

    key: str
    values: tuple[str, ...] = ()
    level: int = 0
    group: str | None = None
    typed: bool = True
    also: tuple[tuple[str, tuple[str, ...]], ...] = ()
    except_: tuple[str, ...] = ()

    def holds(self, tags: Column) -> Column:
        on = T.has(tags, self.key)
        if self.values:
            on = on & tags[self.key].isin(*self.values)
        if self.except_:
            on = on & ~tags[self.key].isin(*self.except_)
        for key, values in self.also:
            on = on & (tags[key].isin(*values) if values else T.has(tags, key))
        return F.coalesce(on, F.lit(False))

    def added(self, tags: Column) -> Column:
        out = F.create_map().cast("map<string,string>")
        if self.typed:
            out = F.create_map(F.lit("type"), tags[self.key])
        if self.group:
            group = F.create_map(F.lit("stylegroup"), F.lit(self.group))
            out = F.map_concat(out, group) if self.typed else group
        return out


def _zero(tags: Column) -> Column:
    return F.lit(0)


def road_z(tags: Column) -> Column:
    """Order of roads: their layer, their kind, tunnels below and bridges above."""
    kinds = F.create_map(*(F.lit(x) for kv in ROAD_BIAS.items() for x in kv))
    bias = F.when(T.has(tags, "highway"), F.coalesce(kinds[tags["highway"]], F.lit(0))).when(T.has(tags, "railway"), 7).otherwise(0)
    on = lambda key: F.coalesce(T.truthy(tags[key]), F.lit(False)).cast("int")
    z = 10 * T.leading_int(T.value(tags, "layer")) + bias - 10 * on("tunnel") + 10 * on("bridge")
    return F.least(F.greatest(z, F.lit(-128)), F.lit(127)).cast("int")


def place_z(tags: Column) -> Column:
    """Order of places: logarithm of the population to base 1.2."""
    people = F.greatest(T.leading_int(T.value(tags, "population")), F.lit(1)).cast("double")
    return F.least(F.floor(F.ln(people) / F.ln(F.lit(1.2))), F.lit(127)).cast("int")


@dataclass(frozen=True)
class Layer:
    name: str
    area: bool
    zooms: tuple[int, ...]
    rules: tuple[Rule, ...]
    points: bool = False
    z_index: Callable[[Column], Column] = field(default=_zero)

    def level(self, tags: Column, closed: Column | bool = True) -> Column:
        """Coarsest zoom that shows a feature, NO_LEVEL for none."""
        out = F.lit(NO_LEVEL)
        for rule in reversed(self.rules):
            out = F.when(rule.holds(tags), F.lit(rule.level)).otherwise(out)
        if self.area:
            out = F.when(F.lit(closed) if isinstance(closed, bool) else closed, out).otherwise(F.lit(NO_LEVEL))
        return out

    def tags(self, tags: Column) -> Column:
        """The tags with what the layer's rule adds where absent."""
        out = tags
        for rule in reversed(self.rules):
            out = F.when(rule.holds(tags), T.filled(tags, rule.added(tags)) if rule.typed or rule.group else tags).otherwise(out)
        return out


# The kinds of features, zooms and orders of the layers.
ROAD_BIAS = {
    "minor": 3, "road": 3, "unclassified": 3, "residential": 3, "tertiary_link": 3, "tertiary": 4, "secondary_link": 3,
    "secondary": 5, "primary_link": 3, "primary": 6, "trunk_link": 3, "trunk": 8, "motorway_link": 3, "motorway": 9,
}
LANDUSES = (
    "park", "forest", "residential", "retail", "commercial", "industrial", "railway", "cemetery", "grass", "farmyard",
    "farm", "farmland", "wood", "meadow", "village_green", "recreation_ground", "allotments", "quarry",
)
LEISURES = ("park", "garden", "playground", "golf_course", "sports_centre", "pitch", "stadium", "common", "nature_reserve")
NATURALS = ("wood", "land", "island", "scrub", "wetland")
AMENITIES = (
    "university", "school", "college", "library", "fuel", "parking", "cinema", "theatre", "place_of_worship",
    "hospital", "grave_yard",
)
WATERWAYS = ("basin", "canal", "mill_pond", "pond", "riverbank", "stream")
MINOR_ROADS = (
    "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary", "tertiary_link", "residential",
    "unclassified", "road", "living_street",
)
PATHS = ("path", "cycleway", "footway", "pedestrian", "steps", "bridleway")
SMALL_RAILWAYS = ("abandoned", "tram", "disused", "subway", "narrow_gauge", "light_rail", "preserved", "monorail", "funicular")
LABELLED_MINOR = ("residential", "unclassified", "road", "living_street", "unknown")

BUILDING = Layer("building", True, (10, 11, 12, 13, 24), (
    Rule("building", except_=("no", "0", "false"), typed=False),
    Rule("railway", ("station",), typed=False),
    Rule("aeroway", ("terminal",), typed=False),
))
LANDUSE = Layer("landuse", True, (5, 7, 9, 12, 24), (
    Rule("landuse", LANDUSES),
    Rule("leisure", LEISURES),
    Rule("natural", NATURALS),
    Rule("amenity", AMENITIES),
    Rule("place", ("island", "islet"), typed=False),
    Rule("highway", ("pedestrian", "footway"), typed=False, also=(("area", ("yes",)),)),
    Rule("tourism", ("zoo",), typed=False),
    Rule("aeroway", ("aerodrome", "helipad", "apron"), typed=False),
))
LANDUSE_OVERLAY = Layer("landuseOverlay", True, (5, 7, 9, 12, 24), (Rule("leisure", ("nature_reserve", "wetland")),))
WATER = Layer("water", True, (7, 9, 13, 24), (
    Rule("natural", ("water", "pond")),
    Rule("waterway", WATERWAYS),
    Rule("landuse", ("basin", "reservoir")),
))
ROAD = Layer("road", False, (6, 9, 10, 24), (
    Rule("highway", ("motorway", "trunk"), 0, "motorway"),
    Rule("highway", ("primary", "secondary"), 7, "mainroad"),
    Rule("highway", MINOR_ROADS, 10, "minorroad"),
    Rule("highway", ("service", "track"), 12, "service"),
    Rule("highway", PATHS, 13, "noauto"),
    Rule("railway", ("rail",), 0, "railway"),
    Rule("railway", SMALL_RAILWAYS, 10, "railway"),
), z_index=road_z)
_MAJOR = ("motorway", "trunk")
ROAD_LABEL = Layer("roadLabel", False, (6, 9, 10, 24), (
    Rule("highway", _MAJOR, 0, "motorway", also=(("name", ()),)),
    Rule("highway", _MAJOR, 0, "motorway", also=(("ref", ()),)),
), z_index=road_z)
ROAD_MINOR_LABEL = Layer("roadMinorLabel", False, (6, 9, 10, 24), (
    Rule("highway", LABELLED_MINOR, 10, also=(("name", ()),)),
    Rule("highway", LABELLED_MINOR, 10, also=(("ref", ()), ("oneway", ()))),
), z_index=road_z)
BOUNDARY = Layer("boundary", False, (11, 24), (Rule("boundary", ("administrative",), typed=False, also=(("admin_level", ("1", "2", "3", "4", "5", "6")),)),))
WATERWAY = Layer("waterway", False, (9, 24), (
    Rule("waterway", ("river", "canal"), 0),
    Rule("waterway", ("stream",), 10),
    Rule("waterway", ("ditch", "drain"), 12),
    Rule("barrier", ("ditch",), 12, typed=False),
))
ADDRESS = Layer("address", False, (24,), (Rule("addr:housenumber", level=10, typed=False),), points=True)
PLACE = Layer("place", False, (24,), (Rule("place"),), points=True, z_index=place_z)

LAYERS = (BUILDING, LANDUSE, LANDUSE_OVERLAY, WATER, ROAD, ROAD_LABEL, ROAD_MINOR_LABEL, BOUNDARY, WATERWAY, ADDRESS, PLACE)
WAY_LAYERS = tuple(x for x in LAYERS if not x.points)
POINT_LAYERS = tuple(x for x in LAYERS if x.points)
BY_NAME = {x.name: x for x in LAYERS}


def classified(features: DataFrame, layers: tuple[Layer, ...] = WAY_LAYERS, closed: str | None = "closed", lod: bool = True) -> DataFrame:
    """A row for each layer that takes a feature: adds layer, area, level, zooms, z_index; tags as the
    layer adds to them. features: tags and, unless `closed` is None, that boolean column.

    Without levels of detail only the last zoom is kept.
    """
    tags = F.col("tags")
    ring = F.lit(True) if closed is None else F.col(closed)

    levels = F.array(*(F.struct(F.lit(k).alias("no"), layer.level(tags, ring).alias("level")) for k, layer in enumerate(layers)))
    rest = [c for c in features.columns if c != "tags"]
    rows = features.select(*rest, "tags", F.explode(F.filter(levels, lambda r: r["level"] >= 0)).alias("_r")).select(*rest, "tags", "_r.no", "_r.level")

    def of_layer(value) -> Column:
        """What a layer has, worked out for the rows of that layer only."""
        out = value(layers[-1])
        for k in range(len(layers) - 2, -1, -1):
            out = F.when(F.col("no") == k, value(layers[k])).otherwise(out)
        return out

    zooms = of_layer(lambda x: F.array(*map(F.lit, x.zooms if lod else (MAX_ZOOM,))))
    return rows.select(
        *rest,
        of_layer(lambda x: F.lit(x.name)).alias("layer"),
        of_layer(lambda x: F.lit(x.area)).alias("area"),
        "level",
        F.filter(zooms, lambda z: (z >= F.col("level")) | (z == MAX_ZOOM)).alias("zooms"),
        of_layer(lambda x: x.z_index(tags).cast("int")).alias("z_index"),
        of_layer(lambda x: x.tags(tags)).alias("tags"),
    )


def by_zoom(classified_: DataFrame) -> DataFrame:
    """A row for each zoom that shows the feature."""
    return classified_.withColumn("zoom", F.explode("zooms")).drop("zooms")
