"""Layer rules, orders and zooms against known values."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import layers as L


def tags_of(kv):
    return F.create_map(*(F.lit(x) for p in kv.items() for x in p)) if kv else F.create_map().cast("map<string,string>")


def level(spark, layer, kv, closed=True):
    return spark.range(1).select(layer.level(tags_of(kv), closed).alias("v")).first().v


@pytest.mark.parametrize(
    "kv,want",
    [
        ({"highway": "motorway"}, 0), ({"highway": "primary"}, 7), ({"highway": "residential"}, 10), ({"highway": "service"}, 12),
        ({"highway": "steps"}, 13), ({"highway": "proposed"}, -1), ({"highway": "proposed", "railway": "rail"}, 0), ({"railway": "tram"}, 10), ({}, -1),
    ],
)
def test_road_levels(spark, kv, want):
    assert level(spark, L.ROAD, kv) == want


@pytest.mark.parametrize("kv,z", [({"highway": "motorway"}, 9), ({"highway": "primary", "layer": "-1", "tunnel": "yes"}, -14), ({"railway": "rail", "bridge": "yes"}, 17), ({"layer": "20"}, 127), ({"layer": "-20"}, -128), ({"highway": "x", "railway": "rail"}, 0)])
def test_road_z(spark, kv, z):
    assert spark.range(1).select(L.road_z(tags_of(kv)).alias("z")).first().z == z


@pytest.mark.parametrize("people,z", [("0", 0), ("1", 0), ("2", 3), ("1000000", 75), ("2000000000", 117), ("99999999999999", 127), ("many", 0)])
def test_place_z(spark, people, z):
    assert spark.range(1).select(L.place_z(tags_of({"population": people})).alias("z")).first().z == z


@pytest.mark.parametrize(
    "kv,zooms",
    [({"highway": "primary"}, [9, 10, 24]), ({"highway": "residential"}, [10, 24]), ({"highway": "service"}, [24]), ({"highway": "motorway"}, [6, 9, 10, 24])],
)
def test_road_zooms(spark, kv, zooms):
    rows = spark.range(1).select("id", tags_of(kv).alias("tags"), F.lit(False).alias("closed"))
    assert L.classified(rows, (L.ROAD,)).first().zooms == zooms
    assert L.classified(rows, (L.ROAD,), lod=False).first().zooms == [24]


def test_waterway_zooms(spark):
    for kind, zooms in (("stream", [24]), ("river", [9, 24])):
        rows = spark.range(1).select("id", tags_of({"waterway": kind}).alias("tags"), F.lit(False).alias("closed"))
        assert L.classified(rows, (L.WATERWAY,)).first().zooms == zooms


def test_areas_need_rings_and_types_fill_in(spark):
    assert level(spark, L.BUILDING, {"building": "yes"}, False) == -1
    assert level(spark, L.BUILDING, {"building": "no"}) == -1
    assert level(spark, L.BUILDING, {"building": "no", "railway": "station"}) == 0
    rows = spark.range(1).select("id", tags_of({"landuse": "forest", "type": "own"}).alias("tags"), F.lit(True).alias("closed"))
    assert L.classified(rows, (L.LANDUSE,)).first().tags["type"] == "own"
    rows = spark.range(1).select("id", tags_of({"highway": "primary", "landuse": "forest"}).alias("tags"), F.lit(True).alias("closed"))
    found = {r.layer: r.tags for r in L.classified(rows).collect()}
    assert found["landuse"]["type"] == "forest" and found["road"]["type"] == "primary" and found["road"]["stylegroup"] == "mainroad"


def test_labels(spark):
    assert level(spark, L.ROAD_LABEL, {"highway": "trunk", "ref": "1"}) == 0
    assert level(spark, L.ROAD_LABEL, {"highway": "trunk"}) == -1
    assert level(spark, L.ROAD_MINOR_LABEL, {"highway": "road", "ref": "1"}) == -1
    assert level(spark, L.ROAD_MINOR_LABEL, {"highway": "road", "ref": "1", "oneway": "no"}) == 10


def test_null_tags_are_in_no_layer(spark):
    rows = spark.createDataFrame([(1, None, True)], "id long, tags map<string,string>, closed boolean")
    assert L.classified(rows).count() == 0
