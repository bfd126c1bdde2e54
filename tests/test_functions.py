"""Expressions and codecs against known values."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import codec, geo
from tessera.functions import tags as T


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def tag_map(**kv):
    return F.create_map(*(F.lit(x) for p in kv.items() for x in p)) if kv else F.create_map().cast("map<string,string>")


@pytest.mark.parametrize("n,hexed", [(0, "00"), (127, "7f"), (128, "8001"), (300, "ac02")])
def test_varuint(n, hexed):
    assert codec.write_varuint(n).hex() == hexed
    assert codec.read_varuint(bytes.fromhex(hexed)) == (n, len(hexed) // 2)


@pytest.mark.parametrize("n,hexed", [(0, "00"), (1, "01"), (-1, "41"), (63, "3f"), (64, "8001"), (-64, "c001"), (-65, "c101"), (-(2**63), "c0808080808080808002")])
def test_varint(n, hexed):
    assert codec.write_varint(n).hex() == hexed
    assert codec.read_varint(bytes.fromhex(hexed)) == (n, len(hexed) // 2)


@given(st.integers(-(2**63), 2**63 - 1), st.lists(st.tuples(st.text("abcé", max_size=4), st.text("xy", max_size=3))))
def test_codecs_round_trip(n, tags):
    assert codec.read_varint(codec.write_varint(n))[0] == n
    assert codec.unzigzag(codec.zigzag(n)) == n
    assert codec.read_tags(codec.write_tags(tags, ["ab", "xy"]), ["ab", "xy"]) == tags


@pytest.mark.parametrize(
    "lat,lng,x,y",
    [(0, 0, 0, 0), (525200000, 134050000, 149223777, 689469980), (-338688000, 1512093000, 1683254227, -401119864), (850511288, 1800000000, 2003750834, 2003750834), (865000000, 0, 0, 2003750834)],
)
def test_mercator(spark, lat, lng, x, y):
    row = one(spark, geo.mercator_x(F.lit(lng)).alias("x"), geo.mercator_y(F.lit(lat)).alias("y"))
    assert (row.x, row.y) == (x, y)


@pytest.mark.parametrize("zoom,width", [(5, 489196.981), (6, 244598.490), (7, 122299.245), (9, 30574.811), (10, 15287.406), (11, 7643.703), (12, 3821.851), (13, 1910.926), (24, 0.933)])
def test_pixel(zoom, width):
    assert geo.pixel(zoom) == pytest.approx(width, abs=1e-3)


def test_parsing(spark):
    level = lambda s: T.digits_or(F.lit(s), 65535)
    row = one(spark, *(level(s).alias(f"a{i}") for i, s in enumerate(["", "4", "4;5", "-1"])))
    assert tuple(row) == (0, 4, 65535, 65535)
    row = one(spark, *(T.leading_int(F.lit(s)).alias(f"a{i}") for i, s in enumerate(["-1", "2;3", "x", " 7", ""])))
    assert tuple(row) == (-1, 2, 0, 7, 0)
    row = one(spark, *(geo.degrees(F.lit(s)).alias(f"a{i}") for i, s in enumerate(["52.52", "-12.5", "0", "x", "180"])))
    assert tuple(row) == (525200000, -125000000, 0, None, 1800000000)


def test_varuint_size(spark):
    row = one(spark, *(geo.varuint_size(F.lit(n)).alias(f"a{i}") for i, n in enumerate([0, 127, 128, 300, 2**63 - 1])))
    assert tuple(row) == (1, 1, 2, 2, 9)


def test_blacklist(spark):
    tags = F.create_map(*(F.lit(x) for x in ("tiger:x", "1", "highway", "road", "source", "s", "NHD_id", "2", "sourced", "y")))
    assert one(spark, T.kept(tags).alias("t")).t == {"highway": "road", "sourced": "y"}


def test_boundary_fold(spark):
    rels = F.array(tag_map(admin_level="8", name="C", type="boundary"), tag_map(admin_level="2", name="A"), tag_map(admin_level="4", name="B", x="1"))
    out = one(spark, T.with_boundaries(tag_map(highway="road"), rels).alias("t")).t
    assert out == {"highway": "road", "name": "A", "x": "1", "admin_level": "2"}


def test_boundary_without_level_only_ties(spark):
    out = one(spark, T.with_boundaries(tag_map(name="own", admin_level="3"), F.array(tag_map(name="rel", extra="e"))).alias("t")).t
    assert out == {"name": "own", "admin_level": "3", "extra": "e"}
    out = one(spark, T.with_boundaries(tag_map(name="own"), F.array(tag_map(name="rel"))).alias("t")).t
    assert out == {"name": "rel"}


def test_intersection_and_union(spark):
    maps = F.array(tag_map(a="1", b="2"), tag_map(a="1", b="3"), tag_map(a="1"))
    row = one(spark, T.in_all(maps).alias("i"), T.filled(tag_map(a="1"), tag_map(a="2", b="3")).alias("f"), T.overwritten(tag_map(a="1"), tag_map(a="2", b="3")).alias("o"))
    assert row.i == {"a": "1"}
    assert row.f == {"a": "1", "b": "3"}
    assert row.o == {"a": "2", "b": "3"}


def test_first_of_repeated_keys_wins(spark):
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in (("a", "1"), ("b", "2"), ("a", "3"))))
    assert one(spark, T.from_pairs(pairs).alias("t")).t == {"a": "1", "b": "2"}


def test_closed_needs_four(spark):
    ring = lambda *xs: F.array(*(F.struct(F.lit(x).alias("lat"), F.lit(0).alias("lng")) for x in xs))
    row = one(spark, geo.is_closed(ring(1, 2, 1)).alias("a"), geo.is_closed(ring(1, 2, 3, 1)).alias("b"), geo.is_closed(ring(1, 2, 3, 4)).alias("c"))
    assert tuple(row) == (False, True, False)


def test_bounds_of_nothing(spark):
    none = F.array().cast("array<struct<x:int,y:int>>")
    row = one(spark, geo.bounds(none).alias("b"), geo.valid(geo.bounds(none)).alias("v"), geo.ring_area(none).alias("a"))
    assert row.b is None and row.v is False and row.a == 0


def test_what_ingest_drops(spark):
    from tessera.functions import tags as T

    keys = ["start_date", "Ortskennzahl", "Canadian database by Natural Resources Canada. x", "onkz", "odbl", "canvec:a", "statscan:rbuid", "name"]
    assert [r.k for r in spark.createDataFrame([(k,) for k in keys], "k string").where(~T.dropped(F.col("k"))).collect()] == [*keys[:3], "name"]
    assert len(set(T.DROPPED_KEYS)) == 71 and len(set(T.DROPPED_PREFIXES)) == 67
