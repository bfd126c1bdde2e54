"""The catalogue against its SQL, and files to tiles in one go."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators import multipolygon, quadtree, remap, tools
from tessera.plans import pipeline
from tessera.plans.catalogue import ORACLES, QUERIES
from tessera.sources import pbf

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    rel = db.sql(ORACLES[name])
    assert sorted(rel.columns) == names
    place = [rel.columns.index(c) for c in names]
    assert got == sorted((tuple(r[i] for i in place) for r in rel.fetchall()), key=repr)


def test_line_distance_squares_as_sql_does(spark, tmp_path):
    """Ways whose distance lies near a half: of c * c and the C library's power one rounds down, one up."""
    ways = {386611: [54439, 56209], 967827: [139883, 130906], 1264579: [176832, 172530, 175130], 2151225: [285140, 287291, 298214], 2259600: [303375, 305561, 301045, 310631, 306407], 2271606: [303658, 316863, 302636, 307716, 301161, 319793, 319757]}
    con = duckdb.connect()
    lines = ", ".join(f"({way}::bigint, {part}::bigint, {k})" for way, parts in ways.items() for k, part in enumerate(parts))
    con.execute(f"CREATE TABLE lineitem AS SELECT * FROM (VALUES {lines}) t(l_orderkey, l_partkey, l_linenumber)")
    con.execute("CREATE TABLE orders AS SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem")
    con.execute("CREATE TABLE part AS SELECT DISTINCT l_partkey AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size FROM lineitem")
    for t in ("lineitem", "orders", "part"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    got = {r.way_id: r.d2 for r in QUERIES["line_distance"](spark, str(tmp_path)).collect()}
    assert len(got) == len(ways) and got == dict(con.execute(ORACLES["line_distance"]).fetchall())


def broadcast_types(df) -> list[str]:
    """Types of what the plan broadcasts before anything is measured."""
    found, todo = [], [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "BroadcastHashJoin":
            found.append(node.buildPlan().schema().simpleString())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_tags_are_not_broadcast_by_the_size_of_files(spark, sf_dir):
    """Maps of tags take far more space than the files that they are made from."""
    types = broadcast_types(QUERIES["multipolygon_tags"](spark, sf_dir))
    assert [t for t in types if "map<" in t or "array<" in t] == []
    assert "struct<ref:bigint>" not in types


def test_tags_of_a_multipolygon_by_their_order(spark):
    a, b, c, d = ({"k": "a", "x": "1"}, {"k": "b", "x": "1"}, {"k": "c", "x": "1"}, {})
    ways = spark.createDataFrame([(1, a), (2, b), (3, c), (4, d)], "id long, tags map<string,string>")
    cases = {  # relation: own tags, ways of its polygon, members, what comes of them
        10: ({"type": "multipolygon", "own": "1"}, [1, 2], [(1, "outer"), (2, "inner")], {"own": "1"}),
        11: ({"type": "multipolygon"}, [2], [(1, "outer"), (2, "inner")], b),
        12: ({"type": "multipolygon"}, [1, 2], [(1, "inner"), (2, "outer")], b),
        13: ({"type": "multipolygon"}, [1, 2], [(3, "outer"), (1, "inner"), (2, "inner")], c),  # none of the polygon's
        14: ({"type": "multipolygon"}, [1, 2], [(1, "outer"), (2, "outer")], {"x": "1"}),
        15: ({"type": "multipolygon"}, [1, 2], [(1, "inner"), (2, "inner"), (4, "outer")], {"x": "1"}),  # the outer one has none
        16: ({"type": "multipolygon"}, [1, 2], [(2, "outer"), (9, "outer"), (1, "inner")], b),  # 9 is missing
        17: ({"type": "multipolygon"}, [1, 4], [(1, "outer"), (4, "outer")], {}),
        18: ({"type": "multipolygon"}, [9], [(9, "outer")], {}),
        19: ({"type": "multipolygon"}, [1, 2], [(1, "inner"), (2, "outer"), (1, "outer")], b),  # the first of repeated ones counts
        20: ({"type": "multipolygon"}, [], [(3, "outer")], c),
        21: (None, [1, 2], [(1, "outer"), (2, "outer")], {"x": "1"}),  # no such relation
    }
    shapes = spark.createDataFrame([(r, 0, w, "kept") for r, (_, w, _, _) in cases.items()], "rel_id long, poly_no int, way_ids array<long>, more string")
    relations = spark.createDataFrame([(r, t) for r, (t, *_) in cases.items() if t], "id long, tags map<string,string>")
    members = spark.createDataFrame([(r, k, "WAY", ref, role) for r, (_, _, m, _) in cases.items() for k, (ref, role) in enumerate(m)], "rel_id long, pos int, type string, ref long, role string")
    out = multipolygon.resolved_tags(shapes, relations, members, ways)
    assert out.columns == ["rel_id", "poly_no", "way_ids", "more", "tags"]
    assert {r.rel_id: r.tags for r in out.collect()} == {r: want for r, (*_, want) in cases.items()}


def world() -> bytes:
    """A square of two ways with a hole, a road, a boundary, a place, and ways that lack nodes."""
    w = pbf.PbfWriter()
    for i, (lat, lng) in enumerate([(0, 0), (0, 10), (10, 10), (10, 0), (3, 3), (3, 6), (6, 6), (6, 3)]):
        w.node(100 + i, lat * 10_000_000, lng * 10_000_000, {"place": "town", "population": "5000", "created_by": "x"} if i == 0 else None)
    w.way(1, [100, 101, 102], {"source": "s"})
    w.way(2, [102, 103, 100], {})
    w.way(3, [104, 105, 106, 107, 104], {})
    w.way(4, [100, 102], {"highway": "motorway", "layer": "1"})
    w.way(5, [100, 999, 101], {"highway": "primary"})
    w.way(6, [100], {"highway": "primary"})
    w.relation(11, [("WAY", 1, "outer"), ("WAY", 2, "outer"), ("WAY", 3, "inner"), ("NODE", 100, "")], {"type": "multipolygon", "landuse": "forest"})
    w.relation(12, [("WAY", 4, "")], {"type": "boundary", "admin_level": "2", "boundary": "administrative", "name": "B"})
    return w.header() + w.flush()


@pytest.mark.parametrize("renumber", [False, True])
def test_files_to_tiles(spark, tmp_path, renumber):
    (tmp_path / "w.pbf").write_bytes(world())
    store, tiles = str(tmp_path / "store"), str(tmp_path / "tiles")
    ids = {r.id: r.id for r in []}
    out = pipeline.ingest(spark, pbf.read(spark, str(tmp_path / "w.pbf")), store, renumber)
    if renumber:
        ids = {(r.entity, r.old_id): r.new_id for r in out.read("id_map").collect()}
        assert sorted(v for (e, _), v in ids.items() if e == "NODE") == list(range(1, 10))  # with the missing one
        assert ids["NODE", 100] == 1 and ids["WAY", 1] == 1 and ids["RELATION", 11] == 1
    own = lambda e, i: ids.get((e, i), i)
    assert out.read("nodes").where(F.col("id") == own("NODE", 100)).first().tags == {"place": "town", "population": "5000"}
    pipeline.resolve_store(spark, store)
    located = {r.id: r for r in out.read("located_ways").collect()}
    assert [r.id for r in located[own("WAY", 1)].refs] == [own("NODE", n) for n in (100, 101, 102)]
    assert [r.lat for r in located[own("WAY", 5)].refs] == [0, None, 0]
    assert out.read("missing_nodes").count() == 1
    (poly,) = out.read("multipolygons").collect()
    assert len(poly.rings) == 2 and sorted(poly.way_ids) == sorted(own("WAY", w) for w in (1, 2)) and poly.tags == {"landuse": "forest"}
    assert out.read("reverse_refs").where("target_type = 'WAY'").count() == 4
    assert out.read("ring_warnings").count() == 0 and out.read("refused").count() == 0
    done = pipeline.tile(spark, store, tiles, budget=400)
    rows = done.read("features")
    kinds = {(r.layer, r.entity_type, r.geom_kind) for r in rows.select("layer", "entity_type", "geom_kind").distinct().collect()}
    assert kinds == {("landuse", "RELATION", "POLYGON"), ("road", "WAY", "LINE"), ("roadLabel", "WAY", "LINE"), ("boundary", "WAY", "LINE"), ("place", "NODE", "POINT")}
    road = rows.where("layer = 'road' AND zoom = 24").orderBy("z_index").collect()
    assert [(r.entity_id, r.z_index, len(r.rings[0])) for r in road] == [(own("WAY", 5), 6, 2), (own("WAY", 4), 19, 2)]
    assert road[1].tags["name"] == "B"
    held = done.read("tiles")
    assert held.select("layer", "zoom", "entity_id").distinct().count() == rows.select("layer", "zoom", "entity_id").distinct().count()
    index = done.read("tile_index")
    assert index.where("is_leaf AND bytes > 400").where(F.length("path") < quadtree.MOST_DEPTH).count() == 0
    assert pipeline.tile(spark, store, str(tmp_path / "flat"), lod=False).read("features").select("zoom").distinct().collect()[0].zoom == 24


def test_leaves_cover_all_and_keep_the_budget(spark):
    rows = spark.range(500).select("id", F.struct(*((F.col("id") * k % 997 * 1000).cast("int").alias(n) for n, k in zip(quadtree.BOUNDS, (37, 37, 91, 91), strict=True))).alias("bbox"), F.lit(10).cast("bigint").alias("bytes"))
    held, index = quadtree.leaves(rows, ["id"], [], 200)
    assert held.select("id").distinct().count() == 500
    assert index.where("is_leaf AND bytes > 200").count() == 0
    assert index.where("NOT is_leaf AND bytes <= 200").count() == 0


@pytest.mark.parametrize("weights", [[6_000_000], [4_000_000] * 5, [6_000_000, *[10] * 40]])
def test_features_that_cover_the_world_do_not_split_it_for_ever(spark, weights):
    m = 2_000_000_000
    rows = spark.createDataFrame([(i, (-m, m, -m, m), w) for i, w in enumerate(weights)], "id long, bbox struct<xmin:int,xmax:int,ymin:int,ymax:int>, bytes bigint")
    held, index = quadtree.leaves(rows, ["id"], [])
    assert index.count() == 1 and held.count() == len(weights)


@pytest.mark.parametrize("depth", [0, 1, 3, 5])
def test_cells_of_a_depth_are_those_of_descending(spark, depth):
    m = 2_003_750_834
    spots = [(k * 7919 * 1013 % (2 * m) - m, k * 104729 * 997 % (2 * m) - m, k * 37_000_003 % 900_000_000) for k in range(60)]
    rows = spark.createDataFrame([(i, (x, min(x + w, 2**31 - 1), y, min(y + w // 3, 2**31 - 1))) for i, (x, y, w) in enumerate([*spots, (0, 0, 0), (-m, -m, 2 * m), (m // 2 + 1, 0, 5)])], "id long, bbox struct<xmin:int,xmax:int,ymin:int,ymax:int>")
    want = quadtree.at_root(rows)
    for _ in range(depth):
        want = quadtree.descend(want)
    assert sorted((r.id, r.path) for r in quadtree.at_depth(rows, depth).collect()) == sorted((r.id, r.path) for r in want.collect())


def test_empty_features_have_no_tiles(spark):
    rows = spark.createDataFrame([], "id long, bbox struct<xmin:int,xmax:int,ymin:int,ymax:int>, bytes bigint")
    held, index = quadtree.leaves(rows, ["id"], [])
    assert held.count() == 0 and index.count() == 0


def test_id_map_numbers_first_mentions(spark):
    rows = spark.createDataFrame([("NODE", 9, 50), ("NODE", 4, 10), ("NODE", 9, 5), ("WAY", 4, 60), ("NODE", 7, 3_000_000)], "entity string, old_id long, seq long")
    assert {(r.entity, r.old_id): r.new_id for r in remap.id_map(rows).collect()} == {("NODE", 9): 1, ("NODE", 4): 2, ("NODE", 7): 3, ("WAY", 4): 1}


def test_classes(spark):
    sizes = {10: 5, 11: 100, 50: 3, 100: 1}
    better = tools.better_classes(sizes, [20, 60, 100])
    cost = lambda own: sum((min(c for c in own if c >= s) - s) * n for s, n in sizes.items())
    assert cost(better) < cost([20, 60, 100]) and len(better) == 3
    assert len(tools.geometric_classes(10**6)) <= 65


def test_shell(spark, tmp_path, capsys):
    from tessera.__main__ import main

    (tmp_path / "w.pbf").write_bytes(world())
    store, tiles = str(tmp_path / "s"), str(tmp_path / "t")
    main(["ingest", str(tmp_path / "w.pbf"), "--dest", store, "--remap"], spark)
    main(["resolve", store, "-u"], spark)
    assert {r.target_type for r in spark.read.parquet(f"{store}/reverse_refs").collect()} == {"WAY"}
    main(["resolve", store, "-r"], spark)  # multipolygons anew, from what was located
    main(["tile", store, "--dest", tiles, "-l"], spark)
    main(["unmap", store, "n", "1"], spark)
    assert capsys.readouterr().out.split() == ["100", "https://www.openstreetmap.org/node/100"]


def test_refused_rows_do_not_end_the_run(spark, tmp_path):
    w = pbf.PbfWriter()
    w.node(1, 2_000_000_000, 0)
    w.node(2, 0, 0, {"place": "town"})
    w.way(3, [2, 2], {})
    (tmp_path / "w.pbf").write_bytes(w.flush())
    out = pipeline.ingest(spark, pbf.read(spark, str(tmp_path / "w.pbf")), str(tmp_path / "s"))
    assert [r.id for r in out.read("refused").collect()] == [1] and [r.id for r in out.read("nodes").collect()] == [2]
