"""Every operator as a named query over the business tables, with SQL to hold it against.

QUERIES are callables (spark, sf_dir) -> DataFrame; ORACLES are statements for DuckDB with the same
columns. Queries use the operators; the SQL is written out from the rules on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo
from ..functions import tags as T
from ..functions.storage import fresh
from ..operators import layers, multipolygon, quadtree, remap, resolve, simplify, tools
from ..sources import bridge, pbf, xml
from ..streaming import changes as stream_changes
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

M = geo.HALF_WORLD
X = f"cast(trunc(lng * 1e-7 / 180e0 * {M}e0) AS bigint)"
Y = f"cast(trunc(least(greatest(ln(tan((90e0 + lat * 1e-7) * (pi() / 360e0))) / pi() * {M}e0, -{M}e0), {M}e0)) AS bigint)"
#: Located references, bounds, closedness and area of ways.
LOC = f"fx_loc AS (SELECT e.way_id, e.pos, n.lat, n.lng, {X} AS x, {Y} AS y FROM fx_edges e JOIN fx_nodes n ON n.id = e.node_id)"
BOX = "fx_box AS (SELECT way_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, count(*) AS n, arg_min(lat, pos) = arg_max(lat, pos) AND arg_min(lng, pos) = arg_max(lng, pos) AND count(*) > 3 AS closed FROM fx_loc GROUP BY way_id)"
AREA = "fx_area AS (SELECT s.way_id, abs(sum(cast(x AS double) * ny - cast(nx AS double) * y)) / 2 AS area FROM (SELECT way_id, pos, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM fx_loc WINDOW w AS (PARTITION BY way_id ORDER BY pos)) s WHERE nx IS NOT NULL GROUP BY s.way_id)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def sql(names: str, body: str, *more: str) -> str:
    """WITH of bridge statements and further ones, then the body."""
    return bridge.with_clause(*names.split()).rstrip() + "".join(f",\n{m}" for m in more) + "\n" + body


def long(column: str):
    return F.col(column).cast("bigint").alias(column)


def located(spark: SparkSession, d: str) -> DataFrame:
    return resolve.locate(bridge.ways(spark, d), bridge.nodes(spark, d))


def projected(spark: SparkSession, d: str) -> DataFrame:
    """(id, tags, closed, points, bbox) of located ways."""
    w = located(spark, d).select("id", "tags", geo.is_closed(F.col("refs")).alias("closed"), geo.project(F.col("refs")).alias("points"))
    return w.withColumn("bbox", geo.bounds(F.col("points")))


def exploded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode("tags").alias("k", "v"))


# Scans, tags, histograms


@query("entity_counts", "SELECT 'nodes' AS entity, count(*) AS n FROM part UNION ALL SELECT 'ways', count(*) FROM orders UNION ALL SELECT 'relations', count(*) FROM customer")
def entity_counts(spark, d):
    return tools.entity_counts(nodes=bridge.nodes(spark, d), ways=bridge.way_tags(spark, d), relations=bridge.relations(spark, d))


#: What ingest drops of the keys that these tables have, written out.
_DROPPED = "k = 'source' OR starts_with(k, 'tiger:') OR starts_with(k, 'NHD_')"


@query("tag_blacklist_filter", sql("fx_node_tags fx_way_tags", f"SELECT * FROM (SELECT 'NODE' AS entity, id, k, v FROM fx_node_tags UNION ALL SELECT 'WAY', id, k, v FROM fx_way_tags) WHERE NOT ({_DROPPED})"))
def tag_blacklist_filter(spark, d):
    both = bridge.nodes(spark, d).select(F.lit("NODE").alias("entity"), "id", "tags").unionByName(bridge.way_tags(spark, d).select(F.lit("WAY").alias("entity"), "id", "tags"))
    return exploded(both.withColumn("tags", T.kept(F.col("tags"))), "entity", "id")


@query("tag_key_histogram", sql("fx_way_tags", 'SELECT k AS "key", count(*) AS n FROM fx_way_tags GROUP BY k'))
def tag_key_histogram(spark, d):
    return tools.key_histogram(bridge.way_tags(spark, d))


_SAVED = "SELECT symbol, count(*) AS n, cast(count(*) * strlen(symbol) AS bigint) AS saved FROM (SELECT k AS symbol FROM fx_way_tags UNION ALL SELECT v FROM fx_way_tags) GROUP BY symbol"


@query("tag_bytes_saved", sql("fx_way_tags", _SAVED))
def tag_bytes_saved(spark, d):
    return tools.bytes_saved(bridge.way_tags(spark, d))


@query("top_symbols", sql("fx_way_tags", f"SELECT * FROM ({_SAVED}) ORDER BY saved DESC, symbol LIMIT 256"))
def top_symbols(spark, d):
    return tools.top_symbols(bridge.way_tags(spark, d))


@query("unclassified_nodes", sql("fx_node_tags", "SELECT count(*) AS n, count(*) FILTER (WHERE known) AS n_known, count(*) FILTER (WHERE NOT known) AS n_unknown FROM (SELECT id, bool_or(k IN ('place', 'addr:housenumber')) AS known FROM fx_node_tags GROUP BY id)"))
def unclassified_nodes(spark, d):
    return tools.local_and_global(bridge.nodes(spark, d), ["place", "addr:housenumber"])


# Ordered operators


@query("delta_encode", sql("fx_edges", "SELECT way_id, pos, node_id - coalesce(lag(node_id) OVER (PARTITION BY way_id ORDER BY pos), 0) AS delta FROM fx_edges"))
def delta_encode(spark, d):
    w = Window.partitionBy("way_id").orderBy("pos")
    return bridge.edges(spark, d).select("way_id", "pos", (F.col("node_id") - F.lag("node_id", 1, 0).over(w)).alias("delta"))


@query("delta_decode", sql("fx_edges", "SELECT way_id, pos, cast(sum(node_id) OVER (PARTITION BY way_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS bigint) AS value FROM fx_edges"))
def delta_decode(spark, d):
    w = Window.partitionBy("way_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return bridge.edges(spark, d).select("way_id", "pos", F.sum("node_id").over(w).alias("value"))


@query("way_segments", sql("fx_edges fx_nodes", "SELECT way_id, cast(count(*) AS bigint) AS segments, cast(sum(abs(nx - x) + abs(ny - y)) AS bigint) AS span FROM (SELECT way_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM fx_loc WINDOW w AS (PARTITION BY way_id ORDER BY pos)) WHERE nx IS NOT NULL GROUP BY way_id", LOC))
def way_segments(spark, d):
    w = projected(spark, d).where(F.size("points") > 1)
    n = F.size("points") - 1
    steps = F.zip_with(F.slice("points", 1, n), F.slice("points", 2, n), lambda p, q: F.abs(q["x"].cast("bigint") - p["x"]) + F.abs(q["y"].cast("bigint") - p["y"]))
    return w.select(F.col("id").alias("way_id"), n.cast("bigint").alias("segments"), F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, s: a + s).alias("span"))


_SEQ = "SELECT 'WAY' AS entity, o_orderkey + 1 AS old_id, (o_orderkey + 1) * 1048576 AS seq FROM orders UNION ALL SELECT 'NODE', node_id, way_id * 1048576 + pos FROM fx_edges"
_MAP = f"SELECT entity, cast(old_id AS bigint) AS old_id, cast(row_number() OVER (PARTITION BY entity ORDER BY min(seq)) AS bigint) AS new_id FROM ({_SEQ}) GROUP BY entity, old_id"


def id_map(spark, d):
    ways = bridge.way_tags(spark, d).select(F.lit("WAY").alias("entity"), F.col("id").alias("old_id"), (F.col("id") * 1048576).alias("seq"))
    nodes = bridge.edges(spark, d).select(F.lit("NODE").alias("entity"), F.col("node_id").alias("old_id"), (F.col("way_id") * 1048576 + F.col("pos")).alias("seq"))
    return remap.id_map(ways.unionByName(nodes), remap.BUCKET * 1048576)


@query("id_remap", sql("fx_edges", _MAP))
def id_remap(spark, d):
    return id_map(spark, d)


@query("id_unmap", sql("fx_edges", f"SELECT old_id, concat('https://www.openstreetmap.org/node/', cast(old_id AS varchar)) AS url FROM ({_MAP}) WHERE entity = 'NODE' AND new_id = 5"))
def id_unmap(spark, d):
    return remap.original(id_map(spark, d), "NODE", 5)


@query("refs_remapped", sql("fx_edges", f"SELECT e.way_id, e.pos, m.new_id AS node_id FROM fx_edges e JOIN ({_MAP}) m ON m.entity = 'NODE' AND m.old_id = e.node_id"))
def refs_remapped(spark, d):
    return remap.renamed(bridge.edges(spark, d), id_map(spark, d), "NODE", "node_id")


@query("highest_remapped_id", sql("fx_edges", f"SELECT entity, max(new_id) AS highest FROM ({_MAP}) GROUP BY entity"))
def highest_remapped_id(spark, d):
    return remap.highest(id_map(spark, d))


# References


@query("resolve_way_nodes", sql("fx_edges fx_nodes", "SELECT e.way_id, e.pos, e.node_id, n.lat, n.lng FROM fx_edges e LEFT JOIN fx_nodes n ON n.id = e.node_id"))
def resolve_way_nodes(spark, d):
    rows = located(spark, d).select(F.col("id").alias("way_id"), F.explode("refs").alias("r"))
    return rows.select("way_id", F.col("r.pos").cast("bigint").alias("pos"), F.col("r.id").alias("node_id"), F.col("r.lat").cast("bigint").alias("lat"), F.col("r.lng").cast("bigint").alias("lng"))


@query("unresolved_refs", sql("fx_edges", "SELECT way_id, pos, node_id FROM fx_edges WHERE node_id % 10 = 0"))
def unresolved_refs(spark, d):
    return resolve.missing_nodes(bridge.edges(spark, d), bridge.nodes(spark, d).where("id % 10 <> 0")).select("way_id", "pos", "node_id")


_NESTED = "SELECT cast(c_custkey + 1 AS bigint) AS rel_id, cast(1 AS bigint) AS pos, 'RELATION' AS type, cast(floor(c_custkey / 10e0) + 1 AS bigint) AS ref, '' AS role FROM {customer}"


def reverse(spark, d):
    nested = spark.sql(_NESTED, customer=spark.read.parquet(f"{d}/customer.parquet"))
    return resolve.reverse_refs(bridge.edges(spark, d), bridge.members(spark, d).unionByName(nested))


def _reverse_query(name: str, target: str, body: str) -> None:
    @query(name, body)
    def run(spark, d):
        src = F.col("src")
        return resolve.referring(reverse(spark, d), target).select("target_id", F.size(src).cast("bigint").alias("n"), src[0].src_id.alias("first_src"), F.element_at(src, -1).src_id.alias("last_src"))


_reverse_query("reverse_node_index", "NODE", sql("fx_edges", "SELECT node_id AS target_id, count(DISTINCT way_id) AS n, min(way_id) AS first_src, max(way_id) AS last_src FROM fx_edges GROUP BY node_id"))
_reverse_query("reverse_way_index", "WAY", sql("fx_members", "SELECT ref AS target_id, count(DISTINCT rel_id) AS n, min(rel_id) AS first_src, max(rel_id) AS last_src FROM fx_members GROUP BY ref"))
_reverse_query("reverse_rel_index", "RELATION", "SELECT ref AS target_id, count(DISTINCT rel_id) AS n, min(rel_id) AS first_src, max(rel_id) AS last_src FROM (" + _NESTED.replace("{customer}", "customer") + ") GROUP BY ref")


@query("renderable_relations", "SELECT cast(c_custkey + 1 AS bigint) AS id FROM customer WHERE c_mktsegment = 'BUILDING'")
def renderable_relations(spark, d):
    return resolve.renderable(bridge.relations(spark, d)).select("id")


@query("boundary_relations", sql("fx_rel_tags", "SELECT id, k, v FROM fx_rel_tags WHERE id IN (SELECT id FROM fx_rel_tags WHERE k = 'type' AND v = 'boundary')"))
def boundary_relations(spark, d):
    return exploded(resolve.boundaries(bridge.relations(spark, d)), "id")


@query("relation_way_copies", sql("fx_members fx_edges", "SELECT m.rel_id, m.pos, m.role, m.ref AS way_id, e.n AS n_refs FROM fx_members m JOIN (SELECT way_id, count(*) AS n FROM fx_edges GROUP BY way_id) e ON e.way_id = m.ref WHERE m.rel_id IN (SELECT c_custkey + 1 FROM customer WHERE c_mktsegment = 'BUILDING')"))
def relation_way_copies(spark, d):
    out = resolve.way_copies(bridge.members(spark, d), bridge.relations(spark, d), located(spark, d))
    return out.select("rel_id", "pos", "role", "way_id", F.size("refs").cast("bigint").alias("n_refs"))


_REPEATS = "SELECT cast(l_suppkey AS bigint) AS rel_id, cast(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS bigint) AS pos, cast(l_partkey % 50 AS bigint) AS ref, CASE WHEN l_returnflag = 'A' THEN 'outer' ELSE 'inner' END AS role FROM {lineitem}"


@query("first_member_occurrence", "SELECT rel_id, ref, min(pos) AS pos FROM (" + _REPEATS.replace("{lineitem}", "lineitem") + ") GROUP BY rel_id, ref")
def first_member_occurrence(spark, d):
    rows = spark.sql(_REPEATS, lineitem=spark.read.parquet(f"{d}/lineitem.parquet"))
    return resolve.first_members(rows).select("rel_id", "ref", "pos")


@query("unique_outer_way", sql("fx_members", "SELECT rel_id, count(*) FILTER (WHERE role = 'outer') AS n_outer, CASE WHEN count(*) FILTER (WHERE role = 'outer') = 1 THEN max(ref) FILTER (WHERE role = 'outer') END AS outer_ref FROM fx_members GROUP BY rel_id"))
def unique_outer_way(spark, d):
    return resolve.unique_outer(bridge.members(spark, d))


# Geometry by expressions


@query("mercator_project", sql("fx_nodes", f"SELECT id, {X} AS x, {Y} AS y FROM fx_nodes"))
def mercator_project(spark, d):
    return bridge.nodes(spark, d).select("id", geo.mercator_x(F.col("lng")).cast("bigint").alias("x"), geo.mercator_y(F.col("lat")).cast("bigint").alias("y"))


@query("way_bbox", sql("fx_edges fx_nodes", "SELECT way_id, xmin, xmax, ymin, ymax FROM fx_box", LOC, BOX))
def way_bbox(spark, d):
    return projected(spark, d).select(F.col("id").alias("way_id"), *(F.col(f"bbox.{c}").cast("bigint").alias(c) for c in quadtree.BOUNDS))


@query("way_area", sql("fx_edges fx_nodes", "SELECT b.way_id, cast(round(CASE WHEN closed THEN area ELSE 0 END / 1e8) AS bigint) AS area FROM fx_box b JOIN fx_area a ON a.way_id = b.way_id", LOC, BOX, AREA))
def way_area(spark, d):
    return projected(spark, d).where(F.size("points") > 1).select(F.col("id").alias("way_id"), F.round(geo.ring_area(F.col("points")) / 1e8).cast("bigint").alias("area"))


@query("way_closed", sql("fx_edges fx_nodes", "SELECT way_id, closed FROM fx_box", LOC, BOX))
def way_closed(spark, d):
    return projected(spark, d).select(F.col("id").alias("way_id"), "closed")


@query("degenerate_ways", sql("fx_edges", "SELECT way_id FROM fx_edges GROUP BY way_id HAVING count(*) < 2"))
def degenerate_ways(spark, d):
    return bridge.ways(spark, d).where(F.size("refs") < 2).select(F.col("id").alias("way_id"))


@query("range_validation", sql("fx_nodes", "SELECT lat * 2 BETWEEN -900000000 AND 900000000 AND lng * 2 BETWEEN -1800000000 AND 1800000000 AS valid, count(*) AS n FROM fx_nodes GROUP BY 1"))
def range_validation(spark, d):
    return bridge.nodes(spark, d).select(geo.in_range(F.col("lat").cast("bigint") * 2, F.col("lng").cast("bigint") * 2).alias("valid")).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


@query("relation_aabb_diagonal", sql("fx_members fx_edges fx_nodes", "SELECT m.rel_id, cast(round(sqrt(power(max(n.lat) - min(n.lat), 2) + power(max(n.lng) - min(n.lng), 2))) AS bigint) AS diagonal FROM fx_members m JOIN fx_edges e ON e.way_id = m.ref JOIN fx_nodes n ON n.id = e.node_id GROUP BY m.rel_id"))
def relation_aabb_diagonal(spark, d):
    edges = bridge.members(spark, d).select("rel_id", F.col("ref").alias("way_id")).join(bridge.edges(spark, d), "way_id")
    out = resolve.relation_bounds(resolve.locate_edges(edges, bridge.nodes(spark, d)))
    return out.select("rel_id", F.round("diagonal").cast("bigint").alias("diagonal"))


@query("line_distance", sql("fx_edges fx_nodes", "SELECT way_id, cast(round(CASE WHEN l2 = 0 THEN power(ax - px, 2) + power(ay - py, 2) ELSE power((zx - ax) * (ay - py) - (ax - px) * (zy - ay), 2) / l2 END / 1e6) AS bigint) AS d2 FROM (SELECT *, power(zx - ax, 2) + power(zy - ay, 2) AS l2 FROM (SELECT way_id, cast(arg_min(x, pos) AS double) AS ax, cast(arg_min(y, pos) AS double) AS ay, cast(arg_max(x, pos) AS double) AS zx, cast(arg_max(y, pos) AS double) AS zy, cast(max(x) FILTER (WHERE pos = 2) AS double) AS px, cast(max(y) FILTER (WHERE pos = 2) AS double) AS py FROM fx_loc GROUP BY way_id HAVING count(*) > 2)) t", LOC))
def line_distance(spark, d):
    w = projected(spark, d).where(F.size("points") > 2)
    a, p, b = F.get("points", F.lit(0)), F.get("points", F.lit(1)), F.element_at("points", -1)
    return w.select(F.col("id").alias("way_id"), F.round(geo.line_distance_squared(p["x"], p["y"], a["x"], a["y"], b["x"], b["y"], geo.square) / 1e6).cast("bigint").alias("d2"))


# Tags of boundaries and multipolygons

_LEVEL = "CASE WHEN {0} IS NULL THEN 65535 WHEN regexp_full_match({0}, '[0-9]*') THEN coalesce(try_cast({0} AS bigint), 0) ELSE 65535 END"


@query("boundary_tag_inheritance", sql("fx_way_wide fx_members fx_rel_wide", f"""SELECT id, admin_level, name FROM (
    SELECT w.id,
      CASE WHEN r.id IS NULL OR r.admin_level IS NULL THEN w.admin_level WHEN w.admin_level IS NULL OR {_LEVEL.format('r.admin_level')} <= {_LEVEL.format('w.admin_level')} THEN r.admin_level ELSE w.admin_level END AS admin_level,
      CASE WHEN r.id IS NULL OR r.name IS NULL THEN w.name WHEN w.name IS NULL OR {_LEVEL.format('r.admin_level')} <= {_LEVEL.format('w.admin_level')} THEN r.name ELSE w.name END AS name
    FROM fx_way_wide w LEFT JOIN fx_members m ON m.ref = w.id LEFT JOIN fx_rel_wide r ON r.id = m.rel_id AND r.type = 'boundary')"""))
def boundary_tag_inheritance(spark, d):
    out = resolve.with_boundary_tags(bridge.way_tags(spark, d), bridge.members(spark, d), bridge.relations(spark, d))
    return out.select("id", F.col("tags")["admin_level"].alias("admin_level"), F.col("tags")["name"].alias("name"))


_AGREED = "SELECT m.rel_id, t.k, t.v FROM fx_members m JOIN fx_way_tags t ON t.id = m.ref JOIN (SELECT rel_id, count(*) AS n FROM fx_members GROUP BY rel_id) c ON c.rel_id = m.rel_id GROUP BY m.rel_id, t.k, t.v, c.n HAVING count(*) = c.n"


@query("outer_tag_intersection", sql("fx_members fx_way_tags", _AGREED))
def outer_tag_intersection(spark, d):
    ways = bridge.way_tags(spark, d).select(F.col("id").alias("ref"), F.map_entries("tags").alias("e"))
    grouped = bridge.members(spark, d).join(ways, "ref").groupBy("rel_id").agg(F.collect_list("e").alias("es"))
    return exploded(grouped.select("rel_id", T.in_all(F.transform("es", lambda e: F.map_from_entries(e))).alias("tags")), "rel_id")


@query("multipolygon_tags", sql("fx_members fx_way_tags fx_rel_tags", f"""SELECT p.rel_id, t.k, t.v FROM (
    SELECT m.rel_id, count(*) AS n, min(m.ref) AS one, count(*) FILTER (WHERE role = 'outer') AS n_outer, max(m.ref) FILTER (WHERE role = 'outer') AS outer_ref,
      max(CASE WHEN m.rel_id IN (SELECT id FROM fx_rel_tags WHERE k <> 'type') THEN 1 ELSE 0 END) AS own
    FROM fx_members m WHERE m.rel_id IN (SELECT id FROM fx_rel_tags WHERE k = 'type' AND v = 'multipolygon') GROUP BY m.rel_id) p
  JOIN (SELECT 'own' AS how, id AS rel_id, id AS ref, k, v FROM fx_rel_tags WHERE k <> 'type' UNION ALL SELECT 'way', NULL, id, k, v FROM fx_way_tags UNION ALL SELECT 'all', rel_id, NULL, k, v FROM ({_AGREED})) t
  ON CASE WHEN own = 1 THEN t.how = 'own' AND t.rel_id = p.rel_id WHEN n = 1 THEN t.how = 'way' AND t.ref = p.one WHEN n_outer = 1 THEN t.how = 'way' AND t.ref = p.outer_ref ELSE t.how = 'all' AND t.rel_id = p.rel_id END"""))
def multipolygon_tags(spark, d):
    members, relations = bridge.members(spark, d), resolve.renderable(bridge.relations(spark, d))
    ids = members.join(relations.select(F.col("id").alias("rel_id")), "rel_id", "left_semi")
    shapes = ids.groupBy("rel_id").agg(F.sort_array(F.collect_set("ref")).alias("way_ids")).withColumn("poly_no", F.lit(0))
    return exploded(multipolygon.resolved_tags(shapes, relations, ids, bridge.way_tags(spark, d)), "rel_id")


@query("exclude_outer_ways", sql("fx_members", "SELECT cast(o_orderkey + 1 AS bigint) AS id FROM orders WHERE o_orderkey + 1 NOT IN (SELECT ref FROM fx_members WHERE role = 'outer')"))
def exclude_outer_ways(spark, d):
    """Ways that are no relation's outer member."""
    used = bridge.members(spark, d).where("role = 'outer'").groupBy("rel_id").agg(F.collect_list("ref").alias("way_ids"))
    return resolve.without_outer_ways(bridge.way_tags(spark, d), used).select("id")


# Layers

_ANY = "'{}'"
_LANDUSE = "landuse IN ('park','forest','residential','retail','commercial','industrial','railway','cemetery','grass','farmyard','farm','farmland','wood','meadow','village_green','recreation_ground','allotments','quarry')"
_LEISURE = "leisure IN ('park','garden','playground','golf_course','sports_centre','pitch','stadium','common','nature_reserve')"
_NATURAL = "\"natural\" IN ('wood','land','island','scrub','wetland')"
_AMENITY = "amenity IN ('university','school','college','library','fuel','parking','cinema','theatre','place_of_worship','hospital','grave_yard')"
_MINOR = "highway IN ('motorway_link','trunk_link','primary_link','secondary_link','tertiary','tertiary_link','residential','unclassified','road','living_street')"
#: For each layer: level and added type as SQL over tag columns (null: none).
LAYER_SQL = {
    "building": ("CASE WHEN closed AND (building NOT IN ('no','0','false') OR railway = 'station' OR aeroway = 'terminal') THEN 0 END", "NULL"),
    "landuse": (
        f"CASE WHEN closed AND ({_LANDUSE} OR {_LEISURE} OR {_NATURAL} OR {_AMENITY} OR place IN ('island','islet') OR (highway IN ('pedestrian','footway') AND area = 'yes') OR tourism = 'zoo' OR aeroway IN ('aerodrome','helipad','apron')) THEN 0 END",
        f"CASE WHEN {_LANDUSE} THEN landuse WHEN {_LEISURE} THEN leisure WHEN {_NATURAL} THEN \"natural\" WHEN {_AMENITY} THEN amenity END",
    ),
    "landuseOverlay": ("CASE WHEN closed AND leisure IN ('nature_reserve','wetland') THEN 0 END", "leisure"),
    "water": (
        "CASE WHEN closed AND (\"natural\" IN ('water','pond') OR waterway IN ('basin','canal','mill_pond','pond','riverbank','stream') OR landuse IN ('basin','reservoir')) THEN 0 END",
        "CASE WHEN \"natural\" IN ('water','pond') THEN \"natural\" WHEN waterway IN ('basin','canal','mill_pond','pond','riverbank','stream') THEN waterway ELSE landuse END",
    ),
    "road": (
        f"CASE WHEN highway IN ('motorway','trunk') THEN 0 WHEN highway IN ('primary','secondary') THEN 7 WHEN {_MINOR} THEN 10 WHEN highway IN ('service','track') THEN 12 WHEN highway IN ('path','cycleway','footway','pedestrian','steps','bridleway') THEN 13 WHEN railway = 'rail' THEN 0 WHEN railway IN ('abandoned','tram','disused','subway','narrow_gauge','light_rail','preserved','monorail','funicular') THEN 10 END",
        f"CASE WHEN highway IN ('motorway','trunk','primary','secondary','service','track','path','cycleway','footway','pedestrian','steps','bridleway') OR {_MINOR} THEN highway ELSE railway END",
    ),
    "roadLabel": ("CASE WHEN highway IN ('motorway','trunk') AND (name IS NOT NULL OR ref IS NOT NULL) THEN 0 END", "highway"),
    "roadMinorLabel": ("CASE WHEN highway IN ('residential','unclassified','road','living_street','unknown') AND (name IS NOT NULL OR (ref IS NOT NULL AND oneway IS NOT NULL)) THEN 10 END", "highway"),
    "boundary": ("CASE WHEN boundary = 'administrative' AND admin_level IN ('1','2','3','4','5','6') THEN 0 END", "NULL"),
    "waterway": ("CASE WHEN waterway IN ('river','canal') THEN 0 WHEN waterway = 'stream' THEN 10 WHEN waterway IN ('ditch','drain') THEN 12 WHEN barrier = 'ditch' THEN 12 END", "CASE WHEN waterway IN ('river','canal','stream','ditch','drain') THEN waterway END"),
    "address": ('CASE WHEN "addr:housenumber" IS NOT NULL THEN 10 END', "NULL"),
    "place": ("CASE WHEN place IS NOT NULL THEN 0 END", "place"),
}
#: Ways with their tag columns, whether closed or not, and bounds.
WAYS = "fx_way AS (SELECT w.*, b.closed, b.n AS n_refs, b.xmin, b.xmax, b.ymin, b.ymax FROM fx_way_wide w JOIN fx_box b ON b.way_id = w.id)"


def _layer_query(layer: layers.Layer) -> None:
    level, kind = LAYER_SQL[layer.name]
    if layer.points:
        body = sql("fx_node_wide", f"SELECT id, cast({level} AS bigint) AS level, {kind} AS kind FROM fx_node_wide WHERE {level} IS NOT NULL")
    else:
        body = sql("fx_way_wide fx_edges fx_nodes", f"SELECT id, cast({level} AS bigint) AS level, {kind} AS kind FROM fx_way WHERE {level} IS NOT NULL", LOC, BOX, WAYS)

    @query(f"layer_{layer.name}", body.replace("NULL AS kind", "cast(NULL AS varchar) AS kind"))
    def run(spark, d):
        rows = bridge.nodes(spark, d).select("id", "tags") if layer.points else projected(spark, d).select("id", "tags", "closed")
        out = layers.classified(rows, (layer,), None if layer.points else "closed")
        return out.select("id", F.col("level").cast("bigint").alias("level"), F.col("tags")["type"].alias("kind"))


for _layer in layers.LAYERS:
    _layer_query(_layer)

_ATOI = "coalesce(try_cast(regexp_extract({0}, '^\\s*([+-]?\\d+)', 1) AS bigint), 0)"


@query("layer_zindex_road", sql("fx_way_wide", f"""SELECT id, cast(least(127, greatest(-128, 10 * {_ATOI.format("coalesce(layer, '')")}
    + CASE WHEN highway IS NOT NULL THEN CASE highway WHEN 'motorway' THEN 9 WHEN 'trunk' THEN 8 WHEN 'primary' THEN 6 WHEN 'secondary' THEN 5 WHEN 'tertiary' THEN 4 WHEN 'residential' THEN 3 WHEN 'unclassified' THEN 3 WHEN 'road' THEN 3 ELSE 0 END WHEN railway IS NOT NULL THEN 7 ELSE 0 END
    - CASE WHEN tunnel IN ('true','yes','1') THEN 10 ELSE 0 END + CASE WHEN bridge IN ('true','yes','1') THEN 10 ELSE 0 END)) AS bigint) AS z FROM fx_way_wide"""))
def layer_zindex_road(spark, d):
    return bridge.way_tags(spark, d).select("id", layers.road_z(F.col("tags")).cast("bigint").alias("z"))


@query("layer_zindex_place", sql("fx_node_wide", f"SELECT id, cast(least(127, floor(ln(greatest({_ATOI.format(chr(39) + chr(39)).replace(chr(39) * 2, 'coalesce(population, ' + chr(39) * 2 + ')')}, 1)) / ln(1.2e0))) AS bigint) AS z FROM fx_node_wide"))
def layer_zindex_place(spark, d):
    return bridge.nodes(spark, d).select("id", layers.place_z(F.col("tags")).cast("bigint").alias("z"))


def _zoom_rows(names: tuple[str, ...], source: str) -> str:
    parts = []
    for name in names:
        layer = layers.BY_NAME[name]
        zooms = ", ".join(map(str, layer.zooms))
        box = "xmin, xmax, ymin, ymax" if not layer.points else "x AS xmin, x AS xmax, y AS ymin, y AS ymax"
        parts.append(f"SELECT id, '{name}' AS layer, zoom, {box} FROM (SELECT *, {LAYER_SQL[name][0]} AS level, unnest([{zooms}]) AS zoom FROM {source if not layer.points else 'fx_spot'}) t WHERE level IS NOT NULL AND (zoom >= level OR zoom = 24)")
    return "fx_shown AS (" + " UNION ALL ".join(parts) + ")"


SPOT = f"fx_spot AS (SELECT w.*, {X} AS x, {Y} AS y FROM fx_node_wide w JOIN fx_nodes n ON n.id = w.id)"
SHOWN = _zoom_rows(tuple(x.name for x in layers.LAYERS), "fx_way")


def shown(spark, d) -> DataFrame:
    """(id, layer, zoom, bbox) of every feature at every zoom that shows it, unsimplified."""
    lines = layers.by_zoom(layers.classified(projected(spark, d).select("id", "tags", "closed", "bbox"), layers.WAY_LAYERS))
    spot = F.array(F.struct(geo.mercator_x(F.col("lng")).alias("x"), geo.mercator_y(F.col("lat")).alias("y")))
    points = layers.by_zoom(layers.classified(bridge.nodes(spark, d).select("id", "tags", geo.bounds(spot).alias("bbox")), layers.POINT_LAYERS, None))
    return lines.select("id", "layer", "zoom", "bbox").unionByName(points.select("id", "layer", "zoom", "bbox"))


@query("feature_zoom_explode", sql("fx_way_wide fx_node_wide fx_edges fx_nodes", "SELECT layer, cast(zoom AS bigint) AS zoom, count(*) AS n FROM fx_shown GROUP BY layer, zoom", LOC, BOX, WAYS, SPOT, SHOWN))
def feature_zoom_explode(spark, d):
    return shown(spark, d).groupBy("layer", long("zoom")).agg(F.count(F.lit(1)).alias("n"))


_WORLD = f"SELECT '' AS path, cast(-{M} AS bigint) AS x0, cast({M} AS bigint) AS x1, cast(-{M} AS bigint) AS y0, cast({M} AS bigint) AS y1, 0 AS depth"


def cells(depth: int) -> str:
    """All cells to a depth, by recursion."""
    mid = lambda a, b: f"cast(trunc(({a} + {b}) / 2e0) AS bigint)"
    mx, my = mid("x0", "x1"), mid("y0", "y1")
    return f"""cells AS (WITH RECURSIVE c AS ({_WORLD} UNION ALL SELECT path || q, CASE WHEN q IN ('0','2') THEN x0 ELSE {mx} END, CASE WHEN q IN ('0','2') THEN {mx} ELSE x1 END,
      CASE WHEN q IN ('0','1') THEN {my} ELSE y0 END, CASE WHEN q IN ('0','1') THEN y1 ELSE {my} END, depth + 1 FROM c, (VALUES ('0'), ('1'), ('2'), ('3')) t(q) WHERE depth < {depth}) SELECT * FROM c)"""


_IN = "xmin <= x1 AND x0 <= xmax AND ymin <= y1 AND y0 <= ymax"


@query("tile_counts", sql("fx_way_wide fx_node_wide fx_edges fx_nodes", f"SELECT layer, cast(zoom AS bigint) AS zoom, path, count(*) AS n FROM fx_shown JOIN cells ON {_IN} WHERE depth = 3 GROUP BY layer, zoom, path", LOC, BOX, WAYS, SPOT, SHOWN, cells(3)))
def tile_counts(spark, d):
    """Resolved, projected, classified, by zoom, in the cells of depth 3: equal spans are counted before
    they are cut into cells."""
    spans = shown(spark, d).groupBy("layer", long("zoom"), quadtree.span(F.col("bbox"), 3).alias("span")).agg(F.count(F.lit(1)).alias("n"))
    return quadtree.cells(spans, 3).groupBy("layer", "zoom", "path").agg(F.sum("n").cast("bigint").alias("n"))


@query("quadtree_assign_depth_4", sql("fx_edges fx_nodes", f"SELECT way_id, path FROM fx_box JOIN cells ON {_IN} WHERE depth = 4", LOC, BOX, cells(4)))
def quadtree_assign_depth_4(spark, d):
    return quadtree.at_depth(projected(spark, d).select(F.col("id").alias("way_id"), "bbox"), 4).select("way_id", "path")


_BUDGET = 100


@query("quadtree_adaptive_leaves", sql("fx_nodes", f"""SELECT t.path, t.n, t.bytes FROM tree t LEFT JOIN tree p ON t.depth > 0 AND p.path = left(t.path, t.depth - 1) AND p.depth = t.depth - 1
    WHERE t.bytes <= (SELECT count(*) FROM part) AND (t.depth = 0 OR p.bytes > (SELECT count(*) FROM part))""",
    f"spot AS (SELECT id, {X} AS xmin, {X} AS xmax, {Y} AS ymin, {Y} AS ymax FROM fx_nodes)", cells(7),
    f"tree AS (SELECT path, depth, count(*) AS n, cast(count(*) * {_BUDGET} AS bigint) AS bytes FROM spot JOIN cells ON {_IN} GROUP BY path, depth)"))
def quadtree_adaptive_leaves(spark, d):
    """Leaves that hold a hundredth of all nodes at most."""
    nodes = bridge.nodes(spark, d)
    spot = F.array(F.struct(geo.mercator_x(F.col("lng")).alias("x"), geo.mercator_y(F.col("lat")).alias("y")))
    rows = nodes.select("id", geo.bounds(spot).alias("bbox"), F.lit(_BUDGET).cast("bigint").alias("bytes"))
    _, index = quadtree.leaves(rows, ["id"], [], nodes.count())
    return index.where("is_leaf").select("path", "n", "bytes")


_WINDOWS = " UNION ALL ".join(f"SELECT {i} AS window_id, {-M + i * 200_000_000} AS wx0, {-M + i * 200_000_000 + 150_000_000} AS wx1, {-M + i * 100_000_000} AS wy0, {M - i * 100_000_000} AS wy1" for i in range(16))


@query("bbox_overlap_join", sql("fx_edges fx_nodes", f"SELECT cast(window_id AS bigint) AS window_id, count(*) AS n, count(*) FILTER (WHERE wx0 <= xmin AND wx1 >= xmax AND wy0 <= ymin AND wy1 >= ymax) AS n_inside FROM fx_box JOIN ({_WINDOWS}) w ON xmin <= wx1 AND wx0 <= xmax AND ymin <= wy1 AND wy0 <= ymax GROUP BY window_id", LOC, BOX))
def bbox_overlap_join(spark, d):
    """Ways in sixteen fixed windows."""
    windows = spark.sql(_WINDOWS).select("window_id", F.struct(*(F.col(a).alias(b) for a, b in zip(("wx0", "wx1", "wy0", "wy1"), quadtree.BOUNDS, strict=True))).alias("w"))
    rows = projected(spark, d).select("bbox").join(F.broadcast(windows), geo.overlaps(F.col("w"), F.col("bbox")))
    return rows.groupBy(long("window_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(geo.contains(F.col("w"), F.col("bbox"))).alias("n_inside"))


_PIXELS = ", ".join(f"({z}, {2 * M}e0 / (256 * {2**z}e0))" for z in (5, 7, 9, 12, 24))


@query("pixel_area_cutoff", sql("fx_edges fx_nodes", f"SELECT b.way_id, cast(zoom AS bigint) AS zoom FROM fx_box b JOIN fx_area a ON a.way_id = b.way_id CROSS JOIN (VALUES {_PIXELS}) z(zoom, width) WHERE closed AND area >= width * width", LOC, BOX, AREA))
def pixel_area_cutoff(spark, d):
    w = projected(spark, d).where("closed").select(F.col("id").alias("way_id"), geo.ring_area(F.col("points")).alias("area"), F.explode(F.array(*map(F.lit, (5, 7, 9, 12, 24)))).alias("zoom"))
    return w.where(F.col("area") >= geo.pixel(F.col("zoom")) * geo.pixel(F.col("zoom"))).select("way_id", long("zoom"))


# Simplification, rings, overlay: figures with known results


@query("douglas_peucker", "SELECT cast(p_partkey AS bigint) AS id, cast(CASE WHEN p_size >= 10 THEN 3 ELSE 2 END AS bigint) AS n_points FROM part")
def douglas_peucker(spark, d):
    """Bent lines, p_size high, at a tolerance of 10."""
    point = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y") if isinstance(y, int) else y.cast("int").alias("y"))
    lines = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.array(point(0, 0), point(50, F.col("p_size")), point(100, 0)).alias("points"))
    return simplify.simplify(lines, 10.0).select("id", F.size("points").cast("bigint").alias("n_points"))


def _square(x, y, side):
    """A closed square's points, for columns of whole numbers."""
    corner = lambda dx, dy: F.struct((x + dx * side).cast("int").alias("x"), (y + dy * side).cast("int").alias("y"))
    return F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))


@query("simplify_pyramid", f"SELECT cast(p_partkey AS bigint) AS id, cast(zoom AS bigint) AS zoom, cast(CASE WHEN 1e6 * p_size * p_size / 2 >= width * width THEN 5 ELSE 3 END AS bigint) AS n_points FROM part CROSS JOIN (VALUES {_PIXELS}) z(zoom, width) WHERE 1000e0 * p_size >= width")
def simplify_pyramid(spark, d):
    """Squares of p_size x 10 m, shown while they are as wide as a pixel; as small rings, by their corners alone."""
    side = F.col("p_size") * 1000
    rows = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.lit(True).alias("area"), F.array(*map(F.lit, (5, 7, 9, 12, 24))).alias("zooms"), F.array(_square(F.lit(0), F.lit(0), side)).alias("rings"))
    return simplify.pyramids(rows).select("id", long("zoom"), F.size(F.col("rings")[0]).cast("bigint").alias("n_points"))


@query("simplify_real_ways")
def simplify_real_ways(spark, d):
    """(layer, zoom, features, points) of simplified area and line features."""
    w = projected(spark, d).where(F.size("points") > 1).select("id", "tags", "closed", F.array("points").alias("rings"))
    out = simplify.pyramids(layers.classified(w).drop("tags", "closed", "level"))
    return out.groupBy("layer", long("zoom")).agg(F.count(F.lit(1)).alias("features"), F.sum(F.size(F.flatten("rings"))).cast("bigint").alias("points"))


#: Cases of relations by customer: ways as corner lists of squares (a, b, c, d; A… twice as far right; small inside).
_CASES = {
    "ring_assembly": ["abcda", "abc cda", "abc adc", "cd ab da bc"],
    "gap_closing": ["abcdg", "ab cd"],
    "ring_dissolve": ["abcda befcb", "abcda aijka", "abcda adcba"],
    "ring_hierarchy": ["abcda mnopm", "abcda mnopm qrstq"],
}
_CORNERS = {
    "a": (0, 0), "b": (1, 0), "c": (1, 1), "d": (0, 1), "e": (2, 0), "f": (2, 1), "g": (0, 0.05), "i": (0.5, 0), "j": (0.5, 0.5), "k": (0, 0.5),
    "m": (0.1, 0.1), "n": (0.6, 0.1), "o": (0.6, 0.6), "p": (0.1, 0.6), "q": (0.2, 0.2), "r": (0.45, 0.2), "s": (0.45, 0.45), "t": (0.2, 0.45),
}


def _case_copies(spark, d, cases: list[str]) -> DataFrame:
    """Way copies of a figure for every customer, S = 10000 + 20 k wide, S apart from the next."""
    side = F.lit(10000) + 20 * (F.col("c_custkey") % 1000)
    base = (F.col("c_custkey") % 20000) * 40000

    def refs(corners: str):
        place = lambda c: F.struct(F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("id"), (F.lit(_CORNERS[c][1]) * side).cast("int").alias("lat"), (F.lit(_CORNERS[c][0]) * side + base).cast("int").alias("lng"))
        return F.array(*map(place, corners))

    def ways(case: str):
        return F.array(*(F.struct(F.lit(k + 1).alias("pos"), F.lit(k + 1).cast("bigint").alias("way_id"), refs(c).alias("refs")) for k, c in enumerate(case.split())))

    pick = ways(cases[-1])
    for k in range(len(cases) - 1):
        pick = F.when(F.col("c_custkey") % len(cases) == k, ways(cases[k])).otherwise(pick)
    rows = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("bigint").alias("rel_id"), F.explode(pick).alias("w"))
    return rows.select("rel_id", "w.pos", "w.way_id", "w.refs")


def _areas(built: DataFrame) -> DataFrame:
    """(rel_id, polygons, holes, ways, area of outer rings less holes)."""
    rows = built.where("poly_no >= 0")
    ring = lambda r: F.transform(r, lambda p: F.struct(p["a"].alias("x"), p["b"].alias("y")))
    area = F.transform("lines", lambda r: geo.ring_area(ring(r)))
    net = 2 * area[0] - F.aggregate(area, F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("rel_id").agg(F.count(F.lit(1)).alias("polygons"), F.sum(F.size("lines") - 1).cast("bigint").alias("holes"), F.sum(F.size("way_ids")).cast("bigint").alias("ways"), F.sum(F.round(net).cast("bigint")).alias("area"))


def _figure(name: str, rows: list[tuple[int, int, int, str] | None]) -> None:
    """rows: polygons, holes, ways and the area in terms of s, by case; None where nothing comes out."""
    n = len(rows)
    parts = [f"SELECT c_custkey AS rel_id, cast({r[0]} AS bigint) AS polygons, cast({r[1]} AS bigint) AS holes, cast({r[2]} AS bigint) AS ways, cast(round({r[3]}) AS bigint) AS area FROM (SELECT c_custkey, cast(10000 + 20 * (c_custkey % 1000) AS double) AS s FROM customer WHERE c_custkey % {n} = {k}) t" for k, r in enumerate(rows) if r]

    @query(name, " UNION ALL ".join(parts))
    def run(spark, d):
        return _areas(multipolygon.assemble_relations(_case_copies(spark, d, _CASES[name])))


_figure("ring_assembly", [(1, 0, 1, "s * s"), (1, 0, 2, "s * s"), (1, 0, 2, "s * s"), (1, 0, 4, "s * s")])
_figure("gap_closing", [(1, 0, 1, "s * s"), None])
_figure("ring_dissolve", [(1, 0, 2, "2 * s * s"), (1, 0, 2, "0.75 * s * s"), (1, 0, 2, "s * s")])
_figure("ring_hierarchy", [(1, 1, 1, "0.75 * s * s"), (2, 1, 2, "0.75 * s * s + 0.0625 * s * s")])


@query("multipolygon_build", "SELECT c_custkey AS rel_id, cast(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 3 END AS bigint) AS rings, true AS ccw FROM customer WHERE c_custkey IN (SELECT c_custkey + 1 FROM customer WHERE c_mktsegment = 'BUILDING')")
def multipolygon_build(spark, d):
    """Projected multipolygons of nested squares: rings by relation, and whether outer ones run counter-clockwise."""
    copies = _case_copies(spark, d, _CASES["ring_hierarchy"])
    relations = resolve.renderable(bridge.relations(spark, d))
    ids = relations.select(F.col("id").alias("rel_id"))
    own = copies.withColumn("rel_id", F.col("rel_id")).join(ids, "rel_id", "left_semi")
    members = own.select("rel_id", "pos", F.lit("WAY").alias("type"), F.col("way_id").alias("ref"), F.lit("").alias("role"))
    ways = spark.range(1, 4).select("id", F.create_map(F.lit("building"), F.lit("yes")).alias("tags"))
    out = multipolygon.multipolygons(own, relations, members, ways)
    ring = F.col("rings")[0]
    n = F.size(ring)
    turn = F.aggregate(F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), lambda p, q: p["x"].cast("double") * q["y"] - q["x"].cast("double") * p["y"]), F.lit(0.0), lambda a, c: a + c)
    return out.groupBy("rel_id").agg(F.sum(F.size("rings")).cast("bigint").alias("rings"), F.bool_and(turn > 0).alias("ccw"))


@query("nearest_open_endpoints", sql("fx_members fx_edges fx_nodes", """SELECT a.rel_id, cast(round(min(sqrt(power(a.lat - b.lat, 2) + power(a.lng - b.lng, 2)))) AS bigint) AS distance
    FROM ends a JOIN ends b ON a.rel_id = b.rel_id AND (a.lat < b.lat OR (a.lat = b.lat AND a.lng < b.lng)) GROUP BY a.rel_id""",
    LOC, "way_ends AS (SELECT way_id, unnest([arg_min(lat, pos), arg_max(lat, pos)]) AS lat, unnest([arg_min(lng, pos), arg_max(lng, pos)]) AS lng FROM fx_loc GROUP BY way_id)",
    "ends AS (SELECT m.rel_id, e.lat, e.lng FROM (SELECT DISTINCT rel_id, ref FROM fx_members) m JOIN way_ends e ON e.way_id = m.ref GROUP BY m.rel_id, e.lat, e.lng HAVING count(*) % 2 = 1)"))
def nearest_open_endpoints(spark, d):
    """The closest two open ends of a relation's ways."""
    copies = bridge.members(spark, d).select("rel_id", F.col("ref").alias("way_id")).join(located(spark, d).select(F.col("id").alias("way_id"), "refs"), "way_id")
    return multipolygon.nearest_ends(copies)


# Rings that must be healed or cannot be closed, rings that simplify to their corners

_CASES |= {"ring_healing": ["acbda", "aba", "abea"]}
_figure("ring_healing", [(1, 0, 1, "0.25 * s * s"), None, None])


@query("open_end_warnings", "SELECT c_custkey AS rel_id, cast(1 AS bigint) AS n FROM customer WHERE c_custkey % 2 = 1")
def open_end_warnings(spark, d):
    """Relations whose ways leave ends too far apart to be joined."""
    built = multipolygon.assemble_relations(_case_copies(spark, d, _CASES["gap_closing"]))
    return multipolygon.warnings(built).where(F.contains("warning", F.lit("open ends"))).groupBy("rel_id").agg(F.count(F.lit(1)).alias("n"))


@query("open_ends", "SELECT c_custkey AS rel_id, cast(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 4 END AS bigint) AS n FROM customer")
def open_ends(spark, d):
    return multipolygon.open_ends(_case_copies(spark, d, _CASES["gap_closing"])).groupBy("rel_id").agg(F.count(F.lit(1)).alias("n"))


@query("simplify_ring_corners", f"SELECT cast(p_partkey AS bigint) AS id, cast(zoom AS bigint) AS zoom, cast(CASE WHEN 1e6 * p_size * p_size / 2 >= width * width THEN 5 ELSE 4 END AS bigint) AS n_points FROM part CROSS JOIN (VALUES {_PIXELS}) z(zoom, width) WHERE 1000e0 * p_size >= width")
def simplify_ring_corners(spark, d):
    """Squares with 24 more points on their sides, each zoom by itself: rings that keep four points at least."""
    side, n = F.col("p_size") * 1000, 7
    corners = [(0, 0), (n, 0), (n, n), (0, n), (0, 0)]
    steps = [(a[0] + (b[0] - a[0]) * k // n, a[1] + (b[1] - a[1]) * k // n) for a, b in zip(corners, corners[1:], strict=False) for k in range(n)]
    place = lambda k: F.floor(side * k / n).cast("int")
    ring = F.array(*(F.struct(place(x).alias("x"), place(y).alias("y")) for x, y in [*steps, (0, 0)]))
    rows = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.lit(True).alias("area"), F.explode(F.array(*map(F.lit, (5, 7, 9, 12, 24)))).alias("z"), F.array(ring).alias("rings"))
    found = simplify.pyramids(rows.select("id", "area", F.array("z").alias("zooms"), "rings"))
    return found.select("id", long("zoom"), F.size(F.col("rings")[0]).cast("bigint").alias("n_points"))


# Files: written from the tables, read back


def _pbf(spark, d) -> DataFrame:
    path = fresh(spark)
    pbf.write(bridge.entities(spark, d), path)
    return pbf.read(spark, path)


def _osm(spark, d) -> str:
    """A map file in XML, with ways and relations that refer to nothing beside the tables' own."""
    path, rows = fresh(spark), bridge.entities(spark, d)
    empty = rows.where("entity <> 'NODE'").select("entity", (F.col("id") + 1_000_000_000_000).alias("id"), "version", "lat", "lng", F.lit(None).cast("array<bigint>").alias("refs"), F.lit(None).cast("array<struct<type:string,ref:bigint,role:string>>").alias("members"), "tags")
    xml.write(bridge.xml_lines(rows.unionByName(empty)), path)
    return path


_ALL_TAGS = "SELECT 'NODE' AS entity, id, k, v FROM fx_node_tags UNION ALL SELECT 'WAY', id, k, v FROM fx_way_tags WHERE id IN (SELECT way_id FROM fx_edges) UNION ALL SELECT 'RELATION', id, k, v FROM fx_rel_tags"


@query("pbf_nodes", sql("fx_nodes", "SELECT id, lat, lng FROM fx_nodes"))
def pbf_nodes(spark, d):
    return pbf.nodes(_pbf(spark, d)).select("id", long("lat"), long("lng"))


@query("pbf_tags", sql("fx_node_tags fx_way_tags fx_rel_tags fx_edges", _ALL_TAGS))
def pbf_tags(spark, d):
    return exploded(_pbf(spark, d), "entity", "id")


@query("pbf_way_refs", sql("fx_edges", "SELECT way_id, pos, node_id FROM fx_edges"))
def pbf_way_refs(spark, d):
    rows = pbf.ways(_pbf(spark, d)).select(F.col("id").alias("way_id"), F.explode("refs").alias("r"))
    return rows.select("way_id", F.col("r.pos").cast("bigint").alias("pos"), F.col("r.id").alias("node_id"))


@query("pbf_members", sql("fx_members", "SELECT rel_id, pos, type, ref, role FROM fx_members"))
def pbf_members(spark, d):
    return resolve.member_edges(pbf.relations(_pbf(spark, d))).select("rel_id", long("pos"), "type", "ref", "role")


@query("pbf_from_any_store", sql("fx_edges", "SELECT 'NODE' AS entity, count(*) AS n FROM part UNION ALL SELECT 'WAY', count(DISTINCT way_id) FROM fx_edges UNION ALL SELECT 'RELATION', count(*) FROM customer"))
def pbf_from_any_store(spark, d):
    path = fresh(spark)
    pbf.write(bridge.entities(spark, d), path)
    return pbf.read_whole(spark, path).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("xml_nodes", sql("fx_nodes fx_node_tags", "SELECT n.id, n.lat, n.lng, coalesce(t.n, 0) AS n_tags FROM fx_nodes n LEFT JOIN (SELECT id, count(*) AS n FROM fx_node_tags GROUP BY id) t ON t.id = n.id"))
def xml_nodes(spark, d):
    return xml.nodes(spark, _osm(spark, d)).select("id", long("lat"), long("lng"), F.size("tags").cast("bigint").alias("n_tags"))


@query("xml_way_refs", sql("fx_edges", "SELECT way_id, pos, node_id FROM fx_edges"))
def xml_way_refs(spark, d):
    rows = xml.ways(spark, _osm(spark, d)).select(F.col("id").alias("way_id"), F.explode("refs").alias("r"))
    return rows.select("way_id", F.col("r.pos").cast("bigint").alias("pos"), F.col("r.id").alias("node_id"))


@query("xml_without_empty", sql("fx_edges fx_members", "SELECT 'WAY' AS entity, count(DISTINCT way_id) AS n FROM fx_edges UNION ALL SELECT 'RELATION', count(DISTINCT rel_id) FROM fx_members"))
def xml_without_empty(spark, d):
    path = _osm(spark, d)
    both = xml.ways(spark, path).select(F.lit("WAY").alias("entity")).unionByName(xml.relations(spark, path).select(F.lit("RELATION").alias("entity")))
    return both.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("xml_members", sql("fx_members", "SELECT rel_id, pos, type, ref, role FROM fx_members"))
def xml_members(spark, d):
    return resolve.member_edges(xml.relations(spark, _osm(spark, d))).select("rel_id", long("pos"), "type", "ref", "role")


# Stores and tiles


def _ingested(spark, d) -> pipeline.Store:
    return pipeline.ingest(spark, bridge.entities(spark, d), fresh(spark))


@query("stored_entities", sql("fx_edges", "SELECT 'nodes' AS store, count(*) AS n FROM part UNION ALL SELECT 'ways', count(DISTINCT way_id) FROM fx_edges UNION ALL SELECT 'relations', count(*) FROM customer"))
def stored_entities(spark, d):
    """What an ingest leaves, over one that it replaces."""
    store = _ingested(spark, d)
    store.write("id_map", spark.range(1))
    store = pipeline.ingest(spark, bridge.entities(spark, d), store.path)
    out = [store.read(n).select(F.lit(n).alias("store")) for n in ("nodes", "ways", "relations", "id_map") if store.has(n)]
    return reduce(DataFrame.unionByName, out).groupBy("store").agg(F.count(F.lit(1)).alias("n"))


@query("stored_tags", sql("fx_node_tags fx_way_tags fx_rel_tags fx_edges", f"SELECT * FROM ({_ALL_TAGS}) WHERE NOT ({_DROPPED})"))
def stored_tags(spark, d):
    store = _ingested(spark, d)
    return reduce(DataFrame.unionByName, (exploded(store.read(n).withColumn("entity", F.lit(e)), "entity", "id") for n, e in (("nodes", "NODE"), ("ways", "WAY"), ("relations", "RELATION"))))


@query("stored_references", sql("fx_edges fx_members", "SELECT target_type, src_type, count(*) AS n FROM (SELECT DISTINCT 'NODE' AS target_type, node_id AS target_id, 'WAY' AS src_type, way_id AS src_id FROM fx_edges UNION ALL SELECT DISTINCT type, ref, 'RELATION', rel_id FROM fx_members) GROUP BY target_type, src_type"))
def stored_references(spark, d):
    store = pipeline.resolve_store(spark, _ingested(spark, d).path, multipolygons=False)
    return store.read("reverse_refs").distinct().groupBy("target_type", "src_type").agg(F.count(F.lit(1)).alias("n"))


@query("stored_tiles", sql("fx_way_wide fx_node_wide fx_edges fx_nodes", "SELECT layer, count(*) AS n FROM fx_shown WHERE zoom = 24 AND layer NOT IN ('boundary', 'roadLabel', 'roadMinorLabel') GROUP BY layer", LOC, BOX, WAYS.replace("= w.id)", "= w.id WHERE b.n > 1)"), SPOT, SHOWN))
def stored_tiles(spark, d):
    """Features in the tiles of the finest zoom, written and read back; of layers that take no tags over from boundaries."""
    store = pipeline.resolve_store(spark, _ingested(spark, d).path, multipolygons=False)
    out = pipeline.tile(spark, store.path, fresh(spark), lod=False, budget=200_000)
    rows = out.read("tiles").select("layer", "entity_type", "entity_id").distinct().where("layer NOT IN ('boundary', 'roadLabel', 'roadMinorLabel')")
    return rows.groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


# Stores, changes, scalars

#: Sixteen sizes from 8 to 1200, each about 1.4 times the one before.
_CLASSES = [8, 11, 16, 22, 30, 42, 60, 83, 116, 162, 226, 315, 440, 614, 859, 1200]
_CLASS = "CASE " + " ".join(f"WHEN size <= {c} THEN {c}" for c in _CLASSES) + " END"
_SIZES = "SELECT cast(8 + o_orderkey * 7919 % 1190 AS bigint) AS bytes FROM {orders}"


@query("chunk_size_histogram", "SELECT bytes AS size, count(*) AS n FROM (" + _SIZES.replace("{orders}", "orders") + ") GROUP BY bytes")
def chunk_size_histogram(spark, d):
    return tools.size_histogram(spark.sql(_SIZES, orders=spark.read.parquet(f"{d}/orders.parquet")))


@query("chunk_slack", f"SELECT cast(c AS bigint) AS class, count(*) AS n, cast(sum(c - size) AS bigint) AS slack FROM (SELECT size, {_CLASS} AS c FROM (SELECT bytes AS size FROM (" + _SIZES.replace("{orders}", "orders") + "))) GROUP BY c")
def chunk_slack(spark, d):
    return tools.slack(chunk_size_histogram(spark, d), _CLASSES)


@query("oversize_features", sql("fx_edges fx_way_tags", "SELECT e.way_id, cast(16 + 8 * e.n + coalesce(t.b, 0) AS bigint) AS bytes FROM (SELECT way_id, count(*) AS n FROM fx_edges GROUP BY way_id) e LEFT JOIN (SELECT id, sum(strlen(k) + strlen(v) + 2) AS b FROM fx_way_tags GROUP BY id) t ON t.id = e.way_id WHERE 16 + 8 * e.n + coalesce(t.b, 0) > 200"))
def oversize_features(spark, d):
    rows = projected(spark, d).select(F.col("id").alias("way_id"), geo.geometry_bytes(F.col("points"), F.col("tags")).alias("bytes"))
    return tools.oversize(rows, 200)


_CHANGES = "SELECT CASE event_id % 3 WHEN 0 THEN 'create' WHEN 1 THEN 'modify' ELSE 'delete' END AS change, CASE user_id % 3 WHEN 0 THEN 'NODE' WHEN 1 THEN 'WAY' ELSE 'RELATION' END AS entity, user_id AS id, cast(event_id % 100000 AS int) AS version FROM {events}"


@query("osmchange_counts", "SELECT change, entity, count(*) AS n FROM (" + _CHANGES.replace("{events}", "events") + ") GROUP BY change, entity")
def osmchange_counts(spark, d):
    return stream_changes.counts(spark.sql(_CHANGES, events=spark.read.parquet(f"{d}/events.parquet")))


@query("osmchange_scan", "SELECT change, entity, count(*) AS n, cast(sum(id) AS bigint) AS ids, cast(sum(version) AS bigint) AS versions FROM (" + _CHANGES.replace("{events}", "events") + ") GROUP BY change, entity")
def osmchange_scan(spark, d):
    """Counts of a change file, written from the events and read back."""
    rows = spark.sql(_CHANGES, events=spark.read.parquet(f"{d}/events.parquet"))
    element = F.format_string('<%s><%s id="%d" version="%d" lat="0" lon="0"/></%s>', "change", F.lower("entity"), "id", "version", "change")
    path = fresh(spark)
    xml.write(rows.select(element.alias("value")), path, "osmChange")
    return xml.changes(spark, path).groupBy("change", "entity").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.sum("version").cast("bigint").alias("versions"))


@query("changes_after_deletes", "SELECT entity, id, cast(version AS bigint) AS version FROM (SELECT *, row_number() OVER (PARTITION BY entity, id ORDER BY version DESC, CASE change WHEN 'delete' THEN 0 WHEN 'modify' THEN 1 ELSE 2 END) AS r FROM (" + _CHANGES.replace("{events}", "events") + ")) WHERE r = 1 AND change <> 'delete'")
def changes_after_deletes(spark, d):
    """What is left when the later half of the changes is applied first."""
    rows = spark.sql(_CHANGES, events=spark.read.parquet(f"{d}/events.parquet"))
    late = F.col("version") % 2 == 0
    state = stream_changes.applied(stream_changes.latest(rows.where(late)), rows.where(~late))
    return stream_changes.live(state).select("entity", "id", long("version"))


@query("changes_latest_version", "SELECT entity, id, cast(max(version) AS bigint) AS version FROM (" + _CHANGES.replace("{events}", "events") + ") GROUP BY entity, id")
def changes_latest_version(spark, d):
    return stream_changes.latest(spark.sql(_CHANGES, events=spark.read.parquet(f"{d}/events.parquet"))).select("entity", "id", long("version"))


@query("dirty_after_changes", sql("fx_edges fx_members", """SELECT DISTINCT src_type, src_id FROM (SELECT 'WAY' AS src_type, way_id AS src_id FROM fx_edges WHERE node_id % 50 = 0
    UNION ALL SELECT 'RELATION', rel_id FROM fx_members WHERE ref IN (SELECT way_id FROM fx_edges WHERE node_id % 50 = 0))"""))
def dirty_after_changes(spark, d):
    changed = bridge.nodes(spark, d).where("id % 50 = 0").select(F.lit("NODE").alias("entity"), "id")
    return stream_changes.dirty(resolve.reverse_refs(bridge.edges(spark, d), bridge.members(spark, d)), changed)


@query("varint_len", "SELECT cast(l_orderkey AS bigint) AS k, l_linenumber AS l, cast(l_partkey * l_orderkey * 131 AS bigint) AS value, cast(CASE WHEN l_partkey * l_orderkey = 0 THEN 1 ELSE ceil((floor(log2(l_partkey * l_orderkey * 131)) + 1) / 7e0) END AS bigint) AS size FROM lineitem")
def varint_len(spark, d):
    value = F.col("l_partkey") * F.col("l_orderkey") * 131
    return spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").cast("bigint").alias("k"), F.col("l_linenumber").alias("l"), value.alias("value"), geo.varuint_size(value).cast("bigint").alias("size"))


@query("degrees_to_int", sql("fx_nodes", "SELECT id, lat AS units FROM fx_nodes"))
def degrees_to_int(spark, d):
    text = (F.col("lat").cast("decimal(20,0)") / F.lit(10000000).cast("decimal(8,0)")).cast("decimal(12,7)").cast("string")
    return bridge.nodes(spark, d).select("id", geo.degrees(text).cast("bigint").alias("units"))


@query("parse_admin_level", sql("fx_way_wide", f"SELECT id, cast({_LEVEL.format('admin_level')} AS bigint) AS level FROM fx_way_wide"))
def parse_admin_level(spark, d):
    return bridge.way_tags(spark, d).select("id", T.admin_level(F.col("tags")).alias("level"))


@query("parse_layer", sql("fx_way_wide", f"SELECT id, {_ATOI.format('layer')} AS layer FROM fx_way_wide WHERE layer IS NOT NULL"))
def parse_layer(spark, d):
    return bridge.way_tags(spark, d).where(T.has(F.col("tags"), "layer")).select("id", T.leading_int(F.col("tags")["layer"]).alias("layer"))


@query("tag_union", sql("fx_way_wide", "SELECT id, coalesce(name, 'none') AS filled, 'over' AS overwritten FROM fx_way_wide"))
def tag_union(spark, d):
    tags = F.col("tags")
    filled = T.filled(tags, F.create_map(F.lit("name"), F.lit("none")))
    over = T.overwritten(tags, F.create_map(F.lit("name"), F.lit("over")))
    return bridge.way_tags(spark, d).select("id", filled["name"].alias("filled"), over["name"].alias("overwritten"))
