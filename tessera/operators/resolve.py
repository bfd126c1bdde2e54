"""References between entities: location of ways, reverse references, members, boundaries.

Everything is one edge table, joins on ids, and regrouping by position. Nothing is broadcast by
hand: adaptive execution turns joins with small sides into broadcasts by their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, tags

_NO_REFS = "array<struct<pos:int,id:bigint,lat:int,lng:int>>"


def way_edges(ways: DataFrame) -> DataFrame:
    """(way_id, pos, node_id) of every reference."""
    return ways.select(F.col("id").alias("way_id"), F.explode("refs").alias("r")).select("way_id", F.col("r.pos").alias("pos"), F.col("r.id").alias("node_id"))


def locate(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways with the positions of their references, in order; one that is missing stays null."""
    found = locate_edges(way_edges(ways), nodes)
    refs = F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), F.col("node_id").alias("id"), "lat", "lng"))).alias("refs")
    grouped = found.groupBy("way_id").agg(refs)
    rest = ways.select("id", "version", "tags")
    return rest.join(grouped, rest.id == grouped.way_id, "left").select("id", "version", F.coalesce("refs", F.array().cast(_NO_REFS)).alias("refs"), "tags")


def locate_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (…, node_id) with lat and lng, null where the node is missing."""
    places = nodes.select(F.col("id").alias("_id"), "lat", "lng")
    return edges.join(places, edges.node_id == places._id, "left").drop("_id")


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges to nodes that are not there."""
    places = nodes.select(F.col("id").alias("_id"))
    return edges.join(places, edges.node_id == places._id, "left_anti")


def member_edges(relations: DataFrame) -> DataFrame:
    """(rel_id, pos, type, ref, role) of every member."""
    rows = relations.select(F.col("id").alias("rel_id"), F.explode("members").alias("m"))
    return rows.select("rel_id", "m.pos", "m.type", "m.ref", "m.role")


def reverse_refs(edges: DataFrame, members: DataFrame) -> DataFrame:
    """(target_type, target_id, src_type, src_id), each once: who refers to whom."""
    by_ways = edges.select(F.lit("NODE").alias("target_type"), F.col("node_id").alias("target_id"), F.lit("WAY").alias("src_type"), F.col("way_id").alias("src_id"))
    by_relations = members.select(F.col("type").alias("target_type"), F.col("ref").alias("target_id"), F.lit("RELATION").alias("src_type"), F.col("rel_id").alias("src_id"))
    return by_ways.unionByName(by_relations).distinct()


def referring(reverse: DataFrame, target_type: str, src_type: str | None = None) -> DataFrame:
    """(target_id, src) with the ascending ids that refer to each target."""
    rows = reverse.where(F.col("target_type") == target_type)
    rows = rows if src_type is None else rows.where(F.col("src_type") == src_type)
    return rows.groupBy("target_id").agg(F.sort_array(F.collect_set(F.struct("src_type", "src_id"))).alias("src"))


def renderable(relations: DataFrame) -> DataFrame:
    return relations.where(tags.value(F.col("tags"), "type") == "multipolygon")


def boundaries(relations: DataFrame) -> DataFrame:
    return relations.where(tags.value(F.col("tags"), "type") == "boundary")


def way_copies(members: DataFrame, relations: DataFrame, ways: DataFrame) -> DataFrame:
    """(rel_id, pos, role, way_id, refs, tags): valid way members of multipolygons, first ones only."""
    own = members.where("type = 'WAY'").join(renderable(relations).select(F.col("id").alias("rel_id")), "rel_id", "left_semi")
    w = ways.where(F.size("refs") > 0).select(F.col("id").alias("way_id"), "refs", "tags")
    found = own.join(w, own.ref == w.way_id)
    return first_members(found).select("rel_id", "pos", "role", "way_id", "refs", "tags")


def first_members(members: DataFrame) -> DataFrame:
    """Of members that repeat in a relation, the first."""
    nth = F.row_number().over(Window.partitionBy("rel_id", "ref").orderBy("pos"))
    return members.withColumn("_n", nth).where("_n = 1").drop("_n")


def unique_outer(members: DataFrame) -> DataFrame:
    """(rel_id, n_outer, outer_ref): the one outer member, null where there are others or none."""
    outer = F.col("role") == "outer"
    out = members.groupBy("rel_id").agg(F.count_if(outer).alias("n_outer"), F.max(F.when(outer, F.col("ref"))).alias("one"))
    return out.select("rel_id", "n_outer", F.when(F.col("n_outer") == 1, F.col("one")).alias("outer_ref"))


def with_boundary_tags(ways: DataFrame, members: DataFrame, relations: DataFrame) -> DataFrame:
    """Ways with tags taken over from the boundary relations they are in, by ascending relation id.

    Only ways in a boundary go through the fold; the others keep their partitions' rows as they are.
    """
    b = boundaries(relations).select(F.col("id").alias("rel_id"), F.col("tags").alias("btags"))
    pairs = members.where("type = 'WAY'").select(F.col("ref").alias("way_id"), "rel_id").distinct().join(b, "rel_id")
    grouped = pairs.groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("rel_id", F.map_entries("btags").alias("e")))).alias("bs"))
    maps = F.transform("bs", lambda s: F.map_from_entries(s["e"]))
    joined = ways.join(grouped, ways.id == grouped.way_id, "left")
    folded = F.when(F.col("bs").isNull(), F.col("tags")).otherwise(tags.with_boundaries(F.col("tags"), maps))
    return joined.withColumn("tags", folded).drop("way_id", "bs")


def without_outer_ways(ways: DataFrame, multipolygons: DataFrame) -> DataFrame:
    """Ways that no multipolygon was made of."""
    used = multipolygons.select(F.explode("way_ids").alias("used")).distinct()
    return ways.join(used, ways.id == used.used, "left_anti")


def relation_bounds(edges: DataFrame) -> DataFrame:
    """(rel_id, diagonal) of located edges (rel_id, lat, lng)."""
    box = F.struct(F.min("lat").alias("xmin"), F.max("lat").alias("xmax"), F.min("lng").alias("ymin"), F.max("lng").alias("ymax"))
    return edges.where("lat IS NOT NULL").groupBy("rel_id").agg(box.alias("box")).select("rel_id", geo.diagonal(F.col("box")).alias("diagonal"))
