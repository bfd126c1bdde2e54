"""From map files to tiles in three steps, each from Parquet stores to Parquet stores.

    ingest   nodes, ways, relations without the tags that no map shows, ids renumbered if asked
    resolve  located ways, reverse references, multipolygons
    tile     features by layer and zoom, simplified, in quadtree leaves

A step overwrites what it makes and reads nothing of it, so it can be repeated after a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import tags as T
from ..functions.numbering import dense
from ..operators import layers, multipolygon, quadtree, remap, resolve, simplify
from ..sources import pbf

#: Places within a row, more than any has references.
SPAN = 1 << 20
#: Tables of each step.
INGESTED = ("entities", "id_map", "nodes", "ways", "relations", "refused")
RESOLVED = ("located_ways", "missing_nodes", "reverse_refs", "rings", "ring_warnings", "multipolygons")
TILED = ("features", "tile_index", "tiles")


@dataclass(frozen=True)
class Store:
    """Tables of one folder."""

    spark: SparkSession
    path: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        df = df.repartitionByRange(F.col(by)) if by else df
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.read(name)

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        place, files = self._place(name)
        return files.exists(place)

    def drop(self, *names: str) -> None:
        for name in names:
            place, files = self._place(name)
            files.delete(place, True)


def mentions(entities: DataFrame) -> DataFrame:
    """(entity, old_id, seq) of entities (seq, …): each row before what it refers to."""
    own = F.array(F.struct(F.col("entity").alias("e"), F.col("id").alias("i")))
    refs = F.coalesce(F.transform("refs", lambda r: F.struct(F.lit("NODE").alias("e"), r.alias("i"))), F.array().cast("array<struct<e:string,i:bigint>>"))
    members = F.coalesce(F.transform("members", lambda m: F.struct(m["type"].alias("e"), m["ref"].alias("i"))), F.array().cast("array<struct<e:string,i:bigint>>"))
    rows = entities.select("seq", F.posexplode(F.concat(own, refs, members)).alias("k", "m"))
    return rows.select(F.col("m.e").alias("entity"), F.col("m.i").alias("old_id"), (F.col("seq") * SPAN + F.col("k")).alias("seq"))


def renumbered(entities: DataFrame, ids: DataFrame) -> DataFrame:
    """Entities with every id, reference and member by the map; order is kept by position."""
    own = ids.select("entity", F.col("old_id").alias("id"), "new_id")
    out = entities.join(own, ["entity", "id"])
    nodes = ids.where("entity = 'NODE'").select(F.col("old_id").alias("r"), F.col("new_id").alias("n"))
    refs = entities.where("entity = 'WAY'").select(F.col("id").alias("w"), F.posexplode("refs").alias("k", "r")).join(nodes, "r")
    refs = refs.groupBy("w").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]).alias("new_refs"))
    kinds = ids.select(F.col("entity").alias("t"), F.col("old_id").alias("r"), F.col("new_id").alias("n"))
    parts = entities.where("entity = 'RELATION'").select(F.col("id").alias("w"), F.posexplode("members").alias("k", "m"))
    parts = parts.select("w", "k", F.col("m.type").alias("t"), F.col("m.ref").alias("r"), F.col("m.role").alias("role")).join(kinds, ["t", "r"])
    parts = parts.groupBy("w").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "t", "n", "role"))), lambda x: F.struct(x["t"].alias("type"), x["n"].alias("ref"), x["role"].alias("role"))).alias("new_members"))
    out = out.join(refs, (F.col("entity") == "WAY") & (F.col("id") == refs.w), "left").drop("w").join(parts, (F.col("entity") == "RELATION") & (F.col("id") == parts.w), "left").drop("w")
    return out.select("entity", F.col("new_id").alias("id"), "version", "lat", "lng", F.col("new_refs").alias("refs"), F.col("new_members").alias("members"), "tags")


def ingest(spark: SparkSession, entities: DataFrame, dest: str, renumber: bool = False) -> Store:
    """Stores of schemas.ENTITIES rows. Ids that are not positive, and nodes outside the world, go to
    `refused` instead of ending the run. What an earlier run left there goes first."""
    store = Store(spark, dest)
    store.drop(*INGESTED, *RESOLVED)
    fine = F.coalesce((F.col("id") > 0) & ((F.col("entity") != "NODE") | geo.in_range(F.col("lat"), F.col("lng"))), F.lit(False))
    store.write("refused", entities.where(~fine).select("entity", "id", "version", "lat", "lng"))
    rows = entities.where(fine)
    if renumber:
        # File order, by partition and row, made lasting before ids depend on it.
        rows = store.write("entities", rows.withColumn("seq", F.monotonically_increasing_id()))
        ids = remap.id_map(mentions(dense(rows, "seq", "seq_no").drop("seq").withColumnRenamed("seq_no", "seq")), remap.BUCKET * SPAN)
        rows = renumbered(rows.drop("seq"), store.write("id_map", ids))
    rows = rows.withColumn("tags", T.kept(F.coalesce("tags", F.create_map().cast("map<string,string>"))))
    store.write("nodes", pbf.nodes(rows), "id")
    store.write("ways", pbf.ways(rows), "id")
    store.write("relations", pbf.relations(rows), "id")
    if renumber:
        store.drop("entities")
    return store


def resolve_store(spark: SparkSession, path: str, multipolygons: bool = True, references: bool = True, updates: bool = True) -> Store:
    """Adds located ways, reverse references and multipolygons to a store."""
    store = Store(spark, path)
    relations = store.read("relations")
    members = resolve.member_edges(relations)
    if references:
        ways, nodes = store.read("ways"), store.read("nodes")
        located = store.write("located_ways", resolve.locate(ways, nodes), "id")
        store.write("missing_nodes", resolve.missing_nodes(resolve.way_edges(ways), nodes))
        reverse = resolve.reverse_refs(resolve.way_edges(ways), members)
        if not updates:
            reverse = reverse.where("target_type = 'WAY'")
        store.write("reverse_refs", reverse)
    else:
        located = store.read("located_ways")
    if multipolygons:
        copies = resolve.way_copies(members, relations, located)
        built = store.write("rings", multipolygon.assemble_relations(copies))
        store.write("ring_warnings", multipolygon.warnings(built))
        store.write("multipolygons", multipolygon.tagged(built, relations, members, located))
    return store


def features(ways: DataFrame, relations: DataFrame, polygons: DataFrame | None, nodes: DataFrame, lod: bool = True, outer_ways: bool = True) -> DataFrame:
    """Rows by layer and zoom: layer, zoom, entity_type, entity_id, part (of a relation), geom_kind, z_index, tags, rings, bbox, bytes."""
    members = resolve.member_edges(relations)
    if polygons is not None and not outer_ways:
        ways = resolve.without_outer_ways(ways, polygons)
    ways = resolve.with_boundary_tags(ways, members, relations).where(F.size("refs") >= 2)
    lines = ways.select(F.lit("WAY").alias("entity_type"), F.col("id").alias("entity_id"), F.lit(0).alias("part"), geo.is_closed(F.col("refs")).alias("closed"), F.array(geo.project(F.col("refs"))).alias("rings"), "tags")
    parts = [layers.classified(lines.where(F.size(F.col("rings")[0]) >= 2), layers.WAY_LAYERS, "closed", lod)]
    if polygons is not None:
        shapes = polygons.select(F.lit("RELATION").alias("entity_type"), F.col("rel_id").alias("entity_id"), F.col("poly_no").alias("part"), F.lit(True).alias("closed"), "rings", "tags")
        # Relations are polygons in every layer, area or not, and simplified as such.
        parts.append(layers.classified(shapes, layers.WAY_LAYERS, "closed", lod))
    shaped = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kind = F.when((F.col("entity_type") == "RELATION") | F.col("area"), F.lit("POLYGON")).otherwise(F.lit("LINE"))
    shaped = simplify.pyramids(shaped.withColumn("geom_kind", kind).withColumn("area", F.col("geom_kind") == "POLYGON").drop("closed", "level"), lod)
    points = nodes.where(F.size("tags") > 0).where(geo.in_range(F.col("lat"), F.col("lng")))
    spot = F.array(F.array(F.struct(geo.mercator_x(F.col("lng")).alias("x"), geo.mercator_y(F.col("lat")).alias("y"))))
    spots = points.select(F.lit("NODE").alias("entity_type"), F.col("id").alias("entity_id"), F.lit(0).alias("part"), spot.alias("rings"), "tags")
    placed = layers.by_zoom(layers.classified(spots, layers.POINT_LAYERS, None, lod)).withColumn("geom_kind", F.lit("POINT")).drop("level")
    out = shaped.unionByName(placed.select(*shaped.columns)).drop("area")
    flat = F.flatten("rings")
    return out.withColumn("bbox", geo.bounds(flat)).withColumn("bytes", geo.geometry_bytes(flat, F.col("tags"))).where(geo.valid(F.col("bbox")))


def tile(spark: SparkSession, source: str, dest: str, lod: bool = True, budget: int = quadtree.LEAF_BYTES, outer_ways: bool = True) -> Store:
    """Features and their tiles below dest: `features`, `tile_index`, and `tiles` by layer, zoom and tile."""
    store, out = Store(spark, source), Store(spark, dest)
    polygons = store.read("multipolygons") if store.has("multipolygons") else None
    out.drop(*TILED)
    rows = features(store.read("located_ways"), store.read("relations"), polygons, store.read("nodes"), lod, outer_ways)
    key = ["layer", "zoom", "entity_type", "entity_id", "part"]
    rows = out.write("features", rows)
    held, index = quadtree.leaves(rows, key, ["layer", "zoom"], budget)
    out.write("tile_index", index)
    quadtree.write(rows.drop("bytes").join(held, key), f"{dest}/tiles")
    return out
