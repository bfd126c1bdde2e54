"""Business tables as map entities: one statement of each, for Spark and as SQL.

Parts become nodes, orders ways (their lines the references), customers relations (their orders the
members). Tags are SQL expressions over the base table; an absent tag is null. Expressions are such
that Spark and DuckDB read them alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_TAGS = {
    "place": "CASE WHEN p_partkey % 4 = 0 THEN 'town' WHEN p_partkey % 4 = 1 THEN 'village' END",
    "population": "CASE WHEN p_partkey % 8 < 4 THEN cast(p_size * 1000 AS string) WHEN p_partkey % 8 = 4 THEN 'many' END",
    "addr:housenumber": "CASE WHEN p_partkey % 3 = 0 THEN cast(p_size AS string) END",
    "name": "CASE WHEN p_partkey % 2 = 0 THEN p_name END",
    "source": "CASE WHEN p_partkey % 5 = 0 THEN p_brand END",
    "tiger:county": "CASE WHEN p_partkey % 7 = 0 THEN p_type END",
    "NHD_id": "CASE WHEN p_partkey % 11 = 0 THEN 'x' END",
}
WAY_TAGS = {
    "highway": "CASE o_orderkey % 9 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary' WHEN 2 THEN 'residential' WHEN 3 THEN 'service' WHEN 4 THEN 'steps' WHEN 5 THEN 'proposed' WHEN 6 THEN 'pedestrian' END",
    "railway": "CASE WHEN o_orderkey % 9 IN (5, 7) AND o_orderkey % 2 = 0 THEN 'rail' WHEN o_orderkey % 9 = 7 THEN 'tram' WHEN o_orderkey % 37 = 0 THEN 'station' END",
    "building": "CASE o_orderkey % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'house' END",
    "landuse": "CASE o_orderkey % 6 WHEN 0 THEN 'forest' WHEN 1 THEN 'basin' WHEN 2 THEN 'meadow' WHEN 3 THEN 'other' END",
    "natural": "CASE o_orderkey % 10 WHEN 0 THEN 'water' WHEN 1 THEN 'wood' WHEN 2 THEN 'cliff' END",
    "leisure": "CASE o_orderkey % 8 WHEN 0 THEN 'park' WHEN 1 THEN 'nature_reserve' WHEN 2 THEN 'wetland' END",
    "waterway": "CASE o_orderkey % 12 WHEN 0 THEN 'river' WHEN 1 THEN 'stream' WHEN 2 THEN 'ditch' WHEN 3 THEN 'riverbank' END",
    "barrier": "CASE WHEN o_orderkey % 13 = 1 THEN 'ditch' END",
    "amenity": "CASE WHEN o_orderkey % 29 = 0 THEN 'school' END",
    "place": "CASE WHEN o_orderkey % 23 = 0 THEN 'island' END",
    "area": "CASE WHEN o_orderkey % 18 = 6 THEN 'yes' END",
    "tourism": "CASE WHEN o_orderkey % 19 = 0 THEN 'zoo' END",
    "aeroway": "CASE o_orderkey % 17 WHEN 0 THEN 'terminal' WHEN 1 THEN 'apron' END",
    "boundary": "CASE WHEN o_orderkey % 5 = 0 THEN 'administrative' END",
    "admin_level": "CASE WHEN o_orderkey % 5 = 0 THEN cast(o_orderkey % 12 AS string) WHEN o_orderkey % 35 = 1 THEN '4;5' END",
    "name": "CASE WHEN o_orderkey % 2 = 0 THEN concat('way ', cast(o_orderkey % 100 AS string)) END",
    "ref": "CASE WHEN o_orderkey % 4 = 1 THEN 'A1' END",
    "oneway": "CASE WHEN o_orderkey % 8 = 1 THEN 'yes' END",
    "layer": "CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 5 - 2 AS string) WHEN o_orderkey % 3 = 1 THEN '2;3' END",
    "bridge": "CASE WHEN o_orderkey % 11 = 0 THEN 'yes' WHEN o_orderkey % 11 = 1 THEN 'no' END",
    "tunnel": "CASE WHEN o_orderkey % 13 = 0 THEN '1' END",
    "source": "CASE WHEN o_orderkey % 5 = 1 THEN 'survey' END",
    "tiger:reviewed": "CASE WHEN o_orderkey % 7 = 0 THEN 'no' END",
}
RELATION_TAGS = {
    "type": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'multipolygon' ELSE 'boundary' END",
    "admin_level": "CASE WHEN c_mktsegment <> 'BUILDING' AND c_custkey % 7 > 0 THEN cast(c_nationkey % 10 + 1 AS string) END",
    "name": "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END",
    "landuse": "CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0 THEN 'forest' END",
}
#: Statements by name; braces name base tables.
SQL = {
    "fx_nodes": """SELECT cast(p_partkey + 1 AS bigint) AS id, cast(((p_partkey * 7919 * 1013) % 1700000001) - 850000000 AS bigint) AS lat,
        cast(((p_partkey * 104729 * 997) % 3600000001) - 1800000000 AS bigint) AS lng FROM {part}""",
    "fx_open": """SELECT cast(l_orderkey + 1 AS bigint) AS way_id,
        cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS bigint) AS pos,
        cast(l_partkey + 1 AS bigint) AS node_id FROM {lineitem}""",
    # Every other way ends where it began.
    "fx_edges": """SELECT way_id, pos, node_id FROM {fx_open} UNION ALL
        SELECT a.way_id, b.n + 1 AS pos, a.node_id FROM {fx_open} a
        JOIN (SELECT way_id, count(*) AS n FROM {fx_open} GROUP BY way_id) b ON a.way_id = b.way_id WHERE a.pos = 1 AND a.way_id % 2 = 0""",
    "fx_members": """SELECT cast(c_custkey + 1 AS bigint) AS rel_id,
        cast(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS bigint) AS pos, 'WAY' AS type,
        cast(o_orderkey + 1 AS bigint) AS ref, CASE WHEN o_orderkey % 2 = 0 THEN 'outer' ELSE 'inner' END AS role
        FROM {customer} JOIN {orders} ON o_custkey = c_custkey""",
}
BASES = {"fx_node_tags": ("part", "p_partkey + 1", NODE_TAGS), "fx_way_tags": ("orders", "o_orderkey + 1", WAY_TAGS), "fx_rel_tags": ("customer", "c_custkey + 1", RELATION_TAGS)}


def with_clause(*names: str) -> str:
    """WITH of the named statements and those that they need, for a database that has the base
    tables; fx_…_tags have columns id, k, v, and fx_…_wide a column for each tag."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name in SQL:
            for other in SQL:
                if f"{{{other}}}" in SQL[name]:
                    add(other)
            done[name] = SQL[name].replace("{", "").replace("}", "")
        else:
            base, key, tags = BASES[name.replace("_wide", "_tags")]
            if name.endswith("_wide"):
                columns = ", ".join(f'{expr} AS "{tag}"' for tag, expr in tags.items())
                done[name] = f"SELECT cast({key} AS bigint) AS id, {columns} FROM {base}"
            else:
                rows = " UNION ALL ".join(f"SELECT cast({key} AS bigint) AS id, '{tag}' AS k, {expr} AS v FROM {base}" for tag, expr in tags.items())
                done[name] = f"SELECT * FROM ({rows}) t WHERE v IS NOT NULL"

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in done.items()) + "\n"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the statements as a DataFrame."""
    text = SQL[name]
    used = {n: view(spark, sf_dir, n) if n in SQL else _table(spark, sf_dir, n) for n in (*SQL, "part", "lineitem", "customer", "orders") if f"{{{n}}}" in text}
    return spark.sql(text, **used)


def _tags(table: str):
    base, key, tags = BASES[table]
    pairs = F.create_map(*(x for tag, expr in tags.items() for x in (F.lit(tag), F.expr(expr))))
    return base, F.expr(f"cast({key} AS bigint)").alias("id"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("tags")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, key, tags = _tags("fx_node_tags")
    place = [F.expr(f"cast(((p_partkey * {a}) % {m}) - {h} AS int)").alias(n) for n, a, m, h in (("lat", "7919 * 1013", 1700000001, 850000000), ("lng", "104729 * 997", 3600000001, 1800000000))]
    return _table(spark, sf_dir, base).select(key, F.lit(1).alias("version"), *place, tags)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_edges")


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways whose references are not located yet."""
    none = F.lit(None).cast("int")
    refs = F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), F.col("node_id").alias("id"), none.alias("lat"), none.alias("lng")))).alias("refs")
    grouped = edges(spark, sf_dir).groupBy(F.col("way_id").alias("id")).agg(refs)
    base, key, tags = _tags("fx_way_tags")
    return _table(spark, sf_dir, base).select(key, F.lit(1).alias("version"), tags).join(grouped, "id").select("id", "version", "refs", "tags")


def way_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, tags) of all ways, references or not."""
    base, key, tags = _tags("fx_way_tags")
    return _table(spark, sf_dir, base).select(key, tags)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_members")


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, version, tags); members are a table of their own."""
    base, key, tags = _tags("fx_rel_tags")
    return _table(spark, sf_dir, base).select(key, F.lit(1).alias("version"), tags)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of them as schemas.ENTITIES."""
    kind = "array<struct<type:string,ref:bigint,role:string>>"
    none = {"lat": F.lit(None).cast("int"), "lng": F.lit(None).cast("int"), "refs": F.lit(None).cast("array<bigint>"), "members": F.lit(None).cast(kind)}

    def rows(df: DataFrame, entity: str, **own):
        columns = [(own.get(c, v)).alias(c) for c, v in none.items()]
        return df.select(F.lit(entity).alias("entity"), "id", F.lit(1).alias("version"), *columns, "tags")

    grouped = members(spark, sf_dir).groupBy(F.col("rel_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("pos", "type", "ref", "role"))).alias("m"))
    parts = F.transform("m", lambda x: F.struct(x["type"].alias("type"), x["ref"].alias("ref"), x["role"].alias("role")))
    found = rows(nodes(spark, sf_dir), "NODE", lat=F.col("lat"), lng=F.col("lng"))
    found = found.unionByName(rows(ways(spark, sf_dir), "WAY", refs=F.transform("refs", lambda r: r["id"])))
    return found.unionByName(rows(relations(spark, sf_dir).join(grouped, "id", "left"), "RELATION", members=parts.cast(kind)))


def xml_lines(rows: DataFrame) -> DataFrame:
    """(value): each entity as an element of a map file, on a line."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    degrees = lambda c: (c.cast("decimal(20,0)") / F.lit(10000000).cast("decimal(8,0)")).cast("decimal(12,7)").cast("string")
    joined = lambda items: F.coalesce(F.array_join(items, ""), F.lit(""))
    place = F.when(F.col("entity") == "NODE", F.format_string(' lat="%s" lon="%s"', degrees(F.col("lat")), degrees(F.col("lng")))).otherwise("")
    refs = joined(F.transform("refs", lambda r: F.concat(F.lit('<nd ref="'), r.cast("string"), F.lit('"/>'))))
    parts = joined(F.transform("members", lambda m: F.concat(F.lit('<member type="'), F.lower(m["type"]), F.lit('" ref="'), m["ref"].cast("string"), F.lit('" role="'), escaped(m["role"]), F.lit('"/>'))))
    tags = joined(F.transform(F.map_entries("tags"), lambda t: F.concat(F.lit('<tag k="'), escaped(t["key"]), F.lit('" v="'), escaped(t["value"]), F.lit('"/>'))))
    name = F.lower("entity")
    head = F.concat(F.lit("<"), name, F.lit(' id="'), F.col("id").cast("string"), F.lit('" version="'), F.col("version").cast("string"), F.lit('"'), place, F.lit(">"))
    return rows.select(F.concat(head, refs, parts, tags, F.lit("</"), name, F.lit(">")).alias("value"))
