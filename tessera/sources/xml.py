"""Map files and change files in XML, by Spark's own XML reader.

Schemas are given, never inferred: one child or many must read alike. The reader splits large files
by row tag, so every kind of entity is one distributed scan.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import degrees
from ..functions.tags import from_pairs

_TAG = "array<struct<_k:string,_v:string>>"
_NODE = f"_id bigint, _version int, _lat string, _lon string, tag {_TAG}"
_WAY = f"_id bigint, _version int, nd array<struct<_ref:bigint>>, tag {_TAG}"
_RELATION = f"_id bigint, _version int, member array<struct<_type:string,_ref:bigint,_role:string>>, tag {_TAG}"
_STRUCT = {"node": _NODE, "way": _WAY, "relation": _RELATION}
#: What a change file may do.
CHANGES = ("create", "modify", "delete")


def _rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("attributePrefix", "_").schema(schema).load(path)


def _tags(pairs: Column) -> Column:
    none = F.array().cast("array<struct<k:string,v:string>>")
    return from_pairs(F.coalesce(F.transform(pairs, lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v"))), none))


def nodes(spark: SparkSession, path: str) -> DataFrame:
    rows = _rows(spark, path, "node", _NODE)
    return rows.select(F.col("_id").alias("id"), F.coalesce("_version", F.lit(1)).alias("version"), degrees(F.col("_lat")).alias("lat"), degrees(F.col("_lon")).alias("lng"), _tags(F.col("tag")).alias("tags"))


def ways(spark: SparkSession, path: str) -> DataFrame:
    """Ways with a reference at least, not located yet."""
    rows = _rows(spark, path, "way", _WAY).where(F.size("nd") > 0)
    empty = F.lit(None).cast("int")
    refs = F.transform("nd", lambda r, i: F.struct((i + 1).cast("int").alias("pos"), r["_ref"].alias("id"), empty.alias("lat"), empty.alias("lng")))
    return rows.select(F.col("_id").alias("id"), F.coalesce("_version", F.lit(1)).alias("version"), refs.alias("refs"), _tags(F.col("tag")).alias("tags"))


def relations(spark: SparkSession, path: str) -> DataFrame:
    """Relations with a member at least."""
    rows = _rows(spark, path, "relation", _RELATION).where(F.size("member") > 0)
    members = F.transform("member", lambda m, i: F.struct((i + 1).cast("int").alias("pos"), F.upper(m["_type"]).alias("type"), m["_ref"].alias("ref"), F.coalesce(m["_role"], F.lit("")).alias("role")))
    return rows.select(F.col("_id").alias("id"), F.coalesce("_version", F.lit(1)).alias("version"), members.alias("members"), _tags(F.col("tag")).alias("tags"))


def changes(spark: SparkSession, path: str) -> DataFrame:
    """Rows of schemas.CHANGES: every entity in a create, modify or delete block."""
    inner = ", ".join(f"{k} array<struct<{_fields(v)}>>" for k, v in _STRUCT.items())
    out = None
    for change in CHANGES:
        rows = _rows(spark, path, change, inner)
        for entity in _STRUCT:
            own = _entity(rows.select(F.explode(entity).alias("e")).select("e.*"), change, entity)
            out = own if out is None else out.unionByName(own)
    return out


def write(lines: DataFrame, path: str, root: str = "osm") -> None:
    """Elements (value), each on a line, as files below path that are whole documents."""

    def run(batches):
        batch = lambda values: pa.RecordBatch.from_arrays([values], names=["value"])
        yield batch(pa.array([f"<{root}>"]))
        for b in batches:
            yield batch(b.column(0))
        yield batch(pa.array([f"</{root}>"]))

    lines.select("value").mapInArrow(run, "value string").write.text(path)


def _fields(schema: str) -> str:
    """A column list as the fields of a struct."""
    out, depth, part = [], 0, ""
    for c in schema + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, _, kind = part.strip().partition(" ")
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return ",".join(out)


def _entity(rows: DataFrame, change: str, entity: str) -> DataFrame:
    has = set(rows.columns)
    number = lambda name: degrees(F.col(name)) if name in has else F.lit(None).cast("int")
    refs = F.transform("nd", lambda r: r["_ref"]) if "nd" in has else F.lit(None).cast("array<bigint>")
    kind = "array<struct<type:string,ref:bigint,role:string>>"
    members = F.transform("member", lambda m: F.struct(F.upper(m["_type"]).alias("type"), m["_ref"].alias("ref"), F.coalesce(m["_role"], F.lit("")).alias("role"))) if "member" in has else F.lit(None)
    return rows.select(
        F.lit(change).alias("change"), F.lit(entity.upper()).alias("entity"), F.col("_id").alias("id"), F.coalesce("_version", F.lit(1)).alias("version"),
        number("_lat").alias("lat"), number("_lon").alias("lng"), refs.alias("refs"), members.cast(kind).alias("members"), _tags(F.col("tag")).alias("tags"),
    )
