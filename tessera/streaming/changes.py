"""Changes as a stream: the latest version of every entity wins, and what refers to it is due again.

State is a folder of numbered batches, each with the buckets (by hash of entity and id) that it touched;
the newest of each bucket counts. A batch reads and writes the buckets of its changes only, and removes
what the batches before the last made of them, so a batch that is repeated after a failure leaves the
same state. Deleted entities stay as such: a late change of a lower version does not bring them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import CHANGES

#: Parts of the state that are rewritten on their own.
BUCKETS = 256
_ORDER = {"create": 0, "modify": 1, "delete": 2}


def counts(changes: DataFrame) -> DataFrame:
    """(change, entity, n)."""
    return changes.groupBy("change", "entity").agg(F.count(F.lit(1)).alias("n"))


def latest(changes: DataFrame) -> DataFrame:
    """Of each entity's changes the one of the highest version; of equals a delete, then a modify."""
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in _ORDER.items() for x in kv))[F.col("change")], F.lit(-1))
    last = F.max_by(F.struct(*changes.columns), F.struct(F.coalesce("version", F.lit(0)), rank)).alias("last")
    return changes.groupBy("entity", "id").agg(last).select("last.*")


def applied(state: DataFrame, changes: DataFrame) -> DataFrame:
    """state (schemas.CHANGES, deletes among them) after changes."""
    return latest(state.unionByName(changes.select(*state.columns)))


def live(state: DataFrame) -> DataFrame:
    """schemas.ENTITIES of a state: what is not deleted."""
    return state.where("change <> 'delete'").drop("change")


def dirty(reverse: DataFrame, changes: DataFrame) -> DataFrame:
    """(src_type, src_id) of ways and relations to resolve again: those that refer to a changed
    entity, and relations of such ways."""
    changed = changes.select(F.col("entity").alias("target_type"), F.col("id").alias("target_id")).distinct()
    first = reverse.join(changed, ["target_type", "target_id"], "left_semi").select("src_type", "src_id").distinct()
    ways = first.where("src_type = 'WAY'").select(F.col("src_type").alias("target_type"), F.col("src_id").alias("target_id"))
    second = reverse.join(ways, ["target_type", "target_id"], "left_semi").select("src_type", "src_id")
    return first.unionByName(second).distinct()


def stream(spark: SparkSession, source: str, state: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """Follows change files (schemas.CHANGES) in a folder and keeps the state up to date."""

    def step(batch: DataFrame, number: int) -> None:
        spark_ = batch.sparkSession
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64("entity", "id"), F.lit(BUCKETS)).cast("int"))
        touched = {str(r.bucket) for r in rows.select("bucket").distinct().collect()}  # BUCKETS at most
        held = _buckets(spark_, state, number)
        before = [f"{state}/{n[-1]}/bucket={b}" for b, n in held.items() if b in touched and n]
        old = spark_.read.schema(CHANGES).parquet(*before) if before else None
        out = latest(batch) if old is None else applied(old, batch)
        out = out.withColumn("bucket", F.pmod(F.xxhash64("entity", "id"), F.lit(BUCKETS)).cast("int"))
        out.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/{number:012d}")
        for b in touched & set(held):
            for n in held[b][:-1]:
                _remove(spark_, f"{state}/{n}/bucket={b}")

    changes = spark.readStream.schema(CHANGES).format(file_format).load(source)
    return changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _buckets(spark: SparkSession, state: str, before: int | None) -> dict[str, list[str]]:
    """The whole batches, in order, that hold each bucket; of those before a number if one is given."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(state).getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[str, list[str]] = {}
    if not fs.exists(path(state)):
        return out
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(state)))
    for n in names:
        if n.isdigit() and (before is None or int(n) < before) and fs.exists(path(f"{state}/{n}/_SUCCESS")):
            for s in fs.listStatus(path(f"{state}/{n}")):
                key, _, bucket = s.getPath().getName().partition("=")
                if key == "bucket":
                    out.setdefault(bucket, []).append(n)
    return out


def held(spark: SparkSession, state: str) -> DataFrame | None:
    """schemas.CHANGES: the last change of every entity, deletes among them."""
    paths = [f"{state}/{n[-1]}/bucket={b}" for b, n in _buckets(spark, state, None).items()]
    return spark.read.schema(CHANGES).parquet(*paths) if paths else None


def current(spark: SparkSession, state: str) -> DataFrame | None:
    """schemas.ENTITIES as they are now."""
    rows = held(spark, state)
    return None if rows is None else live(rows)
