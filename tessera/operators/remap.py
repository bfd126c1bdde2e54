"""Dense new ids in the order in which old ones are first mentioned, by kind of entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import WIDTH as BUCKET
from ..functions.numbering import dense


def id_map(mentions: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(entity, old_id, new_id) of mentions (entity, old_id, seq): entities and references alike.

    Of an id's mentions only the first counts, by partial minima, so no group is gathered.
    bucket: the span of seq that is numbered in one task.
    """
    first = mentions.groupBy("entity", "old_id").agg(F.min("seq").alias("seq"))
    return dense(first, "seq", "new_id", within=["entity"], width=bucket).select("entity", "old_id", "new_id")


def renamed(df: DataFrame, ids: DataFrame, entity: str, column: str) -> DataFrame:
    """df with a column of old ids as new ones."""
    own = ids.where(F.col("entity") == entity).select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new"))
    return df.join(own, F.col(column) == F.col("_old")).withColumn(column, F.col("_new")).drop("_old", "_new")


def original(ids: DataFrame, entity: str, new_id: int, site: str = "https://www.openstreetmap.org") -> DataFrame:
    """(old_id, url) of a new id."""
    found = ids.where((F.col("entity") == entity) & (F.col("new_id") == new_id))
    return found.select("old_id", F.concat(F.lit(f"{site}/{entity.lower()}/"), F.col("old_id").cast("string")).alias("url"))


def highest(ids: DataFrame) -> DataFrame:
    return ids.groupBy("entity").agg(F.max("new_id").alias("highest"))
