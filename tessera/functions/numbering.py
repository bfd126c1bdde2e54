"""Dense numbers in order, without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sequence numbers of one bucket.
WIDTH = 1_000_000


def dense(df: DataFrame, order: str, name: str, first: int = 1, within: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """Adds gapless numbers by ascending `order`, a long, in each group of `within`.

    Rows are numbered inside buckets of `order // width`; a running sum over bucket counts (one
    small row a bucket) gives each bucket its start.
    """
    within = within or []
    keyed = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(float(width))))
    counts = keyed.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    own = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy(order))
    out = keyed.withColumn("_r", own).join(starts, [*within, "_bucket"])
    return out.withColumn(name, (F.col("_at") + F.col("_r") - 1 + first).cast("bigint")).drop("_bucket", "_at", "_r", "_n")
