"""Pieces the training-data operators share: table reading, shared storage, distributed numbering."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.storage import fresh

#: Rows of an Arrow batch. Batches count rows, not bytes: at Spark's 10,000, whole texts make tens of
#: MB outside the heap, several times for each task.
BATCH_ROWS = 2000
#: Rows that one numbering bucket aims at; buckets grow in number, not in size.
ROWS_PER_BUCKET = 200_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; others, whatever they are called, are left unread."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows of an Arrow batch to BATCH_ROWS, if they are more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, which driver and executors share."""
    return fresh(spark)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: read again, it has no lineage to recompute."""
    spark = df.sparkSession
    small_batches(spark)
    path = shared_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(table_: DataFrame) -> None:
    """Deletes a written table that nothing will read again."""
    spark = table_.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(table_.written_to)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def map_texts(
    df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """mapInArrow with what `start` prepares once a task, over batches cut to a few MB of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in cut(batch):
                yield from work(part)
        pa.default_memory_pool().release_unused()  # workers live on, and the next task may need little

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def cut(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes, a row at least."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, int(rows * most / max(batch.nbytes, 1)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def strings(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET, least: int = 64) -> int:
    """How many buckets keep `rows` rows at about `per_bucket` each."""
    return max(least, -(-rows // per_bucket))


def numbered(
    df: DataFrame, within: list[str], bucket: Column, order: list[Column], name: str = "slot", start: int = 0
) -> DataFrame:
    """Gapless numbers from `start` in each group of `within`, by bucket and then `order`.

    No group is ever gathered: the window runs over (group, bucket), and each bucket gets its
    start from a running sum over bucket counts. df is read twice: give it a written or cheap one.
    """
    keyed = df.withColumn("_b", bucket)
    w = Window.partitionBy(*within, "_b").orderBy(*order)
    counts = keyed.groupBy(*within, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*within, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    ranked = keyed.withColumn("_r", F.row_number().over(w))
    on = [ranked[c].eqNullSafe(starts[c]) for c in [*within, "_b"]]
    out = ranked.join(starts, on).select(*[ranked[c] for c in df.columns], (F.col("_at") + F.col("_r") - 1 + start).cast("long").alias(name))
    return out
