"""Connected components of a distributed edge list, by alternating large and small stars.

Every round writes its edges to the shared folder, so lineage stays short and a lost executor costs
one round's work. Hubs are never gathered: minima are partial aggregates, and edges of a hub meet
its minimum in a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: Rounds after which something must be wrong: they grow as the logarithm of the longest chain.
ROUNDS = 64


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v) with u > v."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every u but the roots in an edge: root is the least of its component.

    edges: longs (a, b) in any order; loops and repeats are ignored; no edge gives no row.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(now)
    state = None
    for _ in range(ROUNDS):
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not mark.n or (mark.n, mark.h) == state:
            return now.select("u", F.col("v").alias("root"))
        state, before = (mark.n, mark.h), now
        now = written(_star(_star(now, True), False))
        discard(before)
    raise RuntimeError("components did not settle")
