"""Shards by a hierarchical weighted hash tree.

A key descends region, rack and shard. At each level every child draws -ln(u) / weight, u hashed
from the key and the child's name, and the least draw wins. A child's draws depend on nothing but
its own name and weight, so a changed weight moves keys only into or out of that subtree. A weight
is the sum of the weights below it.

A tree starts with some shards, dealt evenly to regions and racks whatever their number. Each shard
added later opens a region of its own: keys move into the new shard and nowhere else. (In a rack, its
weight would also draw keys into its neighbours.)

Cases: null keys take the same place each time; equal keys share a shard; an empty table gives an
empty result; columns that are not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, numbered



@dataclass(frozen=True)
class Node:
    """A part of the tree: a shard has a number, anything else has children."""

    name: str
    own: float = 1.0
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def topology(shards: int, weights: list[float] | None = None, first: int | None = None) -> Node:
    """The tree of `shards` shards: the `first` of them (all, by default) in as many regions as a region
    has racks and a rack shards, about; each further one in a region of its own."""
    weights, first = weights or [1.0] * shards, min(shards, first or shards)
    wide = 1
    while wide**3 < first:
        wide += 1

    def leaf(i):
        return Node(f"shard-{i}", weights[i], shard=i)

    def split(numbers):
        """Runs of numbers, as even as can be."""
        n = min(wide, len(numbers))
        return [numbers[k * len(numbers) // n : (k + 1) * len(numbers) // n] for k in range(n)]

    def region(r, racks):
        return Node(f"region-{r}", children=tuple(Node(f"region-{r}/rack-{k}", children=tuple(map(leaf, own))) for k, own in enumerate(racks)))

    regions = [region(r, split(own)) for r, own in enumerate(split(list(range(first))))]
    regions += [region(len(regions) + k, [[i]]) for k, i in enumerate(range(first, shards))]
    return Node("root", children=tuple(regions))


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with u in (0, 1] from the first 52 bits of an MD5 of key and name."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{node.name}"))), 1, 13), 16, 10).cast("double")
    return -F.ln((bits + 1.0) / float(1 << 52)) / F.lit(float(node.weight))


def descend(key: Column, node: Node) -> Column:
    """The shard of a string key below node."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return descend(key, live[0])
    draws = F.array(*(draw(key, c) for c in live))
    first = F.array_position(draws, F.array_min(draws))
    out = descend(key, live[-1])
    for i in range(len(live) - 2, -1, -1):
        out = F.when(first == i + 1, descend(key, live[i])).otherwise(out)
    return out


def shard_column(key: Column, tree: Node) -> Column:
    """The shard number of a key of any type."""
    return descend(F.coalesce(key.cast("string"), F.lit("null")), tree).cast("int")


def deal(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", weights: list[float] | None = None, rows: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of each row.

    size is the text's UTF-8 bytes (null: none) plus one. slot numbers the rows of a shard without
    gaps, by hash bucket, id and content; no shard is ever gathered in one task. grown_shard is the
    place with one more shard of weight 1. rows: how many rows there are about, to size the buckets.
    """
    text = F.col(text_col).cast("string")
    key = F.col(id_col)
    weights = weights or [1.0] * shards
    small = df.select(
        key.cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        shard_column(key, topology(shards, weights)).alias("shard"),
        shard_column(key, topology(shards + 1, [*weights, 1.0], shards)).alias("grown_shard"),
    )
    many = buckets_for(df.count() if rows is None else rows)
    return numbered(small, ["shard"], F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(many)), [F.col(c) for c in ("doc_id", "text_crc32", "size")])
