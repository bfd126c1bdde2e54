"""Groups of similar texts: SimHash links, completed by an exact join on shingle sets.

Texts are nodes by their 64-bit hash, so copies cost nothing. Fingerprints of the shingles that the
SimHash operator links (deletion variants, three bits) are candidates first. A similarity of 0.8 lies
about ten bits apart, far beyond what any cut into segments guarantees, so a prefix join completes
them: two sets of similarity 0.8 or more share one of the first n - ceil(0.8 n) + 1 shingles of either,
in any one order of all shingles. Shingles that are frequent in a sample come last in the order; the
sample only makes groups smaller.

Nodes that share a shingle of their prefixes are a group; shingles shared by the same nodes make one
group. Sizes and parity bits of a set bound its difference to another from below (bits of a larger
set fold to those of a smaller): pairs beyond the bound are left out, and no others. Of each group a forest of the remaining pairs is compared shingle
by shingle; then every pair that the forests did not connect is. All similar pairs are thus within
components, without listing all pairs of a group.

A group of more than MOST nodes is dealt to blocks: each block's forest holds the group's least node
too, and afterwards the nodes outside the group's largest component visit every block. A task holds
one block, whatever a group's size. Shingles common in the sample are counted by partial sums and
never dealt by shingle alone, so no task holds all rows of one. One that the sample missed still is.

Cases: a null text counts as empty; texts without a word are one group; a text shorter than a shingle
is one shingle; case and the kind of ASCII white space do not count; an empty table has no group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import simhash
from .common import cut, discard, map_texts, strings, written
from .components import components

#: Words of a shingle; similarity is 4 / 5 throughout.
WORDS = 5
#: Texts whose shingles are counted for the order, about, and how many frequent shingles are kept.
SAMPLE, FREQUENT = 40_000, 200_000
#: A shingle is common that holds more than one in so many sampled texts.
COMMON = 256
#: Parity bits of a set at least; larger sets have the power of two at or above their size.
PARITY = 1024
#: Nodes of a block, about.
MOST = 2048
#: Nodes that a task remembers, to send copies on once.
REMEMBERED = 1 << 16


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a Jaccard similarity of 0.8 or more; two empty ones have."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The set of a text's shingles, as sorted 64-bit hashes."""
    return np.unique(simhash.hashes(text, words))


def prefix(own: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles by which a set meets every similar one; an empty set meets others under 0."""
    n = len(own)
    if not n:
        return np.zeros(1, np.uint64)
    rank = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        rank = np.where(frequent[at] == own, ranks[at], 0)
    return own[np.lexsort((own, rank))[: n - (4 * n + 4) // 5 + 1]]


def node_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several sampled texts, sorted, with their counts; copies are merged before they move."""

    def count(batches):
        own = [shingles(t) for b in batches for t in strings(b.column(0))]
        found, n = np.unique(np.concatenate([*own, np.empty(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["s", "n"])

    every = max(1, texts.count() // SAMPLE)
    sample = texts.where(F.pmod("node", F.lit(every)) == 0).groupBy("node").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    counted = sample.select("text").coalesce(4).mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n > 2")
    rows = counted.orderBy(F.desc("n"), "s").limit(FREQUENT).collect()
    own = np.array([r.s for r in rows], np.int64).view(np.uint64)
    order = np.argsort(own)
    return own[order], np.array([r.n for r in rows], np.int64)[order]


def parity(own: np.ndarray) -> bytes:
    """Parities of the numbers of hashes by their last bits."""
    width = max(PARITY, 1 << int(len(own) - 1).bit_length()) if len(own) else PARITY
    return np.packbits(np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def _profiles(texts: DataFrame) -> DataFrame:
    """(node, fp, size, parity, tokens, common) of texts: (node, text); a node may come again from another
    task. The prefix is tokens and common, the shingles that many texts hold."""
    frequent, ranks = _frequent(texts)
    known = frequent[ranks > SAMPLE // COMMON]

    def start():
        seen: set[int] = set()

        def work(batch):
            rows, fps, sizes, parities, tokens, common = [], [], [], [], [], []
            for k, (node, text) in enumerate(zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True)):
                if node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                every = simhash.hashes(text, WORDS)
                own = np.unique(every)
                rows.append(k)
                fps.append(simhash.majority(every))
                sizes.append(len(own))
                parities.append(parity(own))
                first = prefix(own, frequent, ranks)
                wide = np.isin(first, known)
                tokens.append(first[~wide].view(np.int64))
                common.append(first[wide].view(np.int64))
            if not rows:
                return
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), fp, pa.array(sizes, pa.int32()), pa.array(parities, pa.binary()), _lists(tokens), _lists(common)], names=["node", "fp", "size", "parity", "tokens", "common"])

        return work

    return written(map_texts(texts, start, "node long, fp long, size int, parity binary, tokens array<bigint>, common array<bigint>"))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


def _near_prints(profiles: DataFrame) -> DataFrame:
    """(a, b) of nodes whose fingerprints the SimHash operator links, or that have the same one."""
    nodes = written(profiles.select("node", "fp").distinct())
    least = written(nodes.groupBy("fp").agg(F.min("node").alias("least")))
    same = nodes.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = simhash.links(least.select("fp"))
    named = near.join(least.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(least.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    out = written(same.unionByName(named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))))
    discard(nodes)
    discard(least)
    return out


def _groups(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, n, block, blocks, node): nodes, n and two at least, whose prefixes hold a shingle; and
    (node, size, parity) of these.

    Shingles that the same nodes hold (by number and two checksums of the nodes) count once, among the
    common ones and among the others. Common ones are FREQUENT at most, so what is known of each is
    broadcast.
    """
    single = profiles.select(F.explode("tokens").alias("token"), "node").repartition("token").dropDuplicates(["token", "node"])
    w = Window.partitionBy("token")
    facts = {"n": F.count(F.lit(1)), "x": F.bit_xor("node"), "y": F.bit_xor(F.xxhash64("node"))}
    met = written(single.select("token", "node", *[f.over(w).alias(c) for c, f in facts.items()]).where("n > 1"))
    once = met.groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token")
    common = written(profiles.select(F.explode("common").alias("token"), "node").distinct())
    counted = common.groupBy("token").agg(*[f.alias(c) for c, f in facts.items()]).where("n > 1")
    counted = counted.groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token", "n")
    rows = met.join(once, "token", "left_semi").select("token", "n", "node")
    rows = rows.unionByName(common.join(F.broadcast(counted), "token").select("token", "n", "node"))
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / MOST).cast("int"))
    dealt = rows.select("token", "n", F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int").alias("block"), "blocks", "node")
    heads = rows.where("blocks > 1").groupBy("token", "n", "blocks").agg(F.min("node").alias("node"))
    heads = heads.select("token", "n", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "blocks", "node")
    members = written(dealt.unionByName(heads).distinct())
    known = members.select("node").distinct()
    shapes = written(profiles.select("node", "size", "parity").join(known, "node", "left_semi").dropDuplicates(["node"]))
    discard(met)
    discard(common)
    return members, shapes


class _Block:
    """Nodes with the sizes, parities and labels of their sets."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, parities: list[bytes], labels: np.ndarray):
        self.nodes, self.sizes, self.labels = nodes, sizes, labels
        self.parities = [np.frombuffer(x, np.uint64) for x in parities]
        self.widths = np.array([len(x) for x in self.parities])
        self._folded: dict[int, np.ndarray] = {}

    def bits(self, width: int) -> np.ndarray:
        """Parities in `width` words, zero where a set has fewer."""
        if width not in self._folded:
            out = np.zeros((len(self.nodes), width), np.uint64)
            for k, x in enumerate(self.parities):
                if len(x) >= width:
                    out[k] = np.bitwise_xor.reduce(x.reshape(-1, width), axis=0)
            self._folded[width] = out
        return self._folded[width]

    def near(self, i: int, other: _Block, rows: np.ndarray) -> np.ndarray:
        """Those of the other's rows that may be similar to set i."""
        size = self.sizes[i]
        rows = rows[9 * np.abs(size - other.sizes[rows]) <= size + other.sizes[rows]]
        shared, out = np.minimum(self.widths[i], other.widths[rows]), []
        for width in np.unique(shared).tolist():
            own = rows[shared == width]
            apart = np.bitwise_count(other.bits(width)[own] ^ self.bits(width)[i]).sum(1, dtype=np.int64)
            out.append(own[9 * apart <= size + other.sizes[own]])
        return np.concatenate(out) if out else rows


def _forest(own: _Block):
    """Pairs that connect what the bound connects."""
    waiting = np.arange(len(own.nodes))
    while len(waiting):
        front, waiting = [int(waiting[0])], waiting[1:]
        while front and len(waiting):
            i = front.pop()
            found = own.near(i, own, waiting)
            if len(found):
                waiting = np.setdiff1d(waiting, found, assume_unique=True)
                front += found.tolist()
                yield np.full(len(found), own.nodes[i]), own.nodes[found]


def _across(own: _Block):
    """Pairs of different labels within the bound."""
    _, at, count = np.unique(own.labels, return_inverse=True, return_counts=True)
    for i in np.flatnonzero(at != count.argmax()).tolist():  # the largest label meets others from their side
        found = own.near(i, own, np.flatnonzero(at != at[i]))
        if len(found):
            yield np.full(len(found), own.nodes[i]), own.nodes[found]


def _visits(own: _Block, guests: _Block):
    """Pairs of different labels within the bound, of own nodes and guests."""
    for k in range(len(guests.nodes)):
        found = guests.near(k, own, np.flatnonzero(own.labels != guests.labels[k]))
        if len(found):
            yield np.full(len(found), guests.nodes[k]), own.nodes[found]


def _runs(batches):
    """(key, block) of each run of equal (token, block, guest) in sorted batches; guests in pieces."""
    key, held = None, []

    def whole():
        nodes, sizes, parities, labels = zip(*held, strict=True)
        return key, _Block(np.concatenate(nodes), np.concatenate(sizes), [x for p in parities for x in p], np.concatenate(labels))

    for b in batches:
        keys = [b.column(c).to_numpy(zero_copy_only=False) for c in ("token", "block", "guest")]
        own = [b.column("node").to_numpy(), b.column("size").to_numpy().astype(np.int64), b.column("parity").to_pylist(), b.column("label").to_numpy()]
        edges = [0, *(np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0) | (np.diff(keys[2]) != 0)) + 1).tolist(), b.num_rows]
        for x, y in zip(edges, edges[1:], strict=False):
            if x == y:
                continue
            now = tuple(int(k[x]) for k in keys)
            if held and (now != key or now[2]):
                yield whole()
                held = []
            key = now
            held.append([c[x:y] for c in own])
    if held:
        yield whole()


def _pairs(rows: DataFrame, shapes: DataFrame, forest: bool) -> DataFrame:
    """(a, b), a < b, of pairs within the bound in any block: a forest of each, or all of different
    labels. rows: (token, block, guest, node, label); shapes: (node, size, parity)."""

    def found(batches):
        place, own = None, None
        for (token, block, guest), rows_ in _runs(batches):
            if guest:
                if place == (token, block):
                    yield from _visits(own, rows_)
                continue
            place, own = (token, block), rows_
            yield from _forest(own) if forest else _across(own)

    def run(batches):
        held, n = [], 0
        for pair in found(batches):
            held.append(pair)
            n += len(pair[0])
            if n >= 1 << 16:
                yield whole(held)
                held, n = [], 0
        if held:
            yield whole(held)

    def whole(held):
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    columns = ["token", "block", "guest", "node", "size", "parity", "label"]
    keyed = rows.join(shapes, "node").select(*columns).repartition("token", "block").sortWithinPartitions("token", "block", "guest")
    return keyed.mapInArrow(run, "a long, b long").distinct()


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of groups of three and more with labels; nodes outside the largest label of a group
    that has several blocks are guests in all of them."""
    # A group of two has had its only pair compared.
    rows = members.where("n > 2").drop("n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = rows.withColumn("guest", F.lit(0))
    dealt = rows.where("blocks > 1")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    held = dealt.groupBy("token", "blocks", "label").agg(F.count(F.lit(1)).alias("held"))
    main = held.groupBy("token", "blocks").agg(F.max_by("label", F.struct("held", "label")).alias("main"))
    # By block too: a task has the rows of a block, not of a group.
    guests = dealt.join(main.select("token", every, "main"), ["token", "block"]).where("label <> main").dropDuplicates(["token", "node"])
    return rows.unionByName(guests.select("node", "token", every, "blocks", "label", F.lit(1).alias("guest")))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts (node, text) are similar."""

    def run(batches):
        last, own = None, None
        for batch in batches:
            for part in cut(batch):
                fine = []
                for a, x, y in zip(*(part.column(c).to_pylist() for c in ("a", "x", "y")), strict=True):
                    if a != last:
                        last, own = a, shingles(x)
                    fine.append(similar(own, shingles(y)))
                yield part.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return written(both.mapInArrow(run, "a long, b long"))


def _texts(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the nodes, copies merged before they move."""
    once = texts.groupBy("node").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return written(once.join(nodes, "node", "left_semi"))


def groups(texts: DataFrame) -> DataFrame:
    """(node, root) of every node of texts: (node, text), repeats allowed, that is no root of its group."""
    profiles = _profiles(texts)
    prints = _near_prints(profiles)
    members, shapes = _groups(profiles)
    discard(profiles)
    alone = members.withColumn("label", F.col("node")).withColumn("guest", F.lit(0))
    first = written(_pairs(alone, shapes, True).unionByName(prints).distinct())
    discard(prints)
    # A node of any pair within the bound has a link in a forest, if its group is one block.
    known = first.select(F.col("a").alias("node")).union(first.select("b")).union(members.where("blocks > 1").select("node"))
    whole = _texts(texts, known.distinct())
    labels = components(_verified(first, whole)).select(F.col("u").alias("node"), F.col("root").alias("label"))
    rest = written(_pairs(_labelled(members, labels), shapes, False).join(first, ["a", "b"], "left_anti"))
    # What the forests connected is known: only the links between their components are followed again.
    later = _verified(rest, whole)
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), "label")
        later = later.join(own, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    joined = components(later).select(F.col("u").alias("label"), "root")
    for table in (members, shapes, first, whole, rest):
        discard(table)
    met = labels.join(joined, "label", "left").select("node", F.coalesce("root", "label").alias("root"))
    return met.unionByName(joined.withColumnRenamed("label", "node"))  # roots so far: no node of labels
