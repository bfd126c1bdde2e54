"""SimHash near-duplicates, joined by deletion variants.

A fingerprint is cut into SEGMENTS = 2 halves: of at most 3 differing bits, one half holds at most
one. Each half is indexed under its 32 one-wildcard variants, and fingerprints that share a variant
meet in an equality join (rows dealt and sorted by variant) and are verified. A half or variant that
more than MOST fingerprints share is cut again inside the other half (two quarters, their one-wildcard
variants), and again (two eighths), where 53 bits are equal and only 2**11 fingerprints can be left:
no pair is lost and no group is unbounded. From a group, links enough to connect it are kept, not all
pairs.

Equal texts have equal fingerprints, and equal fingerprints are one node, so copies cost nothing.

Cases: a null text counts as empty; a text without a word has fingerprint zero and is linked like
any other; a null id takes part, and a component of null ids only has a null id; repeated rows give
repeated rows; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, strings, written
from .components import components

BITS, SEED = 64, 42
#: What the two halves can guarantee.
MOST_DISTANCE = 3
#: Fingerprints of a group that are compared in one go: what the third cut leaves at most.
MOST = 2048
#: Rows of a partition of the index, about.
ROWS = 1 << 20


def hashes(text: str, shingle: int = 3) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included; none without a word."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[-1:] if len(words) < shingle else ends[shingle - 1 :]
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)], np.uint64)


def majority(found: np.ndarray) -> int:
    """The unsigned number of the bits that are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(found), 1 << 14):
        part = found[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = 3) -> int:
    """The unsigned fingerprint of a text."""
    return majority(hashes(text, shingle))


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed long."""

    def start():
        def work(batch):
            found = np.array([fingerprint(t, shingle) for t in strings(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

        return work

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, start, "doc_id long, fp long")


def _variants(fp: Column, low: int, width: int, bits: int) -> list[Column]:
    """One long for each bit of the `width` bits from `low`: which bit is wild, then the others."""
    part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
    return [part.bitwiseAND(F.lit(~(1 << k))).bitwiseOR(F.lit((low + k) << bits)) for k in range(width)]


#: What a level cuts: bits of a piece, and the level's key as bits beside those above.
_WIDE, _HALF, _EIGHTH = 32, 16, 8


def _halves(fps: DataFrame) -> DataFrame:
    """(low, v, n): values of either half with the number of fingerprints that hold them."""
    fp = F.col("fp")
    both = F.array(*(F.struct(F.lit(at).alias("low"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << 32) - 1)).alias("v")) for at in (0, 32)))
    return fps.select(F.explode(both).alias("h")).select("h.low", "h.v").groupBy("low", "v").agg(F.count(F.lit(1)).alias("n"))


def _first(fps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Fingerprints under the variants of their halves, (k1, k2, fp), and members of halves that are
    too common, (k1, fp) by the half itself.

    What shares a half shares all its variants; a common half is indexed under itself once, and under
    only those variants by which another half that occurs can be met.
    """
    fp, none = F.col("fp"), F.lit(0).cast("long").alias("k2")
    halves = written(_halves(fps))
    common = halves.where(F.col("n") > MOST // 2)
    if common.isEmpty():
        keys = _variants(fp, 0, 32, _WIDE) + _variants(fp, 32, 32, _WIDE)
        return fps.select(F.explode(F.array(*keys)).alias("k1"), none, "fp"), None
    near = common.select("low", "v", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("p")).withColumn("u", F.col("v").bitwiseXOR(F.expr("shiftleft(1L, p)")))
    met = near.join(halves.select("low", F.col("v").alias("u")), ["low", "u"]).groupBy("low", "v").agg(F.collect_list("p").alias("ps"))
    common = written(common.join(met, ["low", "v"], "left").select("low", "v", F.coalesce("ps", F.array().cast("array<int>")).alias("ps")))
    rows = wide = None
    for at in (0, 32):
        half = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << 32) - 1))
        own = fps.withColumn("v", half).join(common.where(F.col("low") == at).select("v", "ps"), "v", "left")
        every = F.array(*_variants(fp, at, 32, _WIDE))
        keys = F.when(F.col("ps").isNull(), every).otherwise(F.transform("ps", lambda p: F.get(every, p)))
        these = own.select(F.explode(keys).alias("k1"), none, "fp")
        those = own.where(F.col("ps").isNotNull()).select(F.col("v").bitwiseOR(F.lit((64 + at) << _WIDE)).alias("k1"), "fp")
        rows = these if rows is None else rows.unionByName(these)
        wide = those if wide is None else wide.unionByName(those)
    return rows, written(wide)


def _second(wide: DataFrame) -> DataFrame:
    """Members of wide groups under the variants of the quarters of their other half."""
    fp, tag = F.col("fp"), F.shiftright("k1", _WIDE)
    low = (tag < 32) | (tag == 64)
    cut = lambda at: F.array(*_variants(fp, at, 16, _HALF), *_variants(fp, at + 16, 16, _HALF))
    return wide.select("k1", F.explode(F.when(low, cut(32)).otherwise(cut(0))).alias("k2"), "fp")


def _third(wide: DataFrame) -> DataFrame:
    """Members of groups still wide under the variants of the eighths of their last quarter."""
    fp, quarter = F.col("fp"), F.floor(F.shiftright("k2", _HALF) / F.lit(16)).cast("int")
    keys = F.array().cast("array<bigint>")
    for own in range(4):
        at = 16 * (own ^ 1)
        keys = F.when(quarter == own, F.array(*_variants(fp, at, 8, _EIGHTH), *_variants(fp, at + 8, 8, _EIGHTH))).otherwise(keys)
    return wide.select("k1", F.explode(keys).alias("k3"), "k2", "fp").select("k1", F.shiftleft("k2", 16).bitwiseOR(F.col("k3")).alias("k2"), "fp")


def _connect(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what `distance` connects: a spanning forest."""
    bits = members.view(np.uint64)
    n = len(bits)
    waiting = np.ones(n, bool)
    links = []
    for root in range(n):
        if not waiting[root]:
            continue
        waiting[root] = False
        front = [root]
        while front:
            at = front.pop()
            rest = np.flatnonzero(waiting)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= distance]
            waiting[near] = False
            front += near.tolist()
            links += [(int(members[at]), int(members[k])) for k in near]
    return links


def _meet(rows: DataFrame, count: int, distance: int) -> DataFrame:
    """(k1, k2, a, b): links (k1 null) of the groups of (k1, k2) with up to MOST members, and the
    members (b null) of wider ones.

    Rows arrive sorted by key, and a task holds one group up to MOST: wider ones flow through. count:
    how many rows there are about.
    """

    def groups(batches):
        """Columns, starts of whole groups in them (None: all of one wide group), and their end."""
        held = wide = None
        for b in batches:
            own = [b.column(c).to_numpy() for c in ("k1", "k2", "fp")]
            if wide is not None:
                same = (own[0] == wide[0]) & (own[1] == wide[1])
                n = len(same) if same.all() else int(np.argmin(same))
                if n:
                    yield [x[:n] for x in own], None, n
                if n == len(same):
                    continue
                own, wide = [x[n:] for x in own], None
            if held is not None:
                own = [np.concatenate(x) for x in zip(held, own, strict=True)]
            starts = np.concatenate([[0], np.flatnonzero((np.diff(own[0]) != 0) | (np.diff(own[1]) != 0)) + 1])
            begin = int(starts[-1])
            if begin:
                yield own, starts[:-1], begin
            held = [x[begin:].copy() for x in own]
            if len(held[0]) > MOST:
                wide = held[0][0], held[1][0]
                yield held, None, len(held[0])
                held = None
        if held is not None:
            yield held, np.array([0]), len(held[0])

    def run(batches):
        for own, starts, end in groups(batches):
            k1, k2, fp = own
            links, wide = [], []
            if starts is None:
                wide.append(np.arange(end))
            elif len(starts):
                sizes = np.diff(np.concatenate([starts, [end]]))
                two = starts[sizes == 2]
                near = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= distance]
                links += list(zip(fp[near].tolist(), fp[near + 1].tolist(), strict=True))
                for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                    if n <= MOST:
                        links += _connect(fp[at : at + n], distance)
                    else:
                        wide.append(np.arange(at, at + n))
            if links:
                a, b = zip(*links, strict=True)
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["k1", "k2", "a", "b"])
            for rows_ in wide:
                yield pa.RecordBatch.from_arrays([pa.array(k1[rows_]), pa.array(k2[rows_]), pa.array(fp[rows_]), pa.nulls(len(rows_), pa.int64())], names=["k1", "k2", "a", "b"])

    keyed = rows.repartition(max(1, -(-count // ROWS)), "k1", "k2").sortWithinPartitions("k1", "k2")
    return written(keyed.mapInArrow(run, "k1 long, k2 long, a long, b long").distinct())


def links(fps: DataFrame, distance: int = MOST_DISTANCE) -> DataFrame:
    """(a, b) of different fingerprints at most `distance` bits apart, enough to connect all such.

    fps: a written table of distinct longs `fp`.
    """
    if distance > MOST_DISTANCE:
        raise ValueError(f"two segments guarantee a wildcard match up to {MOST_DISTANCE} bits")
    rows, common = _first(fps)
    met = _meet(rows, BITS * fps.count(), distance)
    found = met.where("b IS NOT NULL").select("a", "b")
    for cut, variants in ((_second, 32), (_third, 16)):
        wide = met.where("b IS NULL").select("k1", "k2", F.col("a").alias("fp"))
        if common is not None and cut is _second:
            wide = wide.unionByName(common.select("k1", F.lit(0).cast("long").alias("k2"), "fp"))
        n = wide.count()
        if not n:
            break
        met = _meet(cut(wide), variants * n, distance)
        found = found.unionByName(met.where("b IS NOT NULL").select("a", "b"))
    return found.distinct()


def near_duplicates(df: DataFrame, shingle: int = 3, distance: int = MOST_DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row: the least id that links reach, its own included."""
    rows = written(fingerprints(df, shingle, id_col, text_col))
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes.select("fp"), distance))
    joined = nodes.join(found.withColumnRenamed("u", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = written(joined.join(least, "root").select("fp", "component_id"))
    return rows.join(labelled, "fp").select("doc_id", "fp", "component_id")
