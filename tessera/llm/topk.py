"""Exact greatest inner products by dual-tree search over cover trees.

Candidates are dealt by the nearest of some pivots, which a bounded sample gives, and pivots with many
candidates to several blocks. Products with one block of a query's own pivot give its floor, a k-th score
that it has at least; it visits those blocks only whose covering ball can reach that, so blocks are left
out before anything moves.

A task builds the cover tree of a block and searches it for the tree of each group of queries (those of
one pivot) in turn: a pair of nodes is left out when no candidate below the one can reach the worst k-th
score that any query below the other has so far, <q, c> being at most <q0, c0> + |q0| rc + |c0| rq +
rq rc for balls of radii rq and rc. Below a leaf of queries, each query's own product with the centre
takes the place of the first and third terms. What is left meets in leaves, in whole numbers.

Rows arrive sorted by block and group, so a task holds one block and one group, whatever the table's
size. Each block gives at most k results a query; the k best of these are kept. How much is left out
depends on the vectors: tight clusters leave little, while vectors spread evenly over a sphere of many
dimensions leave out nothing, as no ball of theirs is small.

Cases: vectors that are null or have a null or non-finite component take no part; shorter vectors count
as followed by zeros; a query's own row (its id) is no candidate, whatever rows share the id; ties go to
smaller ids; repeated rows count each; fewer candidates than k give fewer rows; an empty table gives
an empty result; of rows that share a query's id, the least vector asks; columns other than id and
vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, written

#: Rows of a block of candidates and of a group of queries, about.
CANDIDATES, QUERIES = 1 << 13, 1 << 10
#: Pivots at most, and vectors that they are chosen from.
PIVOTS, SAMPLE = 1 << 10, 1 << 12
#: Points of a leaf of candidates and of queries; children's centres are this part of a node's radius apart.
LEAF, QUERY_LEAF, SHRINK = 16, 32, 0.7
#: Points that are scored in one go.
BATCH = 1 << 10


#: A node whose cover takes more than this part of its points is a leaf: no ball in it is small.
MOST_CENTRES = 0.25


def _apart(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - point) ** 2).sum(1))


class CoverTree:
    """Points under nodes, each with a centre among its points and a covering radius.

    Built from the top: children's centres are further apart than SHRINK times the node's radius, and
    each point is no further than that from one. A node's rows are contiguous in `order`, its
    children's numbers from `first` to `last`.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.norms = np.sqrt((points**2).sum(1))
        self.order = np.arange(len(points))
        middle = points[int(np.argmin(_apart(points, points.mean(0))))]
        nodes = [(0, len(points), middle)]
        start, end, radius, centre, first, last = [], [], [], [], [], []
        for a, b, c in nodes:  # grows: a node's children follow all that were known before
            far = _apart(points[self.order[a:b]], c)
            start.append(a), end.append(b), radius.append(float(far.max())), centre.append(c), first.append(len(nodes))
            if b - a > leaf and radius[-1] > 0:
                nodes += self._cover(a, b, c, far, radius[-1] * SHRINK)  # none: a leaf
            last.append(len(nodes))
        self.start, self.end, self.first, self.last = (np.array(x) for x in (start, end, first, last))
        self.radius, self.centre = np.array(radius), np.array(centre)
        self.norm = np.sqrt((self.centre**2).sum(1))

    def _cover(self, a: int, b: int, centre: np.ndarray, nearest: np.ndarray, scale: float) -> list[tuple[int, int, np.ndarray]]:
        """Children of rows a to b: the node's centre is one's, then the point furthest from all so far."""
        own = self.order[a:b]
        rows, norms = self.points[own], self.norms[own] ** 2
        centres, of = [centre], np.zeros(b - a, np.int64)
        while nearest.max() > scale:
            if len(centres) >= MOST_CENTRES * (b - a):
                return []
            k = int(np.argmax(nearest))
            far = np.sqrt(np.maximum(norms - 2 * (rows @ rows[k]) + norms[k], 0))
            far[k] = 0
            closer = far < nearest
            nearest = np.where(closer, far, nearest)
            of[closer] = len(centres)
            centres.append(rows[k])
        self.order[a:b] = own[np.argsort(of, kind="stable")]
        edges = a + np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(centres)))])
        return [(int(x), int(y), c) for x, y, c in zip(edges, edges[1:], centres, strict=False) if y > x]

    def is_leaf(self, node):
        return self.first[node] == self.last[node]

    def rows(self, node: int) -> np.ndarray:
        return self.order[self.start[node] : self.end[node]]


class Best:
    """The k best (score, id) of each query so far, none below its floor; counts what was scored."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf) if floor is None else floor
        self.scored = 0

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[rows, -1], self.floor[rows])

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of shape (rows, ids); -inf leaves a pair out."""
        k = self.scores.shape[1]
        self.scored += scores.size
        hopeful = ((scores >= self.worst(rows)[:, None]) & np.isfinite(scores)).any(1)
        rows, scores = rows[hopeful], scores[hopeful]
        if not len(rows):
            return
        some = (scores >= self.worst(rows)[:, None]).any(0)
        scores, ids = scores[:, some], ids[some]
        all_scores = np.concatenate([self.scores[rows], scores], 1)
        all_ids = np.concatenate([self.ids[rows], np.where(np.isfinite(scores), ids[None], np.iinfo(np.int64).max)], 1)
        by = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(all_scores, by, 1)
        self.ids[rows] = np.take_along_axis(all_ids, by, 1)


def search(queries: CoverTree, query_ids: np.ndarray, found: CoverTree, ids: np.ndarray, k: int, best: Best | None = None) -> Best:
    """Descends both trees together, likelier children first."""
    best = best or Best(len(query_ids), k)
    slack = 1e-6

    def meet(rows: np.ndarray, own: np.ndarray) -> None:
        for at in range(0, len(own), BATCH):
            part = own[at : at + BATCH]
            scores = queries.points[rows] @ found.points[part].T
            scores[query_ids[rows][:, None] == ids[part][None]] = -np.inf
            best.add(rows, scores, ids[part])

    def leaves(rows: np.ndarray, kids: np.ndarray, reach: np.ndarray) -> None:
        """Leaves of candidates, likeliest first, each for the queries that it can still serve."""
        for at in np.argsort(-reach.max(0), kind="stable").tolist():
            asking = rows[reach[:, at] >= best.worst(rows)]
            if len(asking):
                meet(asking, found.rows(kids[at]))

    todo = [(0, 0)]
    while todo:
        q, c = todo.pop()
        rows = queries.rows(q)
        bound = queries.centre[q] @ found.centre[c] + queries.norm[q] * found.radius[c] + found.norm[c] * queries.radius[q] + queries.radius[q] * found.radius[c]
        if bound < best.worst(rows).min() - slack * (1 + abs(bound)):
            continue
        if not queries.is_leaf(q) and (found.is_leaf(c) or queries.radius[q] > found.radius[c]):
            todo += [(x, c) for x in range(queries.first[q], queries.last[q])]
        elif found.is_leaf(c):
            meet(rows, found.rows(c))
        else:
            kids = np.arange(found.first[c], found.last[c])
            reach = queries.points[rows] @ found.centre[kids].T + queries.norms[rows][:, None] * found.radius[kids]
            reach += slack * (1 + np.abs(reach))
            open_ = (reach >= best.worst(rows)[:, None]).any(0)
            ends = found.is_leaf(kids)
            inner = kids[open_ & ~ends]
            todo += [(q, int(x)) for x in inner[np.argsort(reach[:, open_ & ~ends].max(0), kind="stable")]] if len(inner) else []
            if (open_ & ends).any():
                leaves(rows, kids[open_ & ends], reach[:, open_ & ends])
    return best


def pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Some of the vectors, each the furthest from those before it."""
    chosen = [0] if len(sample) else []
    nearest = _apart(sample, sample[0]) if len(sample) else np.empty(0)
    while len(chosen) < most and len(chosen) < len(sample) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, _apart(sample, sample[chosen[-1]]))
    return sample[chosen]


def assigned(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, v, pivot, far): the nearest pivot of each vector, and how far it is."""

    def run(batches):
        for b in batches:
            points = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            near = np.argmin((centres**2).sum(1) - 2 * (points @ centres.T), 1).astype(np.int32)
            far = np.sqrt(((points - centres[near]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(near), pa.array(far)], names=["id", "v", "pivot", "far"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<double>, pivot int, far double")


def clean(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): whole components floor(scale * x) as doubles, of vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("double"))
    return df.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


EMPTY = "query_id long, rank int, vec_id long, score long"


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each row with id % every = 0.

    Sums stay exact: whole components below 2**20 and some thousand of them fit a double.
    """
    spark = df.sparkSession
    rows = written(clean(df, id_col, vector_col, scale))
    total, length = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("size")).first()
    if not total:
        return spark.createDataFrame([], EMPTY)
    length = max(1, length)  # of empty vectors alone, every product is zero
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(length) - F.size("v"))))
    drawn = rows.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(SAMPLE).select("v").toPandas()["v"]
    # Spread over the cores there are: smaller blocks, as long as trees pay.
    aim = max(1, min(candidates, max(total // max(1, spark.sparkContext.defaultParallelism), 2048)))
    centres = pivots(np.stack(drawn.to_numpy()), min(PIVOTS, max(1, -(-total // aim))))
    placed = written(assigned(rows, centres))
    asks = written(assigned(rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v")), centres))
    # A row a pivot, PIVOTS at most: how many blocks it has, the first one's number, its ball.
    balls = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).orderBy("pivot").collect()
    groups = {r.pivot: -(-r.n // queries) for r in asks.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in balls:
        shares[r.pivot], radius[r.pivot] = -(-r.n // aim), r.far
    first = np.cumsum(shares) - shares
    blocks = int(shares.sum())

    def dealt(pivot, ids, places=0):
        """Number of the block, of its pivot's, that an id at a place of a batch falls into."""
        return first[pivot] + (ids * 0x9E3779B1 + places & 0x7FFFFFFF) % np.maximum(shares[pivot], 1)

    def place(batches):
        for b in batches:
            n = b.num_rows
            block = dealt(b.column("pivot").to_numpy(), b.column("id").to_numpy(), np.arange(n))
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(np.full(n, -1, np.int64)), b.column("id"), b.column("v"), pa.array(np.full(n, -np.inf))], names=names)

    def send(everywhere: bool):
        """Queries to one block of their own pivot, or to all whose ball reaches their floor."""

        def run(batches):
            sizes = np.sqrt((centres**2).sum(1))
            for b in batches:
                ids, own = b.column("id").to_numpy(), b.column("pivot").to_numpy()
                points = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                home = dealt(own, ids)
                group = own.astype(np.int64) << 32 | np.array([i % groups[p] for i, p in zip(ids.tolist(), own.tolist(), strict=True)], np.int64)
                floor = b.column("floor").to_numpy(zero_copy_only=False) if everywhere else np.full(len(ids), -np.inf)
                for k in range(len(ids)):
                    targets = home[k : k + 1]
                    if everywhere:
                        reach = centres @ points[k] + np.sqrt((points[k] ** 2).sum()) * (radius + 1e-9 * (1 + sizes))
                        fine = np.flatnonzero((shares > 0) & (reach >= floor[k] - 1e-6 * (1 + np.abs(reach))))
                        targets = np.concatenate([np.empty(0, np.int64), *(np.arange(first[p], first[p] + shares[p]) for p in fine)])
                    n = len(targets)
                    if n:
                        one = np.full(n, k)
                        yield pa.RecordBatch.from_arrays([pa.array(targets.astype(np.int32)), pa.array(group[one]), pa.array(ids[one]), b.column("v").take(pa.array(one)), pa.array(floor[one])], names=names)

        return run

    names = ["block", "asks", "id", "v", "floor"]
    schema = "block int, asks long, id long, v array<double>, floor double"
    block = placed.mapInArrow(place, schema)

    def gathered(batches):
        """(ids, points) of a block, then each group of queries."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for number, ids, points, floors in _runs(batches):
            if number < 0:
                held.append((ids, points))
                continue
            if held:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True)), (ids, points, floors)

    def seed(key, batches):
        """The k-th best product of each query in the block, where there are k."""
        for (all_ids, block_points), (ids, points, _) in gathered(batches):
            best = Best(len(ids), k)
            rows_ = np.arange(len(ids))
            for at in range(0, len(all_ids), BATCH):
                scores = points @ block_points[at : at + BATCH].T
                scores[ids[:, None] == all_ids[at : at + BATCH][None]] = -np.inf
                best.add(rows_, scores, all_ids[at : at + BATCH])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best.scores[:, -1])], names=["id", "floor"])

    def run(key, batches):
        tree = all_ids = None
        for (now, block_points), (ids, points, floors) in gathered(batches):
            if tree is None:
                all_ids, tree = now, CoverTree(block_points)
            best = search(CoverTree(points, QUERY_LEAF), ids, tree, all_ids, k, Best(len(ids), k, floors))
            seen = np.isfinite(best.scores)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, seen.sum(1))), pa.array(best.ids[seen]), pa.array(best.scores[seen].astype(np.int64))], names=["query_id", "vec_id", "score"])

    def visited(ask: DataFrame, work, out: str) -> DataFrame:
        both = block.unionByName(ask).repartition(blocks, "block").sortWithinPartitions("block", "asks")
        return written(both.mapInArrow(lambda batches: _by_block(batches, work), out))

    floors = visited(asks.mapInArrow(send(False), schema), seed, "id long, floor double")
    known = asks.join(floors, "id", "left").select("id", "v", "pivot", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    found = visited(known.mapInArrow(send(True), schema), run, "query_id long, vec_id long, score long")
    for table in (placed, asks, floors):
        discard(table)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_block(batches, run):
    """Calls run for each run of equal blocks in sorted batches."""
    from itertools import groupby

    def parts():
        for b in batches:
            block = b.column("block").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), b.num_rows]
            for x, y in zip(edges, edges[1:], strict=False):
                if y > x:
                    yield int(block[x]), b.slice(x, y - x)

    for key, group in groupby(parts(), key=lambda p: p[0]):
        yield from run(key, (b for _, b in group))


def _runs(batches):
    """(asks, ids, points, floors) of each run of equal asks; candidates (-1) come in pieces."""
    held, number = [], None

    def whole():
        return number, *(np.concatenate(x) for x in zip(*held, strict=True))

    for b in batches:
        asks, ids, floors = (b.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "id", "floor"))
        points = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        edges = [0, *(np.flatnonzero(np.diff(asks)) + 1).tolist(), len(asks)]
        for x, y in zip(edges, edges[1:], strict=False):
            if number is not None and asks[x] != number:
                yield whole()
                held = []
            number = int(asks[x])
            held.append((ids[x:y], points[x:y], floors[x:y]))
    if held:
        yield whole()
