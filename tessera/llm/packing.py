"""Packing documents into token sequences by length patterns.

Lengths alone decide: every pattern of up to three lengths that fills a sequence is a column, and
non-negative least squares fits repeat counts to the histogram of lengths (an active set of columns,
grown by gradient, as few as there are lengths). Counts are rounded, and what is left is packed by
best fit, longest first. Both work on the histogram (as many numbers as a sequence is long), never on
documents. Documents of a length are then numbered without gathering them, and each number falls
into one slot of the plan.

Cases: a null text counts as empty and holds the end id only; longer documents are cut into whole
sequences with the shorter rest first; repeated rows are packed each; an empty table gives an empty
result; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec as bpe
from .common import buckets_for, map_texts, numbered, strings, written

#: Documents in a fitted pattern at most.
PARTS = 3
#: Rounds in which the active set may grow.
ROUNDS = 40
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids: (doc_id, piece, start, length, ids_crc32[, ids]).

    Each document is its ids and then end_id. ids: little-endian unsigned 32-bit integers.
    """

    def start():
        codec = bpe(tokenizer_path)
        tail = np.array([end_id], "<u4")

        def work(batch):
            docs, nos, starts, sizes, sums, raw = [], [], [], [], [], []
            for doc, ids in zip(batch.column(0).to_pylist(), codec.encode(strings(batch.column(1))), strict=True):
                ids = np.concatenate([ids, tail])
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = ids[a:b].tobytes()
                    docs.append(doc), nos.append(k), starts.append(a), sizes.append(b - a), sums.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(part)
            columns = [pa.array(docs, pa.int64()), pa.array(nos, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, sizes, sums))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

        return work

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, start, PIECES + ", ids binary" * with_ids)


def patterns(present: np.ndarray, capacity: int, parts: int = PARTS) -> np.ndarray:
    """All rows of `parts` lengths, ascending, 0 for none, that sum to capacity; only lengths present."""
    here = np.zeros(capacity + 1, bool)
    here[present] = True
    rows = [np.zeros((0, parts), np.int64)]
    if parts == 3:
        for a in np.concatenate([[0], present]):
            rest = capacity - a
            b = present[(present >= a) & (2 * present <= rest)]
            c = rest - b
            fits = here[c]
            rows.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], 1))
    elif parts == 2:
        b = present[2 * present <= capacity]
        b = b[here[capacity - b]]
        rows.append(np.stack([b, capacity - b], 1))
    if here[capacity]:
        rows.append(np.array([[0] * (parts - 1) + [capacity]]))
    return np.concatenate(rows)


def fit(columns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x with sum of x over the patterns that hold a length near its count.

    Least squares weighted by 1 / sqrt(count), so that rare lengths weigh as much as common ones
    do for what is packed. Column 0 of the histogram stands for no document.
    """
    goal = counts.astype(float).copy()
    goal[0] = 0
    weight = 1 / np.sqrt(np.maximum(goal, 1))
    weight[0] = 0
    x = np.zeros(len(columns))
    active = np.zeros(len(columns), bool)

    def times(cols, v):
        return weight * np.bincount(cols.ravel(), np.repeat(v, cols.shape[1]), len(goal))

    def back(cols, r):
        return (weight * r)[cols].sum(1)

    def solve(cols, start):
        """Conjugate gradients on the normal equations."""
        v = start.copy()
        r = back(cols, weight * goal - times(cols, v))
        p, rr = r.copy(), r @ r
        for _ in range(80):
            if rr < 1e-12:
                break
            ap = back(cols, times(cols, p))
            step = rr / max(p @ ap, 1e-300)
            v += step * p
            r -= step * ap
            new = r @ r
            p = r + new / rr * p
            rr = new
        return v

    for _ in range(rounds):
        residual = weight * goal - times(columns, x)
        gain = back(columns, residual)
        gain[active] = -1
        best = np.argsort(-gain, kind="stable")[: 8 * len(goal)]
        best = best[gain[best] > 1e-6]
        if not len(best):
            break
        used = np.zeros(len(goal), bool)
        added = 0
        for k in best:  # each length enters with one new column a round
            own = columns[k][columns[k] > 0]
            if not used[own].any():
                used[own] = True
                active[k] = True
                added += 1
        if not added:
            break
        for _ in range(25):
            idx = np.flatnonzero(active)
            wanted = solve(columns[idx], x[idx])
            low = wanted <= 1e-9
            if not low.any():
                x[idx] = wanted
                break
            now = x[idx]
            falls = low & (now - wanted > 0)
            step = np.min(now[falls] / (now - wanted)[falls], initial=1.0)
            now = now + step * (wanted - now)
            gone = low & (now <= 1e-9)
            x[idx] = np.where(gone, 0, np.maximum(now, 0))
            if not gone.any():
                break
            active[idx[gone]] = False
    return x


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by histogram, longest first: (lengths of a sequence, how many such)."""
    left = counts.copy()
    open_: dict[int, list[list]] = defaultdict(list)
    done: list[tuple[tuple[int, ...], int]] = []
    sizes = np.flatnonzero(left[1:])[::-1] + 1
    for size in map(int, sizes):
        n = int(left[size])
        for space in range(size, capacity):
            while n and open_.get(space):
                filled, m = open_[space].pop()
                n = _fill(open_, done, filled, m, space, size, n)
            if not n:
                break
        while n:
            n = _fill(open_, done, (), -(-n // (capacity // size)), capacity, size, n)
    return done + [(tuple(p), m) for groups in open_.values() for p, m in groups]


def _fill(open_, done, filled, m, space, size, n) -> int:
    """Puts documents of `size` into m sequences with `space` left, each filled before the next."""
    each = space // size

    def put(pattern, free, many):
        if many and free:
            open_[free].append([pattern, many])
        elif many:
            done.append((pattern, many))

    full = min(m, n // each)
    put(filled + (size,) * each, space - each * size, full)
    n -= full * each
    if full < m and n:
        put(filled + (size,) * n, space - n * size, 1)
        full, n = full + 1, 0
    if full < m and filled:
        open_[space].append([filled, m - full])
    return n


def plan(counts: np.ndarray, capacity: int, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every document of the histogram once."""
    left = counts.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    present = np.flatnonzero(left[1:]) + 1
    if len(present):
        columns = patterns(present, capacity, parts)
        if len(columns):
            x = fit(columns, left)
            for k in np.argsort(-x, kind="stable"):
                if x[k] < 0.5:
                    break
                own, many = np.unique(columns[k][columns[k] > 0], return_counts=True)
                n = int(min(round(x[k]), (left[own] // many).min()))
                if n:
                    left[own] -= n * many
                    chosen.append((tuple(int(v) for v in columns[k] if v), n))
    fitted = chosen + best_fit(left, capacity)
    plain = best_fit(counts.astype(np.int64), capacity)
    return min(fitted, plain, key=lambda p: sum(n for _, n in p))


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, offset) by length and number."""
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for lengths, n in chosen:
        at = 0
        for size in lengths:
            rows.append((size, taken[size], base, at))
            taken[size] += n
            at += size
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def assign(parts: DataFrame, capacity: int = 2048, most_parts: int = PARTS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, start, length, ids_crc32.

    parts is read three times; pass a written table. The histogram and the plan that reach the
    driver are bounded by capacity, not by rows.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row.length] = row.n
    table = slots(plan(counts, capacity, most_parts))
    where = table[:, 0] << 48 | table[:, 1]
    many = buckets_for(int(counts.sum()))
    ranked = numbered(parts, ["length"], F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(many)), [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")], "number")

    def place(batches):
        for b in batches:
            number = b.column("number").to_numpy(zero_copy_only=False)
            hit = np.searchsorted(where, b.column("length").to_numpy(zero_copy_only=False) << 48 | number, "right") - 1
            own = table[hit]
            columns = [b.column(c) for c in b.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own[:, 2] + number - own[:, 1]), pa.array(own[:, 3])], names=[c for c in b.schema.names if c != "number"] + ["sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of df."""
    return assign(written(pieces(df, tokenizer_path, capacity, end_id, id_col, text_col)), capacity)
