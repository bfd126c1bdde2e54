"""Line simplification and the pyramid of zooms.

Both are iterative, so they run as Arrow batches; everything around them is expressions. A pyramid
goes from the finest zoom to the coarsest, each level simplifying the one before, and areas smaller
than a pixel end it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import MAX_ZOOM, pixel
from ..schemas import POINT

#: Lines of up to so many points are simplified without arrays.
SHORT = 24
#: Areas with more points than this keep their topology when simplified.
SMALL_RING = 5


def _far(points: np.ndarray, a: int, b: int) -> tuple[int, float]:
    """The first point furthest from the chord a-b, and its squared distance."""
    p, q, own = points[a], points[b], points[a + 1 : b]
    chord, off = q - p, own - p
    length = float(chord @ chord)
    if length == 0:
        squared = (off * off).sum(1)
    else:
        cross = chord[0] * off[:, 1] - chord[1] * off[:, 0]
        squared = cross * cross / length
    far = int(np.argmax(squared))
    return a + 1 + far, float(squared[far])


def _short(points: list, tolerance: float) -> list[int]:
    """kept_points of a few points, without arrays."""
    keep, todo, limit = {0, len(points) - 1}, [(0, len(points) - 1)], tolerance * tolerance
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        px, py = points[a]
        cx, cy = points[b][0] - px, points[b][1] - py
        length = cx * cx + cy * cy
        far, most = a, -1.0
        for k in range(a + 1, b):
            x, y = points[k][0] - px, points[k][1] - py
            squared = (cx * y - cy * x) ** 2 / length if length else x * x + y * y
            if squared > most:
                far, most = k, squared
        if most >= limit:
            keep.add(far)
            todo += [(a, far), (far, b)]
    return sorted(keep)


def kept_points(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of the points that Douglas and Peucker's method keeps; one as far as the tolerance stays."""
    n = len(points)
    if 0 < n <= SHORT:
        return np.array(_short(points.tolist(), tolerance))
    keep = np.zeros(n, bool)
    if not n:
        return np.flatnonzero(keep)
    keep[[0, n - 1]] = True
    todo = [(0, n - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        far, squared = _far(points, a, b)
        if squared >= tolerance * tolerance:
            keep[far] = True
            todo += [(a, far), (far, b)]
    return np.flatnonzero(keep)


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    return points[kept_points(points.astype(float), tolerance)]


def _crossings(points: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sides of a closed ring that meet elsewhere than at a shared corner."""
    a, b = points[:-1].astype(float), points[1:].astype(float)
    n = len(a)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    turn = lambda o, p, q: (p[..., 0] - o[..., 0]) * (q[..., 1] - o[..., 1]) - (p[..., 1] - o[..., 1]) * (q[..., 0] - o[..., 0])
    out = []
    order = np.argsort(lo[:, 0], kind="stable")
    left = lo[order, 0]
    for k, i in enumerate(order):
        js = order[k + 1 : np.searchsorted(left, hi[i, 0], "right")]
        js = js[(lo[js, 1] <= hi[i, 1]) & (hi[js, 1] >= lo[i, 1])]
        js = js[(np.abs(js - i) > 1) & (np.abs(js - i) < n - 1)]
        if not len(js):
            continue
        d1, d2 = turn(a[i], b[i], a[js]), turn(a[i], b[i], b[js])
        d3, d4 = turn(a[js], b[js], a[i][None]), turn(a[js], b[js], b[i][None])
        out += [(int(i), int(j)) for j in js[(d1 * d2 <= 0) & (d3 * d4 <= 0)]]
    return out


def simplified_ring(points: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed ring simplified without self-crossings, four points at least.

    Where two kept sides meet, the furthest dropped point of either comes back, until none do.
    """
    exact = points.astype(float)
    n = len(points)
    if n < 5:
        return points
    keep = set(kept_points(exact, tolerance).tolist()) | {0, n - 1}
    if len(keep) == n:
        return points
    for _ in range(n):
        while len(keep) < 4:  # a ring needs an inside
            own = sorted(keep)
            gaps = [(_far(exact, x, y)[1], _far(exact, x, y)[0]) for x, y in zip(own, own[1:], strict=False) if y - x > 1]
            if not gaps:
                return points
            keep.add(max(gaps)[1])
        own = sorted(keep)
        back = set()
        for pair in _crossings(points[own]):
            back |= {_far(exact, own[s], own[s + 1])[0] for s in pair if own[s + 1] - own[s] > 1}
        if not back - keep:
            break
        keep |= back
    return points[sorted(keep)]


def area_of(points: np.ndarray) -> float:
    if len(points) < 4 or (points[0] != points[-1]).any():
        return 0.0
    p = points.astype(float) - points[0]
    return abs(float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())) / 2


def pyramid(rings: list[np.ndarray], area: bool, zooms: list[int], lod: bool = True) -> list[tuple[int, list[np.ndarray]]]:
    """(zoom, rings) from the finest zoom down; the first ring is the outer one.

    A ring that keeps no inside is dropped, with the outer one all of the feature.
    """
    if not lod:
        return [(MAX_ZOOM, rings)] if MAX_ZOOM in zooms else []
    out = []
    for zoom in sorted(zooms, reverse=True):
        width = pixel(zoom)
        if area and area_of(rings[0]) < width * width:
            break
        if area and len(rings[0]) > SMALL_RING:
            rings = [rings[0] if len(rings[0]) < 5 else simplified_ring(rings[0], width), *(simplified_ring(r, width) for r in rings[1:] if area_of(r) >= width * width)]
        else:
            rings = [simplified(r, width) for r in rings]
        out.append((zoom, rings))
    return out


POINT_TYPE = pa.struct([("x", pa.int32()), ("y", pa.int32())])
RINGS_TYPE = pa.list_(pa.list_(POINT_TYPE))


def to_array(points: list[dict] | None) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points or ()], np.int64).reshape(-1, 2)


def from_array(points: np.ndarray) -> list[dict]:
    return [{"x": int(x), "y": int(y)} for x, y in points]


def simplify(df: DataFrame, tolerance: float, points_col: str = "points") -> DataFrame:
    """df with the points of lines simplified."""
    at = df.columns.index(points_col)

    def run(batches):
        for b in batches:
            lines = [from_array(simplified(to_array(p), tolerance)) for p in b.column(at).to_pylist()]
            columns = [pa.array(lines, pa.list_(POINT_TYPE)) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    schema = ", ".join(f"`{f.name}` array<{POINT}>" if f.name == points_col else f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, schema)


def pyramids(features: DataFrame, lod: bool = True) -> DataFrame:
    """features (…, rings, area, zooms) by zoom: rings simplified for each, zooms replaced by zoom.

    Rows with areas below a pixel end early; a feature may so have no row.
    """
    names = [c for c in features.columns if c not in ("rings", "zooms")]

    def run(batches):
        for b in batches:
            rows, zooms, shapes = [], [], []
            for i, (rings, area, own) in enumerate(zip(_rings(b.column("rings")), b.column("area").to_pylist(), b.column("zooms").to_pylist(), strict=True)):
                if not rings:
                    continue
                for zoom, level in pyramid(rings, area, own, lod):
                    rows.append(i), zooms.append(zoom), shapes.append(level)
            taken = pa.array(rows, pa.int64())
            columns = [b.column(c).take(taken) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(zooms, pa.int32()), _nested(shapes)], names=[*names, "zoom", "rings"])

    schema = ", ".join(f"`{features.schema[c].name}` {features.schema[c].dataType.simpleString()}" for c in names)
    return features.mapInArrow(run, f"{schema}, zoom int, rings array<array<{POINT}>>")


def _rings(column: pa.ListArray):
    """The rings of each row as arrays, none for null."""
    outer, lists = column.offsets.to_numpy(), column.values
    inner, points = lists.offsets.to_numpy(), lists.values
    flat = np.stack([points.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1).astype(np.int64) if len(points) else np.empty((0, 2), np.int64)
    for valid, a, b in zip(column.is_valid().to_pylist(), outer, outer[1:], strict=False):
        yield [flat[inner[k] : inner[k + 1]] for k in range(a, b)] if valid else []


def _nested(shapes: list[list[np.ndarray]]) -> pa.ListArray:
    rings = [r for s in shapes for r in s]
    flat = np.concatenate([*rings, np.empty((0, 2), np.int64)]).astype(np.int32)
    ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], fields=list(POINT_TYPE))
    return pa.ListArray.from_arrays(ends([len(s) for s in shapes]), pa.ListArray.from_arrays(ends([len(r) for r in rings]), points))


def lines_and_rings(features: DataFrame, points_col: str = "points") -> DataFrame:
    """A feature's points as its only ring."""
    return features.withColumn("rings", F.array(points_col)).drop(points_col)
