"""Quadtree tiles: children of cells, assignment to a depth, and leaves split by what they weigh.

A cell is a path of digits below the root and its bounds. Halves share their middle line, and a
feature goes to every child that its bounds touch. To a fixed depth, the first and last column and row
of a feature's bounds are found at once. Splitting by weight goes a level a round over keys, bounds and
weights only; features join their leaves at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import HALF_WORLD, overlaps
from ..functions.storage import scratch

# What a leaf may weigh.
LEAF_BYTES = 5_000_000
#: Depth at which a cell is a unit wide, and splitting ends.
MOST_DEPTH = 31
BOUNDS = ("xmin", "xmax", "ymin", "ymax")


def world() -> Column:
    return F.struct(*(F.lit(v).alias(k) for k, v in zip(BOUNDS, (-HALF_WORLD, HALF_WORLD) * 2, strict=True)))


def middle(low: Column, high: Column) -> Column:
    """Half way, cut towards zero."""
    return ((low.cast("bigint") + high.cast("bigint")) / F.lit(2.0)).cast("int")


def children(path: Column, cell: Column) -> Column:
    """The four children (path, cell): top left, top right, bottom left, bottom right."""
    x, y = middle(cell["xmin"], cell["xmax"]), middle(cell["ymin"], cell["ymax"])
    left, right = (cell["xmin"], x), (x, cell["xmax"])
    top, bottom = (y, cell["ymax"]), (cell["ymin"], y)

    def child(digit, xs, ys):
        box = F.struct(xs[0].alias("xmin"), xs[1].alias("xmax"), ys[0].alias("ymin"), ys[1].alias("ymax"))
        return F.struct(F.concat(path, F.lit(str(digit))).alias("path"), box.alias("cell"))

    return F.array(child(0, left, top), child(1, right, top), child(2, left, bottom), child(3, right, bottom))


def descend(cells: DataFrame, box: str = "bbox") -> DataFrame:
    """Rows (…, path, cell) once for each child cell that their bounds touch."""
    rest = [c for c in cells.columns if c not in ("path", "cell")]
    kids = F.filter(children(F.col("path"), F.col("cell")), lambda k: overlaps(k["cell"], F.col(box)))
    return cells.select(*rest, F.explode(kids).alias("k")).select(*rest, "k.path", "k.cell")


def at_root(features: DataFrame) -> DataFrame:
    return features.withColumn("path", F.lit("")).withColumn("cell", world())


def edges(depth: int) -> list[int]:
    """The lines between the columns (or rows) of a depth, from the least."""
    lines = [-HALF_WORLD, HALF_WORLD]
    for _ in range(depth):
        between = [int((a + b) / 2) for a, b in zip(lines, lines[1:], strict=False)]
        lines = sorted([*lines, *between])
    return lines


def span(box: Column, depth: int) -> Column:
    """(x0, x1, y0, y1): first and last column and row that bounds touch; null beyond the world."""
    lines = edges(depth)
    low, high = (F.array(*map(F.lit, part)) for part in (lines[:-1], lines[1:]))
    first = lambda least: F.size(F.filter(high, lambda v: v < least))
    last = lambda most: F.size(F.filter(low, lambda v: v <= most)) - 1
    found = F.struct(*(f(box[c]).alias(n) for f, c, n in ((first, "xmin", "x0"), (last, "xmax", "x1"), (first, "ymin", "y0"), (last, "ymax", "y1"))))
    return F.when(box.isNotNull() & overlaps(world(), box), found)


def cells(spans: DataFrame, depth: int, column: str = "span") -> DataFrame:
    """Rows once for each cell of their span: adds path, drops the span."""
    rest = [c for c in spans.columns if c != column]
    s = F.col(column)
    rows = spans.where(s.isNotNull()).select(*rest, s, F.explode(F.sequence(s["x0"], s["x1"])).alias("_x"))
    rows = rows.select(*rest, "_x", F.explode(F.sequence(s["y0"], s["y1"])).alias("_y"))
    bit = lambda c, k: F.shiftright(c, depth - 1 - k).bitwiseAND(F.lit(1))
    digits = [(2 * (1 - bit("_y", k)) + bit("_x", k)).cast("string") for k in range(depth)]
    return rows.select(*rest, F.concat(F.lit(""), *digits).alias("path"))


def at_depth(features: DataFrame, depth: int, box: str = "bbox") -> DataFrame:
    """Features (with bounds) in every cell of a depth that they touch: adds path.

    Bounds outside the world, or null, are in no cell.
    """
    return cells(features.withColumn("span", span(F.col(box), depth)), depth)


#: A cell is split if its children weigh, all in all, less than this many times as much.
MOST_SPREAD = 3


def leaves(features: DataFrame, keys: list[str], within: list[str], budget: int = LEAF_BYTES, most_depth: int = MOST_DEPTH, box: str = "bbox") -> tuple[DataFrame, DataFrame]:
    """(keys with the path of every leaf they are in, tile_index).

    features: keys, within (say layer and zoom: each combination has a tree of its own), bounds and
    bytes. A cell is a leaf when what touches it weighs no more than the budget, or at most_depth. A
    feature that outweighs the budget by itself fits no leaf, however small: it is in every leaf that
    it touches and counts for none. Nor is a cell split whose features mostly cover all of it, as its
    children would weigh as much each. tile_index: within, path, is_leaf, n, bytes, of inner cells too.
    """
    scratch(features.sparkSession)
    place = [*within, "path"]
    rows = at_root(features.select(*keys, *[c for c in within if c not in keys], box, "bytes").where(F.col(box).isNotNull())).checkpoint()
    found = index = None
    for depth in range(most_depth + 1):
        light = F.sum(F.when(F.col("bytes") <= budget, F.col("bytes")).otherwise(0)).cast("bigint").alias("light")
        sums = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").cast("bigint").alias("bytes"), light).checkpoint()
        heavy = sums.where((F.col("light") > budget) & F.lit(depth < most_depth)).select(*place, "light")
        if last := heavy.isEmpty():
            split = heavy.select(*place)
        else:
            kids = descend(rows.join(heavy.select(*place), place, "left_semi"), box).checkpoint()
            spread = kids.groupBy(*within, F.substring("path", 1, depth).alias("path")).agg(light.alias("spread"))
            split = heavy.join(spread, place).where(F.col("spread") < MOST_SPREAD * F.col("light")).select(*place).checkpoint()
            last = split.isEmpty()
        marked = sums.join(split.withColumn("open", F.lit(True)), place, "left")
        own = marked.select(*place, F.col("open").isNull().alias("is_leaf"), "n", "bytes")
        index = own if index is None else index.unionByName(own)
        held = rows.join(split, place, "left_anti").select(*dict.fromkeys([*keys, *within]), "path")
        found = held if found is None else found.unionByName(held)
        if last:
            break
        parents = split.withColumnRenamed("path", "_parent")
        rows = kids.withColumn("_parent", F.substring("path", 1, depth)).join(parents, [*within, "_parent"], "left_semi").select(*rows.columns)
    return found, index


def tile_path(layer: Column, zoom: Column, path: Column) -> Column:
    """The name of a tile: the root's and the path."""
    return F.concat(layer, F.lit("_"), zoom.cast("string"), F.lit("_"), path)


def write(tiles: DataFrame, dest: str) -> None:
    """Tiles (layer, zoom, path, …) as Parquet by layer, zoom and tile: readers prune by prefix."""
    named = tiles.withColumn("tile_path", tile_path(F.col("layer"), F.col("zoom"), F.col("path"))).drop("path")
    named.repartition("layer", "zoom", "tile_path").write.mode("overwrite").partitionBy("layer", "zoom", "tile_path").parquet(dest)
