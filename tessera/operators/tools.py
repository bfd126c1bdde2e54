"""Counts and histograms over stores: what the diagnostics need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a feature may weigh before it is reported.
OVERSIZE = 500_000
#: Symbols that one byte can name.
SYMBOLS = 256


def entity_counts(**tables: DataFrame) -> DataFrame:
    """(entity, n) of tables by kind."""
    out = None
    for kind, df in tables.items():
        own = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("entity"), "n")
        out = own if out is None else out.unionByName(own)
    return out


def key_histogram(tagged: DataFrame) -> DataFrame:
    """(key, n) over tag maps."""
    return tagged.select(F.explode(F.map_keys("tags")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def bytes_saved(tagged: DataFrame) -> DataFrame:
    """(symbol, n, saved): keys and values with how often they occur times how long they are."""
    words = tagged.select(F.explode(F.concat(F.map_keys("tags"), F.map_values("tags"))).alias("symbol"))
    counts = words.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("saved", (F.col("n") * F.octet_length("symbol")).cast("bigint"))


def top_symbols(tagged: DataFrame, most: int = SYMBOLS) -> DataFrame:
    """The symbols that save most, ties by the symbol."""
    return bytes_saved(tagged).orderBy(F.desc("saved"), "symbol").limit(most)


def size_histogram(sized: DataFrame, size: str = "bytes") -> DataFrame:
    return sized.groupBy(F.col(size).cast("bigint").alias("size")).agg(F.count(F.lit(1)).alias("n"))


def size_class(size: Column, classes: list[int]) -> Column:
    """The least class that holds a size, null where none does."""
    return F.array_min(F.filter(F.array(*(F.lit(c).cast("bigint") for c in sorted(classes))), lambda c: c >= size))


def slack(histogram: DataFrame, classes: list[int]) -> DataFrame:
    """(class, n, slack) of sizes (size, n): what is lost by rounding sizes up to classes."""
    own = histogram.withColumn("class", size_class(F.col("size"), classes)).where(F.col("class").isNotNull())
    return own.groupBy("class").agg(F.sum("n").cast("bigint").alias("n"), F.sum((F.col("class") - F.col("size")) * F.col("n")).cast("bigint").alias("slack"))


def geometric_classes(most: int, n: int = 64, least: int = 8) -> list[int]:
    """n classes from least to most, each about the same part above the one before."""
    ratio = (most / least) ** (1 / (n - 1))
    return sorted({max(least, round(least * ratio**i)) for i in range(n)} | {most})


def better_classes(sizes: dict[int, int], classes: list[int], rounds: int = 200) -> list[int]:
    """Classes moved, one at a time, to the sizes that lose least: hill climbing over a histogram.

    The costliest class is split at its best size; the one whose loss costs least goes.
    """

    def cost(own: list[int]) -> int:
        total = at = 0
        own = sorted(own)
        for size in sorted(sizes):
            while own[at] < size:
                at += 1
            total += (own[at] - size) * sizes[size]
        return total

    best, most = sorted(classes), max(max(sizes, default=0), max(classes))
    if best[-1] < most:
        best[-1] = most
    now = cost(best)
    for _ in range(rounds):
        by_class = {}
        at = 0
        for size in sorted(sizes):
            while best[at] < size:
                at += 1
            by_class.setdefault(best[at], []).append(size)
        worst = max(by_class, key=lambda c: sum((c - s) * sizes[s] for s in by_class[c]), default=None)
        if worst is None:
            break
        moves = [sorted({*best, s} - {gone}) for s in by_class[worst] if s != worst for gone in best[:-1] if gone != s]
        candidates = [(cost(m), m) for m in moves if len(m) == len(best)]
        if not candidates or min(candidates)[0] >= now:
            break
        now, best = min(candidates)
    return best


def local_and_global(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """(n, n_known, n_unknown): rows with one of the keys, and tagged rows with none."""
    known = F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, keys)))
    return tagged.where(F.size("tags") > 0).agg(F.count(F.lit(1)).alias("n"), F.count_if(known).alias("n_known"), F.count_if(~known).alias("n_unknown"))


def oversize(features: DataFrame, most: int = OVERSIZE, size: str = "bytes") -> DataFrame:
    return features.where(F.col(size) > most)
