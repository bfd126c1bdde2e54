"""python -m tessera ingest|resolve|tile|unmap: the steps of plans.pipeline from a shell."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import remap
from .plans import pipeline
from .sources import pbf

KINDS = {"n": "NODE", "w": "WAY", "r": "RELATION"}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tessera", description=__doc__)
    steps = out.add_subparsers(dest="step", required=True)
    own = steps.add_parser("ingest", help="map files to stores")
    own.add_argument("input", help=".pbf file or a folder of them")
    own.add_argument("--dest", required=True)
    own.add_argument("-r", "--remap", action="store_true", help="dense new ids in order of mention")
    own = steps.add_parser("resolve", help="locate ways, index references, build multipolygons")
    own.add_argument("store")
    own.add_argument("-m", "--no-multipolygons", action="store_true")
    own.add_argument("-r", "--no-resolve", action="store_true")
    own.add_argument("-u", "--no-updates", action="store_true", help="keep reverse references of ways only")
    own = steps.add_parser("tile", help="features by layer, zoom and tile")
    own.add_argument("store")
    own.add_argument("--dest", required=True)
    own.add_argument("-l", "--no-lod", action="store_true", help="the last zoom only, nothing simplified")
    own = steps.add_parser("unmap", help="the original of a new id")
    own.add_argument("store")
    own.add_argument("kind", choices=sorted(KINDS))
    own.add_argument("id", type=int)
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    if a.step == "ingest":
        pipeline.ingest(spark, pbf.read(spark, a.input), a.dest, a.remap)
    elif a.step == "resolve":
        pipeline.resolve_store(spark, a.store, not a.no_multipolygons, not a.no_resolve, not a.no_updates)
    elif a.step == "tile":
        pipeline.tile(spark, a.store, a.dest, not a.no_lod)
    else:
        for row in remap.original(spark.read.parquet(f"{a.store}/id_map"), KINDS[a.kind], a.id).collect():
            print(row.old_id, row.url)


if __name__ == "__main__":
    main()
