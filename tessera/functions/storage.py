"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is named, a local session gets one of its own; on a
    cluster no folder of this machine would do, so that is an error."""
    sc = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not top:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(top)
    return top.rstrip("/")


def fresh(spark: SparkSession) -> str:
    """The path of a new folder below it."""
    return f"{scratch(spark)}/{uuid.uuid4().hex}"
