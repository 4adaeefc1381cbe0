"""A folder for tables that a query writes and reads again: in the one that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset, in a temporary folder of a local session."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
