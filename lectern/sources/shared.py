"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; a temporary one only where none is set (local tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = f"file://{tempfile.gettempdir()}/lectern-shared"
    return f"{place.rstrip('/')}/lectern/{tag}-{uuid.uuid4().hex}"
