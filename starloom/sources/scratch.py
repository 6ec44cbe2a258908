"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path in ``spark.checkpoint.dir``; a local session without one, as in tests, gets a local folder."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="starloom-")
        context.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Compute ``df`` now into a table in the shared folder and return a scan of it."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
