"""A counts cube kept up to date from new event files.

Every merge of partial cubes is a sum, so a batch of new photons becomes one partial cube, written
under its batch number. Writing a batch again replaces it, so a restart counts nothing twice; readers
sum the partial cubes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.cubes import Aitoff, Blocks, PlateCarree, counts_cube, merge_sum
from starloom.operators.events import filter_good_time


def update_counts(photons: DataFrame, gti: DataFrame, grid: Aitoff | PlateCarree | Blocks, folder: str, checkpoint: str, **bins) -> StreamingQuery:
    """Start a query that adds all photons now in the streaming ``photons`` to the cube in ``folder`` and then stops."""

    def add(batch: DataFrame, number: int) -> None:
        cube = counts_cube(filter_good_time(batch, gti), grid, **bins)
        cube.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return photons.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """The cube over all batches so far."""
    return merge_sum([spark.read.parquet(folder).select("plane", "iy", "ix", "counts")])
