"""Per-file status, the failure gate, and files that gave nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.events import with_good_time


class GateError(RuntimeError):
    """Too many files failed."""


def missing_files(listing: DataFrame, rows: DataFrame) -> DataFrame:
    """Listed files (source_file) without a row in ``rows``."""
    return listing.join(rows.select("source_file").distinct(), "source_file", "left_anti")


def file_status(listing: DataFrame, photons: DataFrame, selected: DataFrame, good: DataFrame) -> DataFrame:
    """(source_file, n_read, n_selected, n_good, status) of the files in ``listing`` (source_file, and ``error`` where it is known).

    A file is failed if it has an error or gave no row, empty if it gave none in good time.
    """
    counts = [rows.groupBy("source_file").agg(F.count("*").alias(name)) for rows, name in ((photons, "n_read"), (selected, "n_selected"), (good, "n_good"))]
    error = F.col("error") if "error" in listing.columns else F.lit(None).cast("string")
    out = listing.groupBy("source_file").agg(F.max(error).alias("error"))
    for c in counts:
        out = out.join(c, "source_file", "left")
    out = out.fillna(0, ["n_read", "n_selected", "n_good"])
    failed = F.col("error").isNotNull() | (F.col("n_read") == 0)
    return out.withColumn("status", F.when(failed, "failed").when(F.col("n_good") == 0, "empty").otherwise("ok")).drop("error")


def reported_status(rows: DataFrame, selected: Column, gti: DataFrame) -> DataFrame:
    """(source_file, n_read, n_selected, n_good, status, error) of each file, in one pass over ``rows``.

    ``rows`` are those of ``read_events(..., report=True)``: a row for each file, bad ones with their error,
    and the events. ``selected`` is the condition of the selection, ``gti`` the disjoint good time intervals.
    A file is failed if it has an error or gave no event, empty if it gave none that was selected in good time.
    """
    event = F.col("is_event")
    chosen = event & F.coalesce(selected, F.lit(False))
    counts = with_good_time(rows, gti).groupBy(F.col("file").alias("source_file")).agg(
        F.count_if(event).alias("n_read"), F.count_if(chosen).alias("n_selected"), F.count_if(chosen & F.col("in_good_time")).alias("n_good"), F.max("error").alias("error"),
    )
    failed = F.col("error").isNotNull() | (F.col("n_read") == 0)
    return counts.withColumn("status", F.when(failed, "failed").when(F.col("n_good") == 0, "empty").otherwise("ok"))


def failed_share(status: DataFrame) -> DataFrame:
    """One row: files, failed files and their share."""
    failed, total = F.count_if(F.col("status") == "failed"), F.count("*")
    return status.agg(total.alias("n_files"), failed.alias("n_failed"), F.try_divide(failed, total).alias("share"))


def gate(status: DataFrame, max_failed: float = 0.5) -> DataFrame:
    """The files to go on with; raises before anything is written if more than ``max_failed`` of them failed."""
    row = failed_share(status).first()
    if row["share"] is not None and row["share"] > max_failed:
        raise GateError(f"{row['n_failed']} of {row['n_files']} files failed")
    return status.where(F.col("status") != "failed")
