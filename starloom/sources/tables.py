"""Scans, the photon and pointing tables, and maps with their headers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.event_files import read_events, write_events

WEEK_S = 604800
#: The table of a pointing file, its columns, and the names that other writers give them.
POINTING_TABLE = "SC_DATA"
POINTING_COLUMNS = (
    "start_s double, stop_s double, livetime_s double, data_qual int, lat_config int, z_lon_deg double, z_lat_deg double, zen_lon_deg double, zen_lat_deg double"
)
POINTING_ALIASES = {"start_s": ["start"], "stop_s": ["stop"], "livetime_s": ["livetime"], "z_lon_deg": ["l_scz"], "z_lat_deg": ["b_scz"], "zen_lon_deg": ["l_zenith"], "zen_lat_deg": ["b_zenith"]}
#: Versions of a map that stay: the present one, and the one before for those who still read it.
KEPT_VERSIONS = 2


def scan_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, length, modificationTime) of all files under ``folder`` whose name matches; raises when there are none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    if found.isEmpty():
        raise FileNotFoundError(f"no file matches {pattern} in {folder}")
    return found


def photons(events: DataFrame) -> DataFrame:
    """The photon table that the ``events`` table stands for."""
    t = "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)"
    return events.withColumn("t_us", F.expr(t)).selectExpr(
        "event_id", "t_us/1e6 AS time_s", "value*100 AS energy_mev",
        "((event_id*48271)%3600000)/1e4 AS lon_deg", "((event_id*69621)%1800001)/1e4-90 AS lat_deg",
        "((event_id*16807)%3600000)/1e4 AS ra_deg", "((event_id*40692)%1800001)/1e4-90 AS dec_deg",
        "((event_id*7919)%1200)/1e1 AS zenith_deg", "CAST(1+user_id%255 AS INT) AS event_class", "CAST(1+event_id%3 AS INT) AS event_type",
        "CAST(floor(t_us/6.048e11) AS INT) AS week", "concat('w', CAST(CAST(floor(t_us/6.048e11) AS INT) AS STRING)) AS source_file",
    )


def spacecraft(photons: DataFrame) -> DataFrame:
    """The pointing table: one row for each hour that has photons."""
    hours = photons.select(F.floor(F.col("time_s") / 3600).alias("h")).distinct()
    return hours.selectExpr(
        "h*3600e0 AS start_s", "(h+1)*3600e0 AS stop_s", "3060e0+(h*13)%11*36 AS livetime_s",
        "CASE WHEN h%9=4 THEN 0 ELSE 1 END AS data_qual", "CASE WHEN h%14=6 THEN 0 ELSE 1 END AS lat_config",
        "(h*317)%3600/1e1 AS z_lon_deg", "CAST((h*17)%81-40 AS DOUBLE) AS z_lat_deg",
        "((h*317)+200)%3600/1e1 AS zen_lon_deg", "CAST((h*17)%81-30 AS DOUBLE) AS zen_lat_deg",
    )


def scan_photons(spark: SparkSession, folder: str) -> DataFrame:
    return photons(spark.read.parquet(f"{folder}/events.parquet"))


def scan_spacecraft(spark: SparkSession, folder: str) -> DataFrame:
    """The one pointing table that every job reads; filter it before it is cached or joined."""
    return spacecraft(scan_photons(spark, folder))


def write_pointings(spacecraft: DataFrame, folder: str) -> None:
    """Pointing files sorted by start, one for each task's rows in time order."""
    write_events(spacecraft.select(*[c.split()[0] for c in POINTING_COLUMNS.split(", ")]).repartitionByRange("start_s"), folder, sorted_by="start_s", extension=POINTING_TABLE)


def read_pointings(spark: SparkSession, folder: str, between: tuple[float, float] | None = None, aliases: Mapping[str, Sequence[str]] = POINTING_ALIASES) -> DataFrame:
    """The pointing table of all files under ``folder``; with ``between``, only rows that start in that range."""
    return read_events(spark, folder, POINTING_COLUMNS, POINTING_TABLE, aliases=dict(aliases), between=("start_s", *between) if between else None)


def scan_plane(cube: DataFrame, plane: int = 0) -> DataFrame:
    """One energy plane of a cube; the filter reaches the Parquet scan."""
    return cube.where(F.col("plane") == plane)


def write_map(pixels: DataFrame, path: str, header: dict[str, str] | None = None, comment: str = "") -> None:
    """Overwrite a map of pixel rows and its header with an appended comment.

    Both go to a folder of their own first. Then a row is appended to the map's manifest, and from then on
    readers see both; a write that fails before leaves the old map as it is.
    """
    spark, version = pixels.sparkSession, uuid.uuid4().hex
    pixels.write.parquet(f"{path}/{version}/pixels")
    rows = [(k, v, "") for k, v in (header or {}).items()] + ([("COMMENT", "", comment)] if comment else [])
    spark.createDataFrame(rows, "key string, value string, comment string").coalesce(1).write.parquet(f"{path}/{version}/header")
    known = _versions(spark, path)
    spark.createDataFrame([(len(known), version)], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    for old in known[: -KEPT_VERSIONS + 1]:
        _remove(spark, f"{path}/{old}")


_MANIFEST = "number long, version string"


def _folder(spark: SparkSession, path: str):
    """The store of a path and the path on it, as Hadoop's objects."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _remove(spark: SparkSession, path: str) -> None:
    store, found = _folder(spark, path)
    store.delete(found, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The map's versions in the order of their commits."""
    store, found = _folder(spark, f"{path}/manifest")
    if not store.exists(found):
        return []
    return [r["version"] for r in spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").orderBy("number", "version").collect()]


def read_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pixels, header) of the version of a map that was committed last."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no map in {path}")
    return spark.read.parquet(f"{path}/{versions[-1]}/pixels"), spark.read.parquet(f"{path}/{versions[-1]}/header")


def store_by_pixel(pixels: DataFrame, name: str, path: str, keys: Sequence[str] = ("plane", "iy", "ix"), buckets: int = 64) -> DataFrame:
    """Write a map as table ``name`` of the session's catalog, in files under ``path``, bucketed and sorted by pixel, and scan it.

    Maps stored with equal keys and buckets are joined, divided and masked where they lie, without a shuffle.
    """
    pixels.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return pixels.sparkSession.table(name)
