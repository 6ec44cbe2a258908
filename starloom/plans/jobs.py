"""Registered queries over the given tables, each with its oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.operators import cubes, events, exposure, maps, quality, template
from starloom.plans import composites
from starloom.plans.oracle import ORACLE_SQL
from starloom.sources import event_files, tables
from starloom.sources.scratch import new_folder

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
GRID = cubes.Aitoff(2.0, 180, 90)
COARSE = cubes.Aitoff(5.0, 72, 36)
BLOCKS = cubes.Blocks(10)
ENERGIES = [2000.0, 6000.0]
NSIDE = 8


def query(f):
    QUERIES[f.__name__] = f
    return f


def _r(column: str, digits: int = 4):
    """Rounded as in the oracle texts: sums of doubles depend on their order."""
    return F.round(column, digits).alias(column)


def _photons(spark, d):
    return tables.scan_photons(spark, d)


def _spacecraft(spark, d):
    return tables.scan_spacecraft(spark, d)


def _gti(spark, d):
    return events.make_gti(events.quality(_spacecraft(spark, d)))


def _good(spark, d):
    return events.filter_good_time(events.select_events(_photons(spark, d), emin=1000, emax=10000, zmax=90), _gti(spark, d))


def _counts(spark, d):
    return cubes.counts_cube(_good(spark, d), BLOCKS)


def _exposure(spark):
    """An exposure on the ten-degree grid with holes."""
    p = F.col("id")
    value = F.when(p % 13 == 0, 0.0).otherwise((1000 + p % 50).cast("double"))
    return spark.range(648).select(F.lit(0).alias("plane"), F.floor(p / 36).cast("int").alias("iy"), (p % 36).cast("int").alias("ix"), value.alias("exposure"))


def _template(spark):
    p = F.col("id")
    return spark.range(648).select(F.floor(p / 36).cast("int").alias("iy"), (p % 36).cast("int").alias("ix"), (1 + (p * 97 % 1000) / 1000).alias("value"))


def _sky(spark, d):
    """A full equal-area template made of the photons' mean energies."""
    means = _photons(spark, d).groupBy((F.col("event_id") * 97 % sky.npix(NSIDE)).alias("ipix")).agg((1 + F.avg("energy_mev") / 1000).alias("value"))
    return spark.range(sky.npix(NSIDE)).toDF("ipix").join(means, "ipix", "left").select("ipix", F.coalesce("value", F.lit(1.0)).alias("value"))


def _aeff(spark):
    """Effective area by energy, cosine bin and event type."""
    p, e = F.col("id"), F.array(*[F.lit(x) for x in ENERGIES])
    energy, place, kind = F.floor(p / 120), p % 40, F.floor(p / 40) % 3 + 1
    return spark.range(240).select(
        e[energy.cast("int")].alias("energy_mev"), ((place + 0.5) * 0.025).alias("costheta"), kind.cast("int").alias("event_type"), (1000 + energy * 100 + place * 7 + kind * 3).cast("double").alias("aeff_cm2"),
    )


def _map(spark, d):
    return maps.with_fit_mask(maps.with_valid(maps.intensity(_exposure(spark), _counts(spark, d))), 10.0, 18)


def _livetime(spark, d, zmax=None):
    return exposure.livetime_cube(*composites.pointings(_spacecraft(spark, d)), exposure.sky_pixels(spark, 10), 0.025, zmax)


def _removed(spark, d):
    return composites.remove_foreground(_counts(spark, d), _exposure(spark), _template(spark), 18)


# Sources and sinks


@query
def scan_files(spark, d):
    found = tables.scan_files(spark, f"{d}/events.parquet", "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
    rows = spark.read.parquet(f"{d}/events.parquet").groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"))
    return found.join(rows, "file_name")


@query
def ingest_events(spark, d):
    files = new_folder(spark, "events")
    event_files.write_events(_photons(spark, d), files)
    return event_files.ingest_events(spark, files, new_folder(spark, "photons"))


@query
def scan_spacecraft(spark, d):
    return tables.scan_spacecraft(spark, d)


@query
def pointing_files(spark, d):
    files = new_folder(spark, "pointings")
    tables.write_pointings(_spacecraft(spark, d), files)
    return tables.read_pointings(spark, files)


@query
def pointing_faults(spark, d):
    rows = _spacecraft(spark, d).withColumn("stop_s", F.when(F.col("start_s") % 7 == 1, F.col("stop_s") + 1800).otherwise(F.col("stop_s")))
    return events.pointing_faults(rows)


@query
def scan_plane(spark, d):
    return tables.scan_plane(cubes.counts_cube(_photons(spark, d), GRID, planes=4), 1)


@query
def write_map(spark, d):
    path = new_folder(spark, "map")
    tables.write_map(_counts(spark, d), path, {"OBJECT": "sky"}, "counts in good time")
    return tables.read_map(spark, path)[0]


@query
def stored_maps(spark, d):
    """Intensity of two maps stored by pixel."""
    name = new_folder(spark, "map")
    counts, exposed = (tables.store_by_pixel(rows, f"{kind}_{name[-32:]}", f"{name}/{kind}", buckets=8) for rows, kind in ((_counts(spark, d), "counts"), (_exposure(spark), "exposure")))
    return maps.intensity(exposed, counts).select("plane", "iy", "ix", "counts", _r("intensity", 9))


# Filters


@query
def event_mask(spark, d):
    return events.event_mask(_photons(spark, d), 6, 2).select("event_id")


@query
def cone(spark, d):
    return events.cone(_photons(spark, d), 120.0, -30.0, 40.0).select("event_id")


@query
def time_range(spark, d):
    return events.time_range(_photons(spark, d), 259200.0, 1728000.0).select("event_id")


@query
def energy_range(spark, d):
    return events.energy_range(_photons(spark, d), 1000, 10000).select("event_id")


@query
def zenith_max(spark, d):
    return events.zenith_max(_photons(spark, d), 90).select("event_id")


@query
def select_events(spark, d):
    found = events.select_events(_photons(spark, d), class_mask=255, type_mask=3, ra0=120.0, dec0=-30.0, rad=90.0, tmin=86400.0, emin=1000, emax=10000, zmax=90)
    return found.select("event_id", "energy_mev", "source_file")


@query
def quality_rows(spark, d):
    return events.quality(_spacecraft(spark, d)).select("start_s", "stop_s", "livetime_s")


@query
def with_valid(spark, d):
    return maps.with_valid(maps.intensity(_exposure(spark), _counts(spark, d))).select("iy", "ix", "counts", "valid")


@query
def with_fit_mask(spark, d):
    return _map(spark, d).select("iy", "ix", _r("lat_deg", 6), "valid", "fit")


@query
def fit_pixels(spark, d):
    return maps.fit_pixels(_map(spark, d).where("counts >= 0"))


@query
def blank_invalid(spark, d):
    return maps.blank_invalid(_map(spark, d), ["intensity"], nan=False).select("iy", "ix", _r("intensity", 9))


# Joins


@query
def filter_good_time(spark, d):
    return _good(spark, d).select("event_id", "source_file")


@query
def intensity(spark, d):
    return maps.intensity(_exposure(spark), _counts(spark, d)).select("plane", "iy", "ix", "counts", _r("intensity", 9))


@query
def ratio_map(spark, d):
    return maps.ratio_map(_counts(spark, d), _exposure(spark), "zero").select("iy", "ix", _r("value", 9))


@query
def attach_template(spark, d):
    return maps.attach_template(_map(spark, d), _template(spark)).select("iy", "ix", "counts", _r("template", 6))


@query
def pair_livetime(spark, d):
    rows = exposure.pair_livetime(exposure.clipped_livetime(_spacecraft(spark, d), _gti(spark, d)), exposure.sky_pixels(spark, 10))
    return rows.groupBy("iy", "ix").agg(F.sum("livetime_s").alias("livetime_s"), F.sum(F.col("livetime_s") * F.col("costheta")).alias("weighted")).select("iy", "ix", _r("livetime_s", 2), _r("weighted", 2))


@query
def pair_response(spark, d):
    rows = exposure.pair_response(_livetime(spark, d), _aeff(spark), ENERGIES)
    return rows.groupBy("plane", "cbin").agg(F.count("*").alias("n"), F.max("area").alias("area"), F.sum("livetime_s").alias("livetime_s")).select("plane", "cbin", "n", "area", _r("livetime_s", 2))


@query
def interpolate(spark, d):
    return template.interpolate(_sky(spark, d), NSIDE, sky.inclusive_grid(spark, 19, 37)).select("iy", "ix", _r("value", 6))


@query
def neighbour_pairs(spark, d):
    return template.neighbour_pairs(_sky(spark, d), NSIDE, 12.0).select("ipix", "other", _r("distance", 6), _r("value", 6))


@query
def missing_files(spark, d):
    listing = _photons(spark, d).select("source_file").distinct()
    return quality.missing_files(listing, events.time_range(_good(spark, d), 0.0, 1000000.0))


@query
def refine(spark, d):
    coarse = exposure.exposure_cube(_livetime(spark, d), _aeff(spark), ENERGIES)
    return exposure.refine(coarse, composites.aitoff_centers(spark, COARSE), 10).select("plane", "iy", "ix", _r("exposure", 1))


# Aggregations, windows, sets


@query
def make_gti(spark, d):
    return _gti(spark, d)


@query
def interval_islands(spark, d):
    return events.interval_islands(events.quality(_spacecraft(spark, d)).select("start_s", "stop_s"))


@query
def counts_cube(spark, d):
    return cubes.counts_cube(_good(spark, d), GRID, planes=3)


@query
def counts_plate_carree(spark, d):
    return cubes.counts_cube(_photons(spark, d), cubes.PlateCarree(19, 37))


@query
def merge_sum(spark, d):
    rows = _photons(spark, d)
    return cubes.merge_sum([cubes.counts_cube(rows.where(F.col("week") % 2 == k), GRID) for k in (0, 1)])


@query
def merge_append(spark, d):
    rows = _photons(spark, d).select("event_id", "source_file")
    return events.merge_append([rows.where("event_id % 2 = 0"), rows.where("event_id % 3 = 0")])


@query
def merge_custom(spark, d):
    rows = _photons(spark, d)
    cut = [rows.where(F.col("week") % 2 == k) for k in (0, 1)]
    return cubes.merge(cut, ["event_type"], [F.max("energy_mev").alias("most"), F.count("*").alias("n")])


@query
def livetime_cube(spark, d):
    return _livetime(spark, d, 105.0).select("iy", "ix", "cbin", _r("livetime_s"))


@query
def exposure_cube(spark, d):
    return exposure.exposure_cube(_livetime(spark, d), _aeff(spark), ENERGIES).select("plane", "iy", "ix", _r("exposure", 1))


@query
def merge_livetime(spark, d):
    rows, gti, pixels = _spacecraft(spark, d), _gti(spark, d), exposure.sky_pixels(spark, 10)
    weeks = [exposure.livetime_cube(rows.where(F.floor(F.col("start_s") / tables.WEEK_S) % 2 == k), gti, pixels) for k in (0, 1)]
    return cubes.merge_livetime(weeks).select("iy", "ix", "cbin", _r("livetime_s"))


@query
def fit_template(spark, d):
    rows = _removed(spark, d)
    return rows.groupBy("a0", "a1").agg(F.count_if("fit").alias("n_fit")).select(_r("a0", 9), _r("a1", 9), "n_fit")


@query
def rms(spark, d):
    return _removed(spark, d).where("fit").agg(maps.rms("intensity").alias("before"), maps.rms("residual").alias("after")).select(_r("before", 9), _r("after", 9))


@query
def mean_abs(spark, d):
    return _removed(spark, d).where("fit").agg(maps.mean_abs("intensity").alias("before"), maps.mean_abs("residual").alias("after")).select(_r("before", 9), _r("after", 9))


@query
def median_abs(spark, d):
    return _removed(spark, d).where("fit").agg(maps.median_abs("intensity").alias("before"), maps.median_abs("residual").alias("after")).select(_r("before", 9), _r("after", 9))


@query
def improved(spark, d):
    better, total = maps.improved()
    return _removed(spark, d).where("fit").agg(better.alias("n_improved"), total.alias("n_pixels"))


@query
def percent_change(spark, d):
    return maps.percent_change(maps.scores(_removed(spark, d))).select("verdict", _r("rms_change"), _r("mean_change"), _r("median_change"), _r("percent_improved"))


# Quality


@query
def file_status(spark, d):
    rows = _photons(spark, d)
    return quality.file_status(rows.select("source_file").distinct(), rows, events.energy_range(rows, 1000, 10000), _good(spark, d))


@query
def reported_status(spark, d):
    """Status of event files on disk, one of them broken, read once."""
    files = new_folder(spark, "events")
    event_files.write_events(_photons(spark, d), files, file_by="source_file", sorted_by="time_s")
    fs, path = event_files.file_system(files)
    with fs.open_output_stream(f"{path}/broken.fits") as out:
        out.write(b"SIMPLE  =")
    rows = event_files.read_events(spark, files, "time_s double, energy_mev double, zenith_deg double", report=True)
    early = _gti(spark, d).where("start_s < 1500000")
    found = quality.reported_status(rows, F.col("energy_mev").between(1000, 10000) & (F.col("zenith_deg") <= 90), early)
    return found.select("source_file", "n_read", "n_selected", "n_good", "status")


@query
def gate(spark, d):
    rows = _photons(spark, d)
    status = quality.file_status(rows.select("source_file").distinct(), events.time_range(rows, 0.0, 1500000.0), rows, _good(spark, d))
    quality.gate(status)
    return quality.failed_share(status).select("n_files", "n_failed", _r("share", 6))


# Functions


@query
def sky_functions(spark, d):
    theta, phi = sky.to_theta_phi("lon_deg", "lat_deg")
    cy, cx = sky.car_pixel("lon_deg", "lat_deg", 19, 37)
    ay, ax = sky.ait_pixel("lon_deg", "lat_deg", 2.0, 180, 90)
    return _photons(spark, d).select(
        "event_id", sky.unwrap_lon("lon_deg").alias("lon"), F.round(theta, 9).alias("theta"), F.round(phi, 9).alias("phi"), sky.log_bin("energy_mev", 100, 50000, 8).alias("bin"),
        cy.alias("cy"), cx.alias("cx"), ay.alias("ay"), ax.alias("ax"), F.round(sky.ang_sep("lon_deg", "lat_deg", "ra_deg", "dec_deg"), 6).alias("apart"),
        F.round(sky.beam(F.col("zenith_deg"), 60.0), 9).alias("beam"), F.round(sky.safe_div("energy_mev", "zenith_deg"), 6).alias("ratio"), sky.file_stem(F.concat(F.lit("a/b/"), F.col("source_file"), F.lit(".fits"))).alias("stem"),
    )


@query
def aitoff_round_trip(spark, d):
    iy, ix = sky.ait_pixel("lon_deg", "lat_deg", 2.0, 180, 90)
    lon, lat = sky.ait_center("iy", "ix", 2.0, 180, 90)
    return _photons(spark, d).select("event_id", iy.alias("iy"), ix.alias("ix")).select("event_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query
def inclusive_grid(spark, d):
    centers = sky.inclusive_grid(spark, 19, 37)
    return cubes.counts_cube(_photons(spark, d), cubes.PlateCarree(19, 37)).join(centers, ["iy", "ix"]).select("iy", "ix", "lat_deg", "lon_deg", "counts")


@query
def hp_neighbours(spark, d):
    theta, phi = sky.to_theta_phi("lon_deg", "lat_deg")
    rows = _photons(spark, d).select("event_id", F.explode(sky.hp_neighbours(theta, phi, NSIDE)).alias("n"))
    return rows.groupBy("event_id").agg(F.sum("n.w").alias("total"), F.sum(F.col("n.w") * F.col("n.ipix")).alias("mean")).select("event_id", _r("total", 6), _r("mean"))


# Composite jobs


@query
def counts_map(spark, d):
    return composites.counts_map(_photons(spark, d), _spacecraft(spark, d), GRID)


@query
def exposure_map(spark, d):
    pointings, gti = composites.pointings(_spacecraft(spark, d))
    found = composites.exposure_map(pointings, _aeff(spark), ENERGIES, composites.aitoff_centers(spark, COARSE), 10, zmax=105.0, gti=gti)
    return found.select("plane", "iy", "ix", _r("exposure", 1))


@query
def corrected_map(spark, d):
    pointings, gti = composites.pointings(_spacecraft(spark, d))
    exposed = composites.exposure_map(pointings, _aeff(spark), ENERGIES, composites.aitoff_centers(spark, COARSE), 10, zmax=105.0, gti=gti)
    return composites.corrected_map(composites.counts_map(_photons(spark, d), pointings, COARSE, planes=2, gti=gti), exposed).select("plane", "iy", "ix", F.round(F.col("value") * 1e6, 4).alias("value"))


@query
def resample(spark, d):
    return composites.resample(_sky(spark, d), NSIDE, composites.aitoff_centers(spark, COARSE)).select("iy", "ix", _r("value", 6))


@query
def smooth(spark, d):
    return template.smooth(_sky(spark, d), NSIDE, 8.0).select("ipix", _r("value", 6))


@query
def remove_foreground(spark, d):
    return _removed(spark, d).select("iy", "ix", _r("intensity", 9), _r("model", 9), _r("residual", 9), "valid", "fit")


@query
def assess(spark, d):
    rows = composites.assess(_removed(spark, d))
    return rows.select("verdict", "n_improved", "n_pixels", *[_r(f"{c}_{k}", 9) for c in ("rms", "mean", "median") for k in ("before", "after")], *[_r(f"{c}_change") for c in ("rms", "mean", "median")])
