"""The jobs that users run: counts, exposure and corrected maps, template resampling, foreground removal, its assessment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.sky import ait_center
from starloom.operators import cubes, events, exposure, maps, template
from starloom.sources.scratch import stored


def aitoff_centers(spark, grid: cubes.Aitoff) -> DataFrame:
    """(iy, ix, lon_deg, lat_deg) of an Aitoff grid's pixels on the sky."""
    rows = spark.range(grid.nx * grid.ny).select(F.floor(F.col("id") / grid.nx).cast("int").alias("iy"), (F.col("id") % grid.nx).cast("int").alias("ix"))
    lon, lat = ait_center("iy", "ix", grid.binsz, grid.nx, grid.ny)
    return rows.select("iy", "ix", lon.alias("lon_deg"), lat.alias("lat_deg")).where("lon_deg IS NOT NULL")


def pointings(spacecraft: DataFrame, good: str = events.GOOD) -> tuple[DataFrame, DataFrame]:
    """(the pointing table, its good time intervals), both stored, so that each job that needs them reads them and derives nothing again."""
    held = stored(spacecraft, "pointings")
    return held, stored(events.make_gti(events.quality(held, good)), "gti")


def counts_map(photons: DataFrame, spacecraft: DataFrame, grid, emin: float = 1000.0, emax: float = 10000.0, planes: int = 1, zmax: float | None = 90.0, good: str = events.GOOD, gti: DataFrame | None = None, **cuts) -> DataFrame:
    """Counts cube of the selected photons in good time, over all files in one plan; ``gti`` where it is already known."""
    selected = events.select_events(photons, emin=emin, emax=emax, zmax=zmax, **cuts)
    gti = events.make_gti(events.quality(spacecraft, good)) if gti is None else gti
    return cubes.counts_cube(events.filter_good_time(selected, gti), grid, emin, emax, planes)


def exposure_map(
    spacecraft: DataFrame, aeff: DataFrame, energies: Sequence[float], centers: DataFrame, size: int = 1, dcostheta: float = 0.025, zmax: float | None = None,
    good: str = events.GOOD, gti: DataFrame | None = None, livetime: DataFrame | None = None,
) -> DataFrame:
    """Exposure at ``centers`` from the livetime on a coarse grid of ``size`` degrees.

    The livetime cube is the costliest step, so it is written once; give a written one as ``livetime``
    to use it for other energies or centres.
    """
    if livetime is None:
        gti = events.make_gti(events.quality(spacecraft, good)) if gti is None else gti
        livetime = stored(exposure.livetime_cube(spacecraft, gti, exposure.sky_pixels(spacecraft.sparkSession, size), dcostheta, zmax), "livetime")
    coarse = exposure.exposure_cube(livetime, aeff, list(energies), dcostheta)
    return exposure.refine(coarse, centers, size)


def corrected_map(counts: DataFrame, exposed: DataFrame, on_zero: str = "null") -> DataFrame:
    """Counts over exposure, pixel by pixel."""
    return maps.ratio_map(counts, exposed, on_zero)


def resample(sky: DataFrame, nside: int, grid: DataFrame) -> DataFrame:
    """An equal-area template on a grid."""
    return template.interpolate(sky, nside, grid)


def remove_foreground(counts: DataFrame, exposed: DataFrame, sky: DataFrame, nlat: int, bmin: float = 10.0, cmin: float = 1.0) -> DataFrame:
    """Pixels with intensity, model, residual, valid, fit and the coefficients a0 and a1.

    The model is a1 times the template; the fitted offset a0 is not subtracted. Fitting is an
    action, so the pixels are stored between it and what the caller does with the result.
    """
    rows = maps.with_fit_mask(maps.with_valid(maps.intensity(exposed, counts)), bmin, nlat)
    rows = stored(maps.attach_template(rows, sky), "pixels")
    a0, a1 = maps.fit_template(rows, cmin=cmin)
    rows = rows.withColumns({"a0": F.lit(a0), "a1": F.lit(a1), "model": F.lit(a1) * F.col("template")})
    return rows.withColumn("residual", F.col("intensity") - F.col("model"))


def assess(pixels: DataFrame) -> DataFrame:
    """One row of scores before and after, their changes, and the verdict."""
    return maps.percent_change(maps.scores(pixels))
