"""Livetime and exposure cubes from the pointing table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.sky import unit_vector
from starloom.operators.events import BUCKET_S

#: A livetime grid may have so many pixels: its directions are broadcast.
MAX_PIXELS = 1 << 18
#: Height in degrees of the cells that pixels are indexed by.
CELL_DEG = 10
#: What rounding may add to an angle's cosine; an angle on the edge counts as inside.
ROUNDING = 1e-12


def sky_pixels(spark: SparkSession, size: int = 1) -> DataFrame:
    """(p, iy, ix, l_deg, b_deg and unit vector px, py, pz) of a whole-sky grid of ``size`` degrees, longitude from -180."""
    ny, nx = 180 // size, 360 // size
    rows = spark.range(ny * nx).select(F.col("id").cast("int").alias("p"), F.floor(F.col("id") / nx).cast("int").alias("iy"), (F.col("id") % nx).cast("int").alias("ix"))
    rows = rows.withColumns({"l_deg": F.col("ix") * size - 180 + size / 2, "b_deg": F.col("iy") * size - 90 + size / 2})
    x, y, z = unit_vector("l_deg", "b_deg")
    return rows.withColumns({"px": x, "py": y, "pz": z})


def clipped_livetime(spacecraft: DataFrame, gti: DataFrame, bucket_s: float = BUCKET_S) -> DataFrame:
    """Pointing rows with livetime scaled by the share of them that lies in good time; rows without any are left out."""
    low, high = F.floor(F.col("start_s") / bucket_s), F.ceil(F.col("stop_s") / bucket_s) - 1
    bucket = F.explode(F.sequence(low, F.greatest(low, high)))
    good = gti.select(F.col("start_s").alias("g0"), F.col("stop_s").alias("g1"), bucket.alias("bucket"))
    rows = spacecraft.withColumn("bucket", bucket)
    begin, end = F.greatest("start_s", "g0"), F.least("stop_s", "g1")
    # a pair that shares several buckets counts in the first
    rows = rows.join(good, "bucket").where((end > begin) & (F.floor(begin / bucket_s) == F.col("bucket")))
    return rows.withColumn("livetime_s", F.col("livetime_s") * (end - begin) / (F.col("stop_s") - F.col("start_s"))).drop("bucket", "g0", "g1")


def pixel_cells(pixels: DataFrame, zmax: float | None = None, cell_deg: int = CELL_DEG) -> DataFrame:
    """Pixels grouped into cells: bands of latitude cut into intervals of longitude of about the same width on the sky.

    (cx, cy, cz, field, zenith, members): a cell's middle, and the least cosines to it of a pointing axis
    and of a zenith that can have one of its pixels in the field of view or within ``zmax``.
    """
    band = F.floor((F.col("b_deg") + 90) / cell_deg)
    middle = F.least(F.lit(90 - cell_deg / 2), band * cell_deg - 90 + cell_deg / 2)
    around = F.greatest(F.lit(1), F.round(360 / cell_deg * F.cos(F.radians(middle))).cast("int"))
    rows = pixels.select(band.alias("band"), F.floor(F.pmod(F.col("l_deg") + 180, F.lit(360.0)) / 360 * around).alias("part"), "iy", "ix", "px", "py", "pz")
    cells = rows.groupBy("band", "part").agg(*[F.sum(f"p{c}").alias(f"c{c}") for c in "xyz"], F.collect_list(F.struct("iy", "ix", "px", "py", "pz")).alias("members"))
    size = F.sqrt(F.col("cx") * F.col("cx") + F.col("cy") * F.col("cy") + F.col("cz") * F.col("cz"))
    # a full ring round the axis has no middle of its own: any direction does, its radius then covers the ring
    cells = cells.select("members", *[F.when(size > 1e-9, F.col(f"c{c}") / size).otherwise(F.lit(1.0 if c == "z" else 0.0)).alias(f"c{c}") for c in "xyz"])
    nearest = F.array_min(F.transform("members", lambda m: m["px"] * F.col("cx") + m["py"] * F.col("cy") + m["pz"] * F.col("cz")))
    radius = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), nearest))) + 1e-6
    reach = lambda degrees: F.cos(F.least(F.lit(math.pi), math.radians(degrees) + radius)) - ROUNDING
    return cells.select("members", "cx", "cy", "cz", reach(90.0).alias("field"), reach(180.0 if zmax is None else zmax).alias("zenith"))


def pair_livetime(spacecraft: DataFrame, pixels: DataFrame, zmax: float | None = None) -> DataFrame:
    """(iy, ix, costheta, livetime_s) of each pointing row and each of ``pixels``, any part of a grid, in its field of view (costheta >= 0) and within ``zmax`` degrees of its zenith.

    Rows of one pointing are summed first. They meet the cells of pixels, which are broadcast, and only
    those cells give pixels that the field of view and the zenith cap can reach. A pixel then costs two
    dot products, and partial sums absorb it.
    """
    count = pixels.count()
    if count > MAX_PIXELS:
        raise ValueError(f"{count} pixels are more than {MAX_PIXELS}")
    dot = lambda a, b: F.col(f"{a}x") * F.col(f"{b}x") + F.col(f"{a}y") * F.col(f"{b}y") + F.col(f"{a}z") * F.col(f"{b}z")
    rows = spacecraft.groupBy("z_lon_deg", "z_lat_deg", "zen_lon_deg", "zen_lat_deg").agg(F.sum("livetime_s").alias("livetime_s"))
    axes = zip(("zx", "zy", "zz", "nx", "ny", "nz"), (*unit_vector("z_lon_deg", "z_lat_deg"), *unit_vector("zen_lon_deg", "zen_lat_deg")), strict=True)
    rows = rows.select("livetime_s", *[v.alias(n) for n, v in axes])
    rows = rows.join(F.broadcast(pixel_cells(pixels, zmax)), (dot("z", "c") >= F.col("field")) & (dot("n", "c") >= F.col("zenith")))
    rows = rows.select("livetime_s", "zx", "zy", "zz", "nx", "ny", "nz", F.inline("members"))
    rows = rows.withColumn("costheta", dot("z", "p")).where(F.col("costheta") >= 0)
    if zmax is not None:
        rows = rows.where(dot("n", "p") >= math.cos(math.radians(zmax)) - ROUNDING)
    return rows.select("iy", "ix", "costheta", "livetime_s")


def livetime_cube(spacecraft: DataFrame, gti: DataFrame, pixels: DataFrame, dcostheta: float = 0.025, zmax: float | None = None) -> DataFrame:
    """(iy, ix, cbin, livetime_s): good livetime by pixel and uniform bin of the cosine to the pointing axis."""
    n = round(1 / dcostheta)
    rows = pair_livetime(clipped_livetime(spacecraft, gti), pixels, zmax)
    cbin = F.least(F.floor(F.col("costheta") / dcostheta), F.lit(n - 1)).cast("int")
    return rows.groupBy("iy", "ix", cbin.alias("cbin")).agg(F.sum("livetime_s").alias("livetime_s"))


def pair_response(ltcube: DataFrame, aeff: DataFrame, energies: list[float], dcostheta: float = 0.025, type_mask: int = 3) -> DataFrame:
    """``ltcube`` with plane and area: the effective area, summed over the event types in the mask, at each of ``energies``.

    The response has a row for each energy, cosine bin and type, a size that instruments fix.
    """
    plane = F.array_position(F.array(*[F.lit(float(e)) for e in energies]), F.col("energy_mev")) - 1
    rows = aeff.where(F.col("event_type").bitwiseAND(type_mask) != 0).withColumn("plane", plane.cast("int")).where("plane >= 0")
    cbin = F.least(F.floor(F.col("costheta") / dcostheta), F.lit(round(1 / dcostheta) - 1)).cast("int")
    area = rows.groupBy("plane", cbin.alias("cbin")).agg(F.sum("aeff_cm2").alias("area"))
    return ltcube.join(area, "cbin")


def exposure_cube(ltcube: DataFrame, aeff: DataFrame, energies: list[float], dcostheta: float = 0.025, type_mask: int = 3) -> DataFrame:
    """(plane, iy, ix, exposure): livetime times effective area, summed over the cosine bins."""
    rows = pair_response(ltcube, aeff, energies, dcostheta, type_mask)
    return rows.groupBy("plane", "iy", "ix").agg(F.sum(F.col("livetime_s") * F.col("area")).alias("exposure"))


def refine(coarse: DataFrame, grid: DataFrame, size: int = 1) -> DataFrame:
    """Exposure of the coarse pixel that holds each centre of ``grid`` (iy, ix, lon_deg, lat_deg); centres off the sky are left out."""
    ny, nx = 180 // size, 360 // size
    cy = F.least(F.floor((F.col("lat_deg") + 90) / size), F.lit(ny - 1)).cast("int")
    cx = F.pmod(F.floor((F.col("lon_deg") + 180) / size), F.lit(nx)).cast("int")
    fine = grid.where("lon_deg IS NOT NULL").select("iy", "ix", cy.alias("cy"), cx.alias("cx"))
    rough = coarse.withColumnsRenamed({"iy": "cy", "ix": "cx"})
    return fine.join(rough, ["cy", "cx"]).select("plane", "iy", "ix", "exposure")
