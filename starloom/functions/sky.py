"""Sky geometry, binning and guarded arithmetic as Column builders. Angles are degrees unless named otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(x: Column | float | str) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def wrap_lon(lon, turn: float = 360.0) -> Column:
    """Longitude in [0, turn): negatives go up by one turn."""
    lon = _col(lon)
    return F.when(lon < 0, lon + turn).otherwise(lon)


def unwrap_lon(lon) -> Column:
    """Longitude in (-180, 180]: what is over 180 goes down by one turn."""
    lon = _col(lon)
    return F.when(lon > 180, lon - 360).otherwise(lon)


def to_theta_phi(lon, lat) -> tuple[Column, Column]:
    """Colatitude and longitude in radians, the latter in [0, 2 pi)."""
    return F.radians(F.lit(90.0) - _col(lat)), wrap_lon(F.radians(_col(lon)), 2 * math.pi)


def npix(nside: int) -> int:
    return 12 * nside * nside


def nside_of(pixels: int) -> int:
    """The nside of a full equal-area map; raises if no map has so many pixels."""
    nside = math.isqrt(pixels // 12)
    if nside < 1 or npix(nside) != pixels:
        raise ValueError(f"{pixels} is not 12 nside^2")
    return nside


def inclusive_grid(spark: SparkSession, nlat: int, nlon: int) -> DataFrame:
    """(iy, ix, lat_deg, lon_deg): the first and last centres lie on -90, 90 and -180, 180."""
    p = spark.range(nlat * nlon)
    iy, ix = F.floor(F.col("id") / nlon).cast("int"), (F.col("id") % nlon).cast("int")
    return p.select(iy.alias("iy"), ix.alias("ix"), inclusive_lat(iy, nlat).alias("lat_deg"), inclusive_lon(ix, nlon).alias("lon_deg"))


def inclusive_lat(iy, nlat: int) -> Column:
    return F.lit(-90.0) + F.lit(180.0) * _col(iy) / (nlat - 1)


def inclusive_lon(ix, nlon: int) -> Column:
    return F.lit(-180.0) + F.lit(360.0) * _col(ix) / (nlon - 1)


def log_bin(energy, emin: float, emax: float, n: int) -> Column:
    """Half-open logarithmic bin 0 to n - 1; outside [emin, emax) it is out of that range or null."""
    energy = _col(energy)
    return F.when(energy > 0, F.floor(n * F.ln(energy / emin) / math.log(emax / emin))).cast("int")


def ait_pixel(lon, lat, binsz: float, nx: int, ny: int) -> tuple[Column, Column]:
    """(iy, ix) on an Aitoff grid of ``nx`` by ``ny`` pixels of ``binsz`` degrees, longitude growing to the left."""
    half, b = F.radians(unwrap_lon(lon)) / 2, F.radians(_col(lat))
    gamma = F.sqrt(F.lit(2.0) / (F.lit(1.0) + F.cos(b) * F.cos(half)))
    x, y = F.degrees(2 * gamma * F.cos(b) * F.sin(half)), F.degrees(gamma * F.sin(b))
    return F.floor(y / binsz + ny / 2).cast("int"), F.floor(-x / binsz + nx / 2).cast("int")


def ait_center(iy, ix, binsz: float, nx: int, ny: int) -> tuple[Column, Column]:
    """(lon, lat) of a pixel's centre on the Aitoff grid; null outside the sky's ellipse. Longitude is in [-180, 180]."""
    x = F.radians(-(_col(ix) + 0.5 - nx / 2) * binsz)
    y = F.radians((_col(iy) + 0.5 - ny / 2) * binsz)
    z2 = F.lit(1.0) - (x / 4) * (x / 4) - (y / 2) * (y / 2)
    z = F.sqrt(F.greatest(z2, F.lit(0.0)))
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y * z))
    inside = z2 >= 0.5
    return F.when(inside, F.degrees(2 * F.atan2(z * x / 2, 2 * z2 - 1))), F.when(inside, F.degrees(F.asin(sine)))


def car_pixel(lon, lat, nlat: int, nlon: int) -> tuple[Column, Column]:
    """(iy, ix) of the nearest centre of ``inclusive_grid``, longitude taken in [-180, 180)."""
    lon = _col(lon)
    lon = F.when(lon >= 180, lon - 360).otherwise(lon)
    return (
        F.floor((_col(lat) + 90) / 180 * (nlat - 1) + 0.5).cast("int"),
        F.floor((lon + 180) / 360 * (nlon - 1) + 0.5).cast("int"),
    )


def unit_vector(lon, lat) -> tuple[Column, Column, Column]:
    l, b = F.radians(_col(lon)), F.radians(_col(lat))
    return F.cos(b) * F.cos(l), F.cos(b) * F.sin(l), F.sin(b)


def ang_sep(lon1, lat1, lon2, lat2) -> Column:
    """Angular distance by haversines, good for small angles."""
    l1, b1, l2, b2 = (F.radians(_col(x)) for x in (lon1, lat1, lon2, lat2))
    hav = F.pow(F.sin((b2 - b1) / 2), 2) + F.cos(b1) * F.cos(b2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), hav))))


def beam_sigma(fwhm: float) -> float:
    return fwhm / math.sqrt(8 * math.log(2))


def beam(distance, fwhm: float) -> Column:
    """Gaussian weight at a distance, in the units of ``fwhm``."""
    d = _col(distance)
    return F.exp(-d * d / (2 * beam_sigma(fwhm) ** 2))


def safe_div(a, b, on_zero: Column | None = None) -> Column:
    """a / b, or ``on_zero`` (null by default) where b is zero, null or NaN."""
    a, b = _col(a), _col(b)
    return F.when((b != 0) & ~F.isnan(b), a / b).otherwise(F.lit(None).cast("double") if on_zero is None else on_zero)


def file_stem(path) -> Column:
    """Last part of a path without ``.fits``, wherever that stands in it."""
    return F.regexp_replace(F.element_at(F.split(_col(path), "/"), -1), r"\.fits", "")


def hp_center(ipix, nside: int) -> tuple[Column, Column]:
    """(lon, lat) of an equal-area pixel's centre, ring order."""
    p, n, cap = _col(ipix).cast("long"), npix(nside), 2 * nside * (nside - 1)
    north, south = p < cap, p >= n - cap
    at = F.when(north, p).when(south, F.lit(n - 1) - p).otherwise(p - cap)
    ring = F.when(north | south, F.floor((1 + F.sqrt(1 + 2 * at.cast("double"))) / 2)).otherwise(F.floor(at / (4 * nside)) + nside)
    place = F.when(north | south, at - 2 * ring * (ring - 1)).otherwise(at % (4 * nside))
    polar = F.lit(1.0) - ring * ring / F.lit(3.0 * nside * nside)
    z = F.when(north, polar).when(south, -polar).otherwise(F.lit(4.0 / 3) - 2 * ring / F.lit(3.0 * nside))
    turn = F.when(north, (place + 0.5) * 90.0 / ring).when(south, F.lit(360.0) - (place + 0.5) * 90.0 / ring)
    shift = F.when((ring - nside) % 2 == 0, 0.5).otherwise(0.0)
    return turn.otherwise((place + shift) * 90.0 / nside), F.degrees(F.asin(z))


def _ring(i: Column, nside: int) -> tuple[Column, Column, Column, Column]:
    """First pixel, pixels, colatitude and half-pixel shift of ring i from 1 to 4 nside - 1."""
    last = 4 * nside - i
    north, south = i < nside, i > 3 * nside
    size = F.when(north, 4 * i).when(south, 4 * last).otherwise(F.lit(4 * nside)).cast("long")
    first = F.when(north, 2 * i * (i - 1)).when(south, npix(nside) - 2 * last * (last + 1)).otherwise(2 * nside * (nside - 1) + 4 * nside * (i - nside)).cast("long")
    cap = lambda k: F.lit(1.0) - k * k / F.lit(3.0 * nside * nside)
    z = F.when(north, cap(i)).when(south, -cap(last)).otherwise(F.lit(4.0 / 3) - 2 * i / F.lit(3.0 * nside))
    shift = F.when(north | south | ((i - nside) % 2 == 0), 0.5).otherwise(0.0)
    return first, size, F.acos(z), shift


def ring_above(z, nside: int) -> Column:
    """The ring (0: none) whose centres are next above the height z = sin(latitude), or on it."""
    z, south = _col(z), 4 * nside - 1
    cap = F.floor(nside * F.sqrt(3 * (F.lit(1.0) - F.abs(z))))
    found = F.when(F.abs(z) <= 2.0 / 3, F.floor(nside * (F.lit(2.0) - 1.5 * z))).when(z > 0, cap).otherwise(F.lit(south) - cap)
    return F.least(F.greatest(found, F.lit(0)), F.lit(south)).cast("long")


def hp_ring(ipix, nside: int) -> tuple[Column, Column]:
    """(ring from 1 to 4 nside - 1, place on it from 0) of an equal-area pixel, ring order."""
    p, n, cap = _col(ipix).cast("long"), npix(nside), 2 * nside * (nside - 1)
    north, south = p < cap, p >= n - cap
    at = F.when(north, p).when(south, F.lit(n - 1) - p).otherwise(p - cap)
    ring = F.when(north | south, F.floor((1 + F.sqrt(1 + 2 * at.cast("double"))) / 2)).otherwise(F.floor(at / (4 * nside)) + nside).cast("long")
    place = at - 2 * ring * (ring - 1)
    return F.when(south, 4 * nside - ring).otherwise(ring), F.when(north, place).when(south, 4 * ring - 1 - place).otherwise(at % (4 * nside))


def _let(value: Column, body) -> Column:
    """``body`` of a column that is computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def hp_neighbours(theta, phi, nside: int) -> Column:
    """array of four (ipix, w): bilinear weights on the two rings around (theta, phi) in radians.

    Beyond the last ring the value blends into the mean of the four polar pixels. Weights add up to 1;
    phi is in [0, 2 pi).
    """
    south = 4 * nside - 1
    entry = lambda p, w: F.struct(p.cast("long").alias("ipix"), w.alias("w"))

    def on_ring(i: Column, phi: Column) -> Column:
        """The two pixels of ring i next to phi, the second one's weight, and the ring's colatitude."""
        first, size, at, shift = _ring(i, nside)

        def pixels(r: Column) -> Column:
            low = F.floor(r["x"])
            return F.struct((r["first"] + F.pmod(low, r["size"])).alias("p1"), (r["first"] + F.pmod(low + 1, r["size"])).alias("p2"), (r["x"] - low).alias("w"), r["at"].alias("at"))

        ring = F.struct(first.alias("first"), size.alias("size"), at.alias("at"), shift.alias("shift"))
        return _let(_let(ring, lambda r: F.struct(r["first"].alias("first"), r["size"].alias("size"), r["at"].alias("at"), (phi * r["size"] / (2 * math.pi) - r["shift"]).alias("x"))), pixels)

    def blend(s: Column) -> Column:
        a, b, r = s["a"], s["b"], s["r"]
        top, bottom = r == 0, r == south
        t = F.when(top, s["theta"] / b["at"]).when(bottom, (s["theta"] - a["at"]) / (math.pi - a["at"])).otherwise((s["theta"] - a["at"]) / (b["at"] - a["at"]))

        def between(t: Column) -> Column:
            return F.array(entry(a["p1"], (1 - a["w"]) * (1 - t)), entry(a["p2"], a["w"] * (1 - t)), entry(b["p1"], (1 - b["w"]) * t), entry(b["p2"], b["w"] * t))

        def polar(ring: Column, base: int, share: Column) -> Column:
            pole = (1 - share) / 4
            other = lambda p: base + (p - base + 2) % 4
            return F.array(entry(ring["p1"], (1 - ring["w"]) * share + pole), entry(ring["p2"], ring["w"] * share + pole), entry(other(ring["p1"]), pole), entry(other(ring["p2"]), pole))

        return _let(t, lambda t: F.when(top, polar(b, 0, t)).when(bottom, polar(a, npix(nside) - 4, 1 - t)).otherwise(between(t)))

    def rings(v: Column) -> Column:
        r = v["r"]
        return F.struct(
            r.alias("r"), v["theta"].alias("theta"),
            _let(F.greatest(r, F.lit(1).cast("long")), lambda i: on_ring(i, v["phi"])).alias("a"), _let(F.least(r + 1, F.lit(south).cast("long")), lambda i: on_ring(i, v["phi"])).alias("b"),
        )

    start = F.struct(_col(theta).alias("theta"), _col(phi).alias("phi"), _let(F.cos(_col(theta)), lambda z: ring_above(z, nside)).alias("r"))
    return _let(_let(start, rings), blend)
