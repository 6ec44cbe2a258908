"""Equal-area sky templates: resampling to grids and smoothing on the sphere."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.sky import ang_sep, beam_sigma, hp_center, hp_neighbours, hp_ring, ring_above, to_theta_phi, wrap_lon

#: A smoothing kernel is cut at so many sigmas.
KERNEL_SIGMAS = 5.0
#: Rings that a task smooths, and weights that it holds at a time.
BAND_RINGS = 32
BLOCK_CELLS = 1 << 20


def interpolate(template: DataFrame, nside: int, grid: DataFrame) -> DataFrame:
    """(iy, ix, value): the template (ipix, value) at each centre of ``grid`` from its four neighbours."""
    theta, phi = to_theta_phi("lon_deg", "lat_deg")
    near = grid.select("iy", "ix", F.explode(hp_neighbours(theta, phi, nside)).alias("n")).select("iy", "ix", "n.ipix", "n.w")
    return near.join(template, "ipix").groupBy("iy", "ix").agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def neighbour_pairs(template: DataFrame, nside: int, radius: float) -> DataFrame:
    """(ipix, other, distance, value): pixel pairs at most ``radius`` degrees apart, each with itself too; value is the other's.

    Both sides fall into latitude bands of the radius' height and cells of the longitude that the
    radius spans at the band's edge nearest a pole; one side is copied into the cells that it touches.
    """
    lon, lat = hp_center("ipix", nside)
    rows = template.select("ipix", "value", lon.alias("lon"), lat.alias("lat"))
    bands = max(1, int(180 // radius))
    height = 180.0 / bands
    band = F.least(F.floor((F.col("lat") + 90) / height), F.lit(bands - 1)).cast("int")

    def cells(b):
        """Cells round the sky in band ``b``, none narrower than the radius spans there."""
        edge = F.greatest(F.abs(b * height - 90), F.abs((b + 1) * height - 90))
        cosine = F.cos(F.radians(F.least(edge, F.lit(90.0))))
        half = F.least(F.lit(1.0), math.sin(math.radians(min(radius, 90.0))) / F.greatest(cosine, F.lit(1e-9)))
        return F.greatest(F.lit(1), F.floor(360 / F.greatest(F.degrees(F.asin(half)), F.lit(1e-6))) - 1).cast("int")

    near_pole = lambda b: (F.abs(b * height - 90) + radius >= 90) | (F.abs((b + 1) * height - 90) + radius >= 90)
    count = lambda b: F.when(near_pole(b), F.lit(1)).otherwise(cells(b))
    place = lambda b: F.least(F.floor(wrap_lon("lon") * count(b) / 360), count(b) - 1).cast("int")
    left = rows.withColumn("band", band)
    left = left.withColumn("cell", place(F.col("band"))).select("ipix", "lon", "lat", "band", "cell")
    right = rows.withColumn("band", F.explode(F.sequence(F.greatest(band - 1, F.lit(0)), F.least(band + 1, F.lit(bands - 1)))))
    n = count(F.col("band"))
    around = F.array_distinct(F.array(*[F.pmod(place(F.col("band")) + k, n) for k in (-1, 0, 1)]))
    right = right.withColumn("cell", F.explode(around)).select(F.col("ipix").alias("other"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), "value", "band", "cell")
    pairs = left.join(right, ["band", "cell"]).withColumn("distance", ang_sep("lon", "lat", "lon2", "lat2"))
    return pairs.where(F.col("distance") <= radius).select("ipix", "other", "distance", "value")


class _Rings:
    """Pixels, first longitude and colatitude of rings of equal-area pixels."""

    def __init__(self, nside: int) -> None:
        i = np.arange(4 * nside)
        cap = np.minimum(i, 4 * nside - i)
        self.size = np.minimum(4 * cap, 4 * nside)
        z = np.where(cap < nside, 1 - cap**2 / (3.0 * nside**2), 4 / 3 - 2 * cap / (3.0 * nside))
        self.theta = np.where(i <= 2 * nside, np.arccos(z), np.pi - np.arccos(z))
        self.shift = np.where((cap < nside) | ((i - nside) % 2 == 0), 0.5, 0.0)


def _weights(rings: _Rings, i: int, j: int, dphi: np.ndarray, radius: float, sigma: float) -> np.ndarray:
    """The kernel between places of rings i and j that are ``dphi`` apart; 0 beyond the radius."""
    t, u = rings.theta[i], rings.theta[j]
    hav = np.sin((t - u) / 2) ** 2 + np.sin(t) * np.sin(u) * np.sin(dphi / 2) ** 2
    d = np.degrees(2 * np.arcsin(np.sqrt(np.minimum(1.0, hav))))
    return np.where(d <= radius, np.exp(-d * d / (2 * sigma * sigma)), 0.0)


def _half_width(rings: _Rings, i: int, j: int, radius: float) -> float:
    """Half of the longitudes of ring j that lie within the radius of a place of ring i; negative if none do."""
    t, u = rings.theta[i], rings.theta[j]
    room = math.sin(math.radians(min(radius, 180.0)) / 2) ** 2 - math.sin((t - u) / 2) ** 2
    return -1.0 if room < -1e-12 else 2 * math.asin(math.sqrt(min(1.0, max(0.0, room) / (math.sin(t) * math.sin(u))))) + 1e-9


def smooth_ring(rings: _Rings, i: int, held: dict[int, np.ndarray], spectra: dict[int, np.ndarray], radius: float, sigma: float) -> np.ndarray:
    """Sums of weights times value and of weights, a row each, at the places of ring i.

    ``held`` has for each ring its values and 1 where it has a pixel, two rows, ``spectra`` their Fourier
    transforms. On rings of as many places the kernel is the same for every place, a product of
    spectra; on others each place has the weights of its own neighbours.
    """
    n = int(rings.size[i])
    total, spectrum = np.zeros((2, n)), np.zeros((2, n // 2 + 1), complex)
    for j, rows in held.items():
        half = _half_width(rings, i, j, radius)
        if half < 0:
            continue
        m = int(rings.size[j])
        if m == n:
            kernel = _weights(rings, i, j, 2 * np.pi * (np.arange(n) + rings.shift[j] - rings.shift[i]) / n, radius, sigma)
            spectrum += spectra[j] * np.conj(np.fft.rfft(kernel))
            continue
        wide = min(m, int(2 * half * m / (2 * np.pi)) + 2)
        for begin in range(0, n, max(1, BLOCK_CELLS // wide)):
            phi = 2 * np.pi * (np.arange(begin, min(n, begin + max(1, BLOCK_CELLS // wide))) + rings.shift[i]) / n
            first = np.ceil((phi - half) * m / (2 * np.pi) - rings.shift[j]).astype(np.int64)
            place = first[:, None] + np.arange(wide)
            w = _weights(rings, i, j, 2 * np.pi * (place + rings.shift[j]) / m - phi[:, None], radius, sigma)
            total[:, begin : begin + len(phi)] += (w * rows[:, place % m]).sum(2)
    return total + np.fft.irfft(spectrum, n, axis=1)


def smooth(template: DataFrame, nside: int, fwhm: float, band_rings: int = BAND_RINGS) -> DataFrame:
    """(ipix, value): the template (ipix, value; a row a pixel, any part of the sky) under a Gaussian beam of ``fwhm`` degrees, weights normalised for each pixel.

    Ring by ring: bands of ``band_rings`` rings go to tasks, with the rings around them that the kernel
    reaches; no pair of pixels is ever a row. A null value counts as 0.
    """
    sigma = beam_sigma(fwhm)
    radius = KERNEL_SIGMAS * sigma
    ring, place = hp_ring("ipix", nside)
    _, lat = hp_center("ipix", nside)
    last = 4 * nside - 1
    edge = lambda sign: F.sin(F.radians(F.least(F.greatest(lat + sign * (radius + 1e-6), F.lit(-90.0)), F.lit(90.0))))
    band = lambda r: F.floor((F.least(F.greatest(r, F.lit(1)), F.lit(last)) - 1) / band_rings)
    reached = F.explode(F.sequence(band(ring_above(edge(1), nside)), band(ring_above(edge(-1), nside) + 1)))
    rows = template.select(F.col("ipix").cast("long").alias("ipix"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"), ring.cast("int").alias("ring"), place.cast("int").alias("place"), reached.alias("band"))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rings = _Rings(nside)
        ipix, value, ring, place = (group.column(c).to_numpy() for c in ("ipix", "value", "ring", "place"))
        turn = np.argsort(ring, kind="stable")
        found, at = np.unique(ring[turn], return_index=True)
        held, own = {}, {}
        for r, rows in zip(found.tolist(), np.split(turn, at[1:]), strict=True):
            held[r] = np.zeros((2, rings.size[r]))
            held[r][0, place[rows]], held[r][1, place[rows]] = value[rows], 1.0
            own[r] = rows
        spectra = {r: np.fft.rfft(x, axis=1) for r, x in held.items()}
        first = key[0].as_py() * band_rings + 1
        out = [(own[r], smooth_ring(rings, r, held, spectra, radius, sigma)[:, place[own[r]]]) for r in range(first, min(last + 1, first + band_rings)) if r in own]
        if not out:
            return pa.table({"ipix": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        sums = np.concatenate([x for _, x in out], axis=1)
        return pa.table({"ipix": ipix[np.concatenate([x for x, _ in out])], "value": sums[0] / sums[1]})

    return rows.groupBy("band").applyInArrow(run, "ipix long, value double")
