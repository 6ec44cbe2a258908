"""Intensity, masks, fit, scores, exposure, template resampling and smoothing."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.operators import cubes, events, exposure, maps, template
from starloom.plans import composites
from starloom.sources import tables

NSIDE = 8


def pixels(spark, rows):
    return spark.createDataFrame(rows, "plane int, iy int, ix int, exposure double")


def test_no_exposure_is_not_valid_and_no_counts_is_zero(spark):
    exposed = pixels(spark, [(0, 0, 0, 0.0), (0, 0, 1, float("nan")), (0, 0, 2, 2.0), (0, 0, 3, None), (0, 0, 4, 4.0)])
    counts = spark.createDataFrame([(0, 0, 0, 5), (0, 0, 4, 6)], "plane int, iy int, ix int, counts bigint")
    found = {r["ix"]: r for r in maps.blank_invalid(maps.with_valid(maps.intensity(exposed, counts)), ["intensity"], nan=False).collect()}
    assert [found[k]["valid"] for k in range(5)] == [False, False, True, False, True]
    assert [found[k]["intensity"] for k in range(5)] == [None, None, 0.0, None, 1.5]
    assert [found[k]["counts"] for k in range(5)] == [5, 0, 0, 0, 6]
    assert math.isnan(maps.blank_invalid(maps.with_valid(maps.intensity(exposed, counts)), ["intensity"]).where("ix = 0").first()["intensity"])


@pytest.mark.parametrize(("on_zero", "wanted"), [("null", None), ("zero", 0.0)])
def test_ratio_over_zero(spark, on_zero, wanted):
    exposed = pixels(spark, [(0, 0, 0, 0.0), (0, 0, 1, 2.0)])
    counts = spark.createDataFrame([(0, 0, 0, 5), (0, 0, 1, 5)], "plane int, iy int, ix int, counts bigint")
    assert [r["value"] for r in maps.ratio_map(counts, exposed, on_zero).orderBy("ix").collect()] == [wanted, 2.5]


def fit_rows(spark, n=40, noise=0.0):
    rng = np.random.default_rng(0)
    t = rng.random(n)
    value = 3 + 2 * t + noise * rng.random(n)
    rows = [(float(e), int(c), float(v), float(x), True) for e, c, v, x in zip(rng.random(n) + 1, rng.integers(0, 9, n), value, t, strict=True)]
    return spark.createDataFrame(rows, "exposure double, counts long, intensity double, template double, fit boolean"), rows


def test_fit_finds_planted_coefficients(spark):
    assert np.allclose(maps.fit_template(fit_rows(spark)[0]), [3, 2])


def test_fit_equals_numpy(spark):
    df, rows = fit_rows(spark, noise=1.0)
    e, c, v, t, _ = (np.array(x, float) for x in zip(*rows, strict=True))
    w = e * e / np.maximum(c, 1)
    a = np.stack([np.ones_like(t), t], 1)
    assert np.allclose(maps.fit_template(df), np.linalg.solve(a.T @ (a * w[:, None]), a.T @ (w * v)))


def test_singular_fit_raises(spark):
    df = fit_rows(spark)[0].withColumn("template", F.lit(1.0))
    with pytest.raises(ValueError, match="independent"):
        maps.fit_template(df)
    with pytest.raises(ValueError, match="no pixel"):
        maps.fit_template(df.withColumn("fit", F.lit(False)))


def test_scores(spark):
    df = spark.createDataFrame([(2.0, 1.0, True), (-4.0, 1.0, True), (6.0, -7.0, True), (100.0, 0.0, False)], "intensity double, residual double, fit boolean")
    row = composites.assess(df).first()
    assert (row["n_improved"], row["n_pixels"], row["median_before"], row["median_after"], row["mean_before"], row["verdict"]) == (2, 3, 4.0, 1.0, 4.0, "improves")
    assert math.isclose(row["rms_before"], math.sqrt(56 / 3)) and math.isclose(row["percent_improved"], 200 / 3)


def test_zero_scores_have_no_change(spark):
    row = composites.assess(spark.createDataFrame([(0.0, 0.0, True)], "intensity double, residual double, fit boolean")).first()
    assert row["rms_change"] is None and row["verdict"] == "worsens"


def weights(spark, angles):
    df = spark.createDataFrame(angles, "theta double, phi double")
    return df.select("theta", "phi", sky.hp_neighbours("theta", "phi", NSIDE).alias("n")).collect()


def test_interpolation_weights_sum_to_one_everywhere(spark):
    rng = np.random.default_rng(1)
    angles = [(float(math.acos(z)), float(p)) for z, p in zip(rng.uniform(-1, 1, 300), rng.uniform(0, 2 * math.pi, 300), strict=True)]
    angles += [(0.0, 0.0), (math.pi, 0.0), (1e-9, 6.28), (math.pi - 1e-9, 3.0), (math.pi / 2, 0.0), (math.acos(2 / 3), 1.0), (1.0, 2 * math.pi - 1e-12)]
    for r in weights(spark, angles):
        assert math.isclose(sum(x["w"] for x in r["n"]), 1, abs_tol=1e-9)
        assert all(0 <= x["ipix"] < sky.npix(NSIDE) and x["w"] > -1e-9 for x in r["n"])


def test_interpolation_is_exact_at_pixel_centers(spark):
    lon, lat = sky.hp_center("id", NSIDE)
    theta, phi = sky.to_theta_phi("lon", "lat")
    rows = spark.range(sky.npix(NSIDE)).select("id", lon.alias("lon"), lat.alias("lat")).select("id", F.explode(sky.hp_neighbours(theta, phi, NSIDE)).alias("n"))
    own = rows.where("n.ipix = id").groupBy("id").agg(F.sum("n.w").alias("w"))
    assert own.count() == sky.npix(NSIDE) and own.agg(F.min("w")).first()[0] > 1 - 1e-6


def full(spark, value):
    return spark.range(sky.npix(NSIDE)).select(F.col("id").alias("ipix"), value.alias("value"))


def test_constant_templates_stay_constant(spark):
    one = full(spark, F.lit(1.0))
    for found in (template.interpolate(one, NSIDE, sky.inclusive_grid(spark, 19, 37)), template.smooth(one, NSIDE, 8.0)):
        low, high = found.agg(F.min("value"), F.max("value")).first()
        assert math.isclose(low, 1, abs_tol=1e-9) and math.isclose(high, 1, abs_tol=1e-9)


@pytest.mark.parametrize("radius", [5.0, 17.0, 40.0, 100.0])
def test_neighbour_pairs_equal_all_pairs(spark, radius):
    nside = 4
    lon, lat = sky.hp_center("ipix", nside)
    sky_ = spark.range(sky.npix(nside)).select(F.col("id").alias("ipix"), F.lit(1.0).alias("value"))
    places = sky_.select("ipix", lon.alias("lon"), lat.alias("lat")).toPandas()
    l, b = np.radians(places.lon.to_numpy()), np.radians(places.lat.to_numpy())
    v = np.stack([np.cos(b) * np.cos(l), np.cos(b) * np.sin(l), np.sin(b)], 1)
    near = np.degrees(np.arccos(np.clip(v @ v.T, -1, 1))) <= radius
    found = template.neighbour_pairs(sky_, nside, radius).select("ipix", "other")
    assert found.count() == found.distinct().count() == near.sum()


def test_nside_of_rejects_other_sizes():
    assert sky.nside_of(768) == 8
    with pytest.raises(ValueError, match="nside"):
        sky.nside_of(100)


def test_livetime_by_week_sums_to_the_whole(spark, sf_dir):
    craft = tables.scan_spacecraft(spark, sf_dir)
    gti, sky_ = events.make_gti(events.quality(craft)), exposure.sky_pixels(spark, 30)
    week = F.floor(F.col("start_s") / tables.WEEK_S)
    parts = [exposure.livetime_cube(craft.where(week == w), gti, sky_) for w in range(5)]
    a = {r[:3]: r[3] for r in cubes.merge_livetime(parts).collect()}
    b = {r[:3]: r[3] for r in exposure.livetime_cube(craft, gti, sky_).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)


def test_part_of_a_grid_gets_its_part_of_the_cube(spark, sf_dir):
    rows = tables.scan_spacecraft(spark, sf_dir)
    gti, pixels_ = events.make_gti(events.quality(rows)), exposure.sky_pixels(spark, 10)
    whole = exposure.livetime_cube(rows, gti, pixels_)
    half = exposure.livetime_cube(rows, gti, pixels_.where("b_deg > 0"))
    key = lambda r: (r["iy"], r["ix"], r["cbin"], round(r["livetime_s"], 6))
    wanted = sorted(map(key, whole.where("iy >= 9").collect()))
    assert wanted and sorted(map(key, half.collect())) == wanted


def test_livetime_is_clipped_to_good_time(spark):
    craft = spark.createDataFrame([(0.0, 100.0, 50.0)], "start_s double, stop_s double, livetime_s double")
    gti = spark.createDataFrame([(10.0, 30.0), (90.0, 200.0)], "start_s double, stop_s double")
    assert math.isclose(exposure.clipped_livetime(craft, gti, 7.0).agg(F.sum("livetime_s")).first()[0], 15.0)


def test_too_fine_a_livetime_grid_raises(spark, monkeypatch):
    monkeypatch.setattr(exposure, "MAX_PIXELS", 10)
    with pytest.raises(ValueError, match="pixels"):
        exposure.pair_livetime(spark.createDataFrame([], "start_s double"), exposure.sky_pixels(spark, 30))


def all_pairs_smooth(rows, nside, fwhm):
    pairs = template.neighbour_pairs(rows, nside, template.KERNEL_SIGMAS * sky.beam_sigma(fwhm)).withColumn("w", sky.beam("distance", fwhm))
    return pairs.groupBy("ipix").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))


@pytest.mark.parametrize(("nside", "fwhm", "band"), [(8, 8.0, 32), (16, 5.0, 5), (4, 60.0, 3), (2, 10.0, 1)])
def test_smoothing_ring_by_ring_equals_all_pairs(spark, nside, fwhm, band):
    rows = spark.range(sky.npix(nside)).selectExpr("id AS ipix", "CAST(id * 97 % 1000 AS DOUBLE) AS value")
    for part in (rows, rows.where("ipix % 7 <> 3 AND value < 800")):
        found = {r["ipix"]: r["value"] for r in template.smooth(part, nside, fwhm, band).collect()}
        wanted = {r["ipix"]: r["value"] for r in all_pairs_smooth(part, nside, fwhm).collect()}
        assert found.keys() == wanted.keys()
        assert np.allclose([found[k] for k in wanted], list(wanted.values()), rtol=0, atol=2e-3)
        assert sum(abs(found[k] - v) > 1e-9 * 1000 for k, v in wanted.items()) <= len(wanted) / 50
    assert template.smooth(rows.limit(0), nside, fwhm).count() == 0


def test_rings_of_pixels(spark):
    rows = spark.range(sky.npix(4)).select("id", *[c.alias(n) for c, n in zip((*sky.hp_ring("id", 4), *sky.hp_center("id", 4)), ("ring", "place", "lon", "lat"), strict=True)])
    rings = template._Rings(4)
    for r in rows.collect():
        assert math.isclose(math.radians(90 - r["lat"]), rings.theta[r["ring"]], abs_tol=1e-9)
        assert math.isclose(r["lon"], 360 * (r["place"] + rings.shift[r["ring"]]) / rings.size[r["ring"]], abs_tol=1e-9)


def test_smoothing_at_full_size(spark):
    """At nside 512 all pairs would be over 10^9 rows; a plane wave keeps its form and loses its height."""
    nside, fwhm = 512, 1.0
    lon, lat = sky.hp_center("id", nside)
    rows = spark.range(sky.npix(nside)).select(F.col("id").alias("ipix"), F.sin(F.radians(lat)).alias("value"))
    found = template.smooth(rows, nside, fwhm).join(rows.withColumnRenamed("value", "before"), "ipix")
    kept = math.exp(-math.radians(sky.beam_sigma(fwhm)) ** 2)
    worst, n = found.agg(F.max(F.abs(F.col("value") - kept * F.col("before"))), F.count("*")).first()
    assert n == sky.npix(nside) and worst < 1e-5


@pytest.mark.parametrize("few", [1, 5, 1000])
def test_exact_medians_by_selection(spark, few):
    rng = np.random.default_rng(few)
    columns = [rng.normal(size=3001), np.where(rng.random(3001) < 0.7, 0.0, rng.random(3001)), rng.integers(0, 3, 3001).astype(float), 10.0 ** rng.integers(-300, 300, 3001)]
    rows = spark.createDataFrame([tuple(float(c[i]) for c in columns) for i in range(3001)], "a double, b double, c double, d double").repartition(4)
    for part, n in ((rows, 3001), (rows.limit(1), 1)):
        found = maps.exact_medians(part, [F.col(c) for c in "abcd"], few)
        if n > 1:
            assert found == [float(np.median(c)) for c in columns]
    even = spark.createDataFrame([(float(x),) for x in [*range(100), *range(100)]] + [(None,), (float("nan"),)], "x double")
    assert maps.exact_medians(even, [F.col("x"), F.lit(None).cast("double")], few) == [49.5, None]


def test_scores_by_selection_equal_those_of_one_buffer(spark):
    rows = spark.range(500).selectExpr("true AS fit", "sin(id) AS intensity", "sin(id) / (1 + id % 3) AS residual")
    assert maps.scores(rows, 20).first() == maps.scores(rows).first()


def test_cells_reach_every_pair_with_fewer_candidates(spark):
    rng = np.random.default_rng(4)
    pointings = [(float(a), float(b), float(c), float(d), 10.0) for a, b, c, d in zip(rng.random(40) * 360, rng.random(40) * 180 - 90, rng.random(40) * 360, rng.random(40) * 180 - 90, strict=True)]
    pointings += [(0.0, 90.0, 0.0, 90.0, 1.0), (0.0, -90.0, 10.0, 0.0, 1.0)]
    rows = spark.createDataFrame(pointings, "z_lon_deg double, z_lat_deg double, zen_lon_deg double, zen_lat_deg double, livetime_s double")
    pixels = exposure.sky_pixels(spark, 5)
    for zmax, part in ((None, pixels), (70.0, pixels), (105.0, pixels.where("p % 3 = 0 AND b_deg < 60")), (20.0, pixels.where("p = 7"))):
        wanted = rows.crossJoin(part)
        wanted = wanted.where(F.cos(F.radians(sky.ang_sep("z_lon_deg", "z_lat_deg", "l_deg", "b_deg"))) >= 0)
        wanted = wanted if zmax is None else wanted.where(sky.ang_sep("zen_lon_deg", "zen_lat_deg", "l_deg", "b_deg") <= zmax)
        found = exposure.pair_livetime(rows, part, zmax)
        assert found.groupBy("iy", "ix").agg(F.count("*")).exceptAll(wanted.groupBy("iy", "ix").agg(F.count("*"))).count() == 0
        assert found.count() == wanted.count()
    # candidates of a narrow cap: cells that it can touch
    cells = exposure.pixel_cells(pixels, 20.0)
    x, y, z = sky.unit_vector("zen_lon_deg", "zen_lat_deg")
    met = rows.select(x.alias("x"), y.alias("y"), z.alias("z")).join(cells, F.col("x") * F.col("cx") + F.col("y") * F.col("cy") + F.col("z") * F.col("cz") >= F.col("zenith"))
    assert met.agg(F.sum(F.size("members"))).first()[0] < 0.2 * rows.count() * pixels.count()
