"""Good time intervals, their join, counts cubes: properties and edge rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from starloom.operators import cubes, events
from starloom.sources import tables

EDGES = [(0.0, 10.0), (2.0, 5.0), (10.0, 12.0), (20.0, 21.0)]


def intervals(spark, rows):
    return spark.createDataFrame(rows, "start_s double, stop_s double")


@pytest.mark.parametrize("bucket", [3.0, 7.0, 1000.0])
def test_islands_merge_nested_touching_overlapping(spark, bucket):
    found = events.make_gti(intervals(spark, EDGES), bucket)
    assert sorted(map(tuple, found.collect())) == [(0.0, 12.0), (20.0, 21.0)]
    assert sorted(map(tuple, events.make_gti(found, bucket).collect())) == [(0.0, 12.0), (20.0, 21.0)]


def test_islands_across_empty_buckets(spark):
    found = events.make_gti(intervals(spark, [(0.0, 50.0), (31.0, 32.0), (49.0, 51.0), (60.0, 61.0)]), 10.0)
    assert sorted(map(tuple, found.collect())) == [(0.0, 51.0), (60.0, 61.0)]


def test_no_intervals(spark):
    assert events.make_gti(intervals(spark, [])).count() == 0


def test_photon_at_interval_stop_is_dropped(spark):
    photons = spark.createDataFrame([(0.0,), (11.9,), (12.0,), (20.0,), (21.0,), (None,)], "time_s double")
    found = events.filter_good_time(photons, intervals(spark, [(0.0, 12.0), (20.0, 21.0)]), 5.0)
    assert sorted(r[0] for r in found.collect()) == [0.0, 11.9, 20.0]


def test_bucket_join_equals_exists(spark, sf_dir):
    photons, gti = tables.scan_photons(spark, sf_dir), events.make_gti(events.quality(tables.scan_spacecraft(spark, sf_dir)))
    photons.createOrReplaceTempView("p")
    gti.createOrReplaceTempView("g")
    plain = spark.sql("SELECT event_id FROM p WHERE EXISTS (SELECT 1 FROM g WHERE time_s >= start_s AND time_s < stop_s)")
    assert sorted(plain.collect()) == sorted(events.filter_good_time(photons, gti).select("event_id").collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir):
    photons, gti = tables.scan_photons(spark, sf_dir), events.make_gti(events.quality(tables.scan_spacecraft(spark, sf_dir)))
    good = events.filter_good_time(photons, gti)
    assert "NestedLoop" not in plan_of(good) and "LeftSemi" in plan_of(good)
    cube = plan_of(cubes.counts_cube(photons, cubes.Aitoff(2.0, 180, 90)))
    assert cube.count("Exchange") == 1 and "partial_count" in cube


def test_energy_at_the_top_passes_the_cut_and_has_no_bin(spark):
    photons = spark.createDataFrame([(1000.0, 0.0, 0.0), (10000.0, 0.0, 0.0), (0.0, 0.0, 0.0), (None, 0.0, 0.0)], "energy_mev double, lon_deg double, lat_deg double")
    assert events.energy_range(photons, 1000, 10000).count() == 2
    assert [r["counts"] for r in cubes.counts_cube(photons, cubes.Aitoff(2.0, 180, 90)).collect()] == [1]


@pytest.mark.parametrize("grid", [cubes.Aitoff(2.0, 180, 90), cubes.PlateCarree(19, 37)])
def test_edges_of_the_sky_have_pixels(spark, grid):
    photons = spark.createDataFrame([(5000.0, lon, lat) for lon in (180.0, -180.0, 0.0) for lat in (-90.0, 0.0, 89.9)], "energy_mev double, lon_deg double, lat_deg double")
    assert sum(r["counts"] for r in cubes.counts_cube(photons, grid).collect()) >= 6


def test_weekly_cubes_sum_to_the_whole(spark, sf_dir):
    photons, grid = tables.scan_photons(spark, sf_dir), cubes.Aitoff(2.0, 180, 90)
    weeks = [cubes.counts_cube(photons.where(F.col("week") == w), grid) for w in range(5)]
    assert sorted(cubes.merge_sum(weeks).collect()) == sorted(cubes.counts_cube(photons, grid).collect())


def test_merge_strategies(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    assert cubes.merge([a, a], ["k"], "append").count() == 2
    assert cubes.merge([a, a], ["k"], "sum").dtypes == [("k", "int"), ("v", "bigint")]
    assert cubes.merge([a, a], ["k"], [F.max("v").alias("v")]).first()["v"] == 2
    with pytest.raises(ValueError, match="unknown"):
        cubes.merge([a], ["k"], "hierarchical")


def test_masks_and_open_ranges(spark, sf_dir):
    photons = tables.scan_photons(spark, sf_dir)
    n = photons.count()
    assert events.event_mask(photons).count() == events.time_range(photons).count() == events.cone(photons, 0, 0, 180).count() == events.select_events(photons).count() == n


def test_cuts_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, 2.0, 3.0)], "event_id long, energy_mev double, time_s double").write.parquet(path)
    for cut, pushed in ((lambda df: events.time_range(df, tmax=5), "LessThanOrEqual(time_s,5.0)"), (lambda df: events.zenith_max(df.withColumnRenamed("energy_mev", "zenith_deg"), 9), "LessThanOrEqual(energy_mev,9.0)")):
        plan = cut(spark.read.parquet(path)).select("event_id")._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan


def test_golden_numbers(spark):
    d = "/root/testdata/sf0.01"
    photons, craft = tables.scan_photons(spark, d), tables.scan_spacecraft(spark, d)
    gti = events.make_gti(events.quality(craft))
    assert (photons.count(), craft.count(), gti.count(), gti.agg(F.sum(F.col("stop_s") - F.col("start_s"))).first()[0]) == (10000, 720, 115, 2142000.0)
    good = events.filter_good_time(events.select_events(photons, emin=1000, emax=10000, zmax=90), gti)
    cube = cubes.counts_cube(good, cubes.Aitoff(2.0, 180, 90))
    assert (good.count(), cube.count(), cube.agg(F.sum("counts")).first()[0]) == (4299, 2862, 4298)
    assert math.isclose(photons.groupBy("week").count().orderBy("week").first()["count"], 2348)
