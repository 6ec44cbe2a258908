"""Counts cubes and the merges of partial results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.operators.events import merge_append


@dataclass(frozen=True)
class Aitoff:
    """An Aitoff pixel grid in galactic coordinates."""

    binsz: float
    nx: int
    ny: int

    def pixel(self, lon: str = "lon_deg", lat: str = "lat_deg") -> tuple[Column, Column]:
        return sky.ait_pixel(lon, lat, self.binsz, self.nx, self.ny)


@dataclass(frozen=True)
class PlateCarree:
    """A plate-carree grid whose outermost centres lie on the sky's edges."""

    ny: int
    nx: int

    def pixel(self, lon: str = "lon_deg", lat: str = "lat_deg") -> tuple[Column, Column]:
        return sky.car_pixel(lon, lat, self.ny, self.nx)


@dataclass(frozen=True)
class Blocks:
    """Square cells of ``size`` degrees counted from longitude 0 and latitude -90."""

    size: int

    @property
    def ny(self) -> int:
        return 180 // self.size

    @property
    def nx(self) -> int:
        return 360 // self.size

    def pixel(self, lon: str = "lon_deg", lat: str = "lat_deg") -> tuple[Column, Column]:
        return F.floor((F.col(lat) + 90) / self.size).cast("int"), F.floor(F.col(lon) / self.size).cast("int")


def counts_cube(photons: DataFrame, grid: Aitoff | PlateCarree | Blocks, emin: float = 1000.0, emax: float = 10000.0, planes: int = 1) -> DataFrame:
    """(plane, iy, ix, counts): photons by energy bin and pixel; those outside the bins or the grid are left out.

    A pixel that has no row has no photons.
    """
    iy, ix = grid.pixel()
    rows = photons.select(sky.log_bin("energy_mev", emin, emax, planes).alias("plane"), iy.alias("iy"), ix.alias("ix"))
    rows = rows.where(F.col("plane").between(0, planes - 1) & F.col("iy").between(0, grid.ny - 1) & F.col("ix").between(0, grid.nx - 1))
    return rows.groupBy("plane", "iy", "ix").agg(F.count("*").alias("counts"))


def merge_sum(cubes: Sequence[DataFrame], keys: Sequence[str] = ("plane", "iy", "ix"), value: str = "counts") -> DataFrame:
    """Pixel-wise sum of cubes; integers widen to bigint."""
    return merge_append(list(cubes)).groupBy(*keys).agg(F.sum(value).alias(value))


def merge_livetime(cubes: Sequence[DataFrame]) -> DataFrame:
    """Sum of livetime cubes. The tree of partial sums is the aggregation's own."""
    return merge_sum(cubes, ("iy", "ix", "cbin"), "livetime_s")


def merge(tables: Sequence[DataFrame], keys: Sequence[str], how: str | Sequence[Column]) -> DataFrame:
    """Merge by a strategy's name, ``sum`` or ``append``, or by aggregate columns of the user's own."""
    if how == "append":
        return merge_append(list(tables))
    rows = merge_append(list(tables))
    if how == "sum":
        how = [F.sum(c).alias(c) for c in rows.columns if c not in keys]
    if isinstance(how, str):
        raise ValueError(f"unknown merge strategy: {how}")
    return rows.groupBy(*keys).agg(*how)


