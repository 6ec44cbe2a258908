"""Intensity maps, masks, the template fit and its scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.sky import inclusive_lat, safe_div

PIXEL = ("plane", "iy", "ix")
#: So many values may be sorted in one task, and an exact median kept in one buffer.
FEW_VALUES = 1 << 16
SKETCH_ACCURACY = 10_000


def valid_exposure(column: str = "exposure") -> Column:
    """Exposure that is over zero and a number; a null is not valid."""
    return F.coalesce((F.col(column) > 0) & ~F.isnan(column), F.lit(False))


def intensity(exposure: DataFrame, counts: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    """``exposure`` with counts (0 where the cube has no row) and intensity = counts / exposure (0 where not valid)."""
    rows = exposure.join(counts, list(keys), "left").withColumn("counts", F.coalesce("counts", F.lit(0)))
    return rows.withColumn("intensity", F.when(valid_exposure(), F.col("counts") / F.col("exposure")).otherwise(0.0))


def ratio_map(a: DataFrame, b: DataFrame, on_zero: str = "null", keys: Sequence[str] = PIXEL, value_a: str = "counts", value_b: str = "exposure") -> DataFrame:
    """(keys, value): a / b for every pixel of b; a missing pixel of a is 0. ``on_zero`` is null, zero or nan."""
    other = {"null": F.lit(None).cast("double"), "zero": F.lit(0.0), "nan": F.lit(float("nan"))}[on_zero]
    rows = b.join(a, list(keys), "left")
    return rows.select(*keys, safe_div(F.coalesce(F.col(value_a), F.lit(0)), F.col(value_b), other).alias("value"))


def with_valid(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("valid", valid_exposure())


def with_fit_mask(pixels: DataFrame, bmin: float, nlat: int) -> DataFrame:
    """Adds lat_deg, plane_ok (at least ``bmin`` from the plane) and fit (valid as well)."""
    rows = pixels if "valid" in pixels.columns else with_valid(pixels)
    rows = rows.withColumn("lat_deg", inclusive_lat("iy", nlat)).withColumn("plane_ok", F.abs("lat_deg") >= bmin)
    return rows.withColumn("fit", F.col("plane_ok") & F.col("valid"))


def fit_pixels(pixels: DataFrame) -> DataFrame:
    """One row: fit and total pixels."""
    return pixels.agg(F.count_if("fit").alias("n_fit"), F.count("*").alias("n_total"))


def blank_invalid(pixels: DataFrame, columns: Sequence[str], nan: bool = True) -> DataFrame:
    """``columns`` without a value where the pixel is not valid: NaN, or null if not ``nan``."""
    blank = F.lit(float("nan")) if nan else F.lit(None).cast("double")
    return pixels.withColumns({c: F.when(F.col("valid"), F.col(c)).otherwise(blank) for c in columns})


def attach_template(pixels: DataFrame, template: DataFrame, name: str = "template") -> DataFrame:
    """Pixels with the template's ``value`` on the same grid as ``name``."""
    return pixels.join(template.select("iy", "ix", F.col("value").alias(name)), ["iy", "ix"])


def fit_template(pixels: DataFrame, templates: Sequence[str] = ("template",), cmin: float = 1.0) -> list[float]:
    """Weighted least squares of intensity on an offset and ``templates`` over the pixels to fit: [a0, a1, ...].

    Poisson weights E^2 / max(counts, cmin). One aggregation makes the normal equations' sums, a
    few numbers whatever the map's size; raises when they are singular.
    """
    x = [F.lit(1.0), *[F.col(t) for t in templates]]
    m = len(x)
    w = F.col("exposure") * F.col("exposure") / F.greatest(F.col("counts").cast("double"), F.lit(float(cmin)))
    sums = [F.sum(w * x[i] * x[j]).alias(f"s{i}_{j}") for i in range(m) for j in range(i, m)]
    sums += [F.sum(w * x[i] * F.col("intensity")).alias(f"d{i}") for i in range(m)]
    row = pixels.where("fit").agg(*sums).first()
    if row["d0"] is None:
        raise ValueError("no pixel to fit")
    a = np.array([[row[f"s{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)])
    scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
    if np.linalg.matrix_rank(a / np.outer(scale, scale), tol=1e-12) < m:
        raise ValueError("the templates and the offset are not independent")
    return np.linalg.solve(a, np.array([row[f"d{i}"] for i in range(m)])).tolist()


def rms(column: str) -> Column:
    return F.sqrt(F.avg(F.col(column) * F.col(column)))


def mean_abs(column: str) -> Column:
    return F.avg(F.abs(column))


def median_abs(column: str, exact: bool = True) -> Column:
    """Exact median by default, all different values in one buffer (``exact_medians`` needs none); a bounded sketch otherwise."""
    return F.median(F.abs(column)) if exact else F.percentile_approx(F.abs(column), 0.5)


@dataclass
class _Rank:
    """The value of ``rank`` (from 0) among the ``inside`` values that are over ``low`` and under ``high`` (None: no bound)."""

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def held(self) -> Column:
        """The column where it lies inside, else null."""
        x = F.col(self.column)
        bounds = [x > self.low] * (self.low is not None) + [x < self.high] * (self.high is not None)
        return F.when(reduce(lambda a, b: a & b, bounds), x) if bounds else x

    def narrow(self, a: float, b: float, under: int, at_a: int, between: int, at_b: int) -> None:
        """Keeps the part in which the rank lies, of those that the values ``a`` and ``b`` make."""
        for value, low, high, n in ((None, self.low, a, under), (a, a, a, at_a), (None, a, b, between), (b, b, b, at_b)):
            if self.rank < n:
                self.value, self.low, self.high, self.inside = value, low, high, n
                return
            self.rank -= n
        self.low, self.inside = b, self.inside - under - at_a - between - at_b


def _values_of_ranks(values: DataFrame, wanted: list[_Rank], few: int) -> None:
    """Finds every rank's value. Two passes a round: a sketch gives two values around it, counts tell where it lies.

    A round leaves about one value in ``SKETCH_ACCURACY`` / 6, and always drops some; up to ``few`` are sorted in one task.
    """
    while open_ := [w for w in wanted if w.value is None]:
        many = [w for w in open_ if w.inside > few]
        if not many:
            found = values.agg(*[F.sort_array(F.collect_list(w.held))[w.rank].alias(f"v{i}") for i, w in enumerate(open_)]).first()
            for w, value in zip(open_, found, strict=True):
                w.value = value
            return
        near = 3 / SKETCH_ACCURACY
        around = [[max(0.0, w.rank / w.inside - near), min(1.0, w.rank / w.inside + near)] for w in many]
        cuts = values.agg(*[F.percentile_approx(w.held, q, SKETCH_ACCURACY).alias(f"q{i}") for i, (w, q) in enumerate(zip(many, around, strict=True))]).first()
        counts = []
        for i, (w, (a, b)) in enumerate(zip(many, cuts, strict=True)):
            x = w.held
            counts += [F.count_if(c).alias(f"n{i}_{k}") for k, c in enumerate((x < a, x == a, (x > a) & (x < b), (x == b) & F.lit(b != a)))]
        row = values.agg(*counts).first()
        for i, (w, (a, b)) in enumerate(zip(many, cuts, strict=True)):
            w.narrow(a, b, *row[4 * i : 4 * i + 4])


def exact_medians(rows: DataFrame, columns: Sequence[Column], few: int = FEW_VALUES) -> list[float | None]:
    """The exact median of each of ``columns`` (doubles; nulls and NaN take no part; no value: None), by selection.

    ``rows`` are read several times, so they should be stored. No task holds more than ``few`` values and a sketch.
    """
    names = [f"c{i}" for i in range(len(columns))]
    values = rows.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(n) for c, n in zip(columns, names, strict=True)])
    sizes = values.agg(*[F.count(n) for n in names]).first()
    wanted = [[_Rank(n, k, size) for k in ((size - 1) // 2, size // 2)] if size else [] for n, size in zip(names, sizes, strict=True)]
    _values_of_ranks(values, [w for pair in wanted for w in pair], few)
    return [(pair[0].value + pair[1].value) / 2 if pair else None for pair in wanted]


def improved(before: str = "intensity", after: str = "residual") -> tuple[Column, Column]:
    """Pixels whose absolute value falls, and all."""
    return F.count_if(F.abs(after) < F.abs(before)), F.count("*")


def scores(pixels: DataFrame, few: int = FEW_VALUES) -> DataFrame:
    """One row of before and after scores over the pixels to fit.

    The medians of more than ``few`` pixels are found by selection before, so ``pixels`` should be stored.
    """
    better, total = improved()
    fitted = pixels.where("fit")
    medians = [median_abs("intensity"), median_abs("residual")]
    if fitted.count() > few:
        medians = [F.lit(m) for m in exact_medians(fitted, [F.abs("intensity"), F.abs("residual")], few)]
    return fitted.agg(
        rms("intensity").alias("rms_before"), rms("residual").alias("rms_after"), mean_abs("intensity").alias("mean_before"), mean_abs("residual").alias("mean_after"),
        medians[0].alias("median_before"), medians[1].alias("median_after"), better.alias("n_improved"), total.alias("n_pixels"),
    )


def percent_change(scored: DataFrame) -> DataFrame:
    """``scores`` with percent changes (positive: better), the share improved, and the verdict on the RMS."""
    gain = lambda c: safe_div(100 * (F.col(f"{c}_before") - F.col(f"{c}_after")), F.col(f"{c}_before"))
    rows = scored.withColumns({f"{c}_change": gain(c) for c in ("rms", "mean", "median")})
    rows = rows.withColumn("percent_improved", safe_div(100.0 * F.col("n_improved"), F.col("n_pixels").cast("double")))
    return rows.withColumn("verdict", F.when(F.col("rms_after") < F.col("rms_before"), "improves").otherwise("worsens"))
