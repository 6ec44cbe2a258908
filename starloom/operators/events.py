"""Event selection, good time intervals and the join that applies them."""

from __future__ import annotations

from functools import reduce
from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.sky import ang_sep

#: Width of the buckets in which intervals and times are matched.
BUCKET_S = 21600.0
ISLAND_BUCKET_S = 604800.0
#: Length of the weeks in the photon table's column ``week``.
WEEK_S = 604800.0
GOOD = "data_qual > 0 AND lat_config = 1"


def _mask(column: str, mask: int | None) -> Column | None:
    return None if mask is None else F.col(column).bitwiseAND(mask) != 0


def _cone(ra0: float, dec0: float, rad: float) -> Column | None:
    return None if rad >= 180 else ang_sep("ra_deg", "dec_deg", ra0, dec0) <= rad


def _range(column: str, low: float | None, high: float | None) -> Column | None:
    parts = [F.col(column) >= low] * (low is not None) + [F.col(column) <= high] * (high is not None)
    return reduce(lambda a, b: a & b, parts) if parts else None


def _weeks(photons: DataFrame, tmin: float | None, tmax: float | None) -> Column | None:
    """The weeks that a time range touches, where the table has them: prunes the partitions of an ingested table."""
    return _range("week", None if tmin is None else floor(tmin / WEEK_S), None if tmax is None else floor(tmax / WEEK_S)) if "week" in photons.columns else None


def _where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def event_mask(photons: DataFrame, class_mask: int | None = None, type_mask: int | None = None) -> DataFrame:
    """Photons that share a bit with each mask; None makes no cut."""
    return _where(photons, _mask("event_class", class_mask), _mask("event_type", type_mask))


def cone(photons: DataFrame, ra0: float, dec0: float, rad: float) -> DataFrame:
    """Photons within ``rad`` degrees of a direction; 180 keeps all."""
    return _where(photons, _cone(ra0, dec0, rad))


def time_range(photons: DataFrame, tmin: float | None = None, tmax: float | None = None) -> DataFrame:
    """Photons of a time range, ends included; None is open. Plain comparisons, on the week too, so they reach the scan."""
    return _where(photons, _weeks(photons, tmin, tmax), _range("time_s", tmin, tmax))


def energy_range(photons: DataFrame, emin: float, emax: float) -> DataFrame:
    """Photons of an energy range, ends included."""
    return _where(photons, _range("energy_mev", emin, emax))


def zenith_max(photons: DataFrame, zmax: float) -> DataFrame:
    return _where(photons, F.col("zenith_deg") <= zmax)


def select_events(
    photons: DataFrame, *, class_mask: int | None = None, type_mask: int | None = None, ra0: float = 0.0, dec0: float = 0.0, rad: float = 180.0,
    tmin: float | None = None, tmax: float | None = None, emin: float | None = None, emax: float | None = None, zmax: float | None = None,
) -> DataFrame:
    """All cuts in one conjunction; those not given are left out."""
    return _where(
        photons, _mask("event_class", class_mask), _mask("event_type", type_mask), _weeks(photons, tmin, tmax), _range("time_s", tmin, tmax), _range("energy_mev", emin, emax),
        _range("zenith_deg", None, zmax), _cone(ra0, dec0, rad),
    )


def quality(spacecraft: DataFrame, expr: str = GOOD) -> DataFrame:
    """Pointing rows that satisfy the user's SQL predicate."""
    return spacecraft.where(F.expr(expr))


def _reached(intervals: DataFrame, bucket_s: float) -> DataFrame:
    """``intervals`` with ``bucket`` and ``upto``, the greatest stop of all that come before in the order of start and stop.

    A running maximum over all rows would need one partition. Here it runs inside time buckets, and
    only one row for each bucket, its greatest stop, is ordered globally.
    """
    before = Window.partitionBy("bucket").orderBy("start_s", "stop_s").rowsBetween(Window.unboundedPreceding, -1)
    rows = intervals.withColumn("bucket", F.floor(F.col("start_s") / bucket_s))
    across = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy("bucket").agg(F.max("stop_s").alias("reach")).select("bucket", F.max("reach").over(across).alias("earlier"))
    return rows.join(reach, "bucket").withColumn("upto", F.greatest(F.max("stop_s").over(before), "earlier")).drop("earlier")


def interval_islands(intervals: DataFrame, bucket_s: float = ISLAND_BUCKET_S) -> DataFrame:
    """``intervals`` (start_s, stop_s) plus ``island``, equal for those that overlap or touch, directly or through others.

    Islands are counted inside time buckets, and one row for each bucket, its number of new islands, is ordered globally.
    """
    across = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rows = _reached(intervals, bucket_s)
    rows = rows.withColumn("opens", F.when(F.col("upto").isNull() | (F.col("start_s") > F.col("upto")), 1).otherwise(0))
    opened = rows.groupBy("bucket").agg(F.sum("opens").alias("n")).select("bucket", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bucket").orderBy("start_s", "stop_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("within", F.sum("opens").over(inside)).join(opened, "bucket")
    return rows.select(*intervals.columns, (F.col("base") + F.col("within")).cast("long").alias("island"))


def pointing_faults(spacecraft: DataFrame, least_gap_s: float = 0.0, bucket_s: float = ISLAND_BUCKET_S) -> DataFrame:
    """(start_s, stop_s, fault, seconds): rows of a pointing table that begin before all earlier ones have ended ("overlap"), after more than ``least_gap_s`` ("gap"), or end before they begin ("backward").

    ``seconds`` is how long the overlap, the gap or the row is.
    """
    rows = _reached(spacecraft.select("start_s", "stop_s"), bucket_s)
    late = F.col("start_s") - F.col("upto")
    backward = F.col("stop_s") < F.col("start_s")
    fault = F.when(backward, "backward").when(late > least_gap_s, "gap").when(late < 0, "overlap")
    seconds = F.when(backward, F.col("start_s") - F.col("stop_s")).when(late > 0, late).otherwise(F.least("upto", "stop_s") - F.col("start_s"))
    return rows.select("start_s", "stop_s", fault.alias("fault"), seconds.alias("seconds")).where("fault IS NOT NULL")


def make_gti(spacecraft: DataFrame, bucket_s: float = ISLAND_BUCKET_S) -> DataFrame:
    """(start_s, stop_s) of the disjoint good time intervals that (already filtered) pointing rows make."""
    islands = interval_islands(spacecraft.select("start_s", "stop_s"), bucket_s)
    return islands.groupBy("island").agg(F.min("start_s").alias("start_s"), F.max("stop_s").alias("stop_s")).select("start_s", "stop_s")


def _in_good_time(photons: DataFrame, gti: DataFrame, bucket_s: float, how: str) -> DataFrame:
    """Intervals are dealt to the time buckets that they touch, so the match is an equi-join with a residual comparison; being disjoint, they match a photon at most once."""
    low, high = F.floor(F.col("start_s") / bucket_s), F.ceil(F.col("stop_s") / bucket_s) - 1
    spans = gti.where("stop_s > start_s").select("start_s", "stop_s", F.explode(F.sequence(low, F.greatest(low, high))).alias("gti_bucket"))
    here = (F.floor(F.col("time_s") / bucket_s) == F.col("gti_bucket")) & (F.col("time_s") >= F.col("start_s")) & (F.col("time_s") < F.col("stop_s"))
    return photons.join(spans, here, how)


def filter_good_time(photons: DataFrame, gti: DataFrame, bucket_s: float = BUCKET_S) -> DataFrame:
    """Photons with start <= time < stop for some interval of the disjoint ``gti``."""
    return _in_good_time(photons, gti, bucket_s, "left_semi")


def with_good_time(photons: DataFrame, gti: DataFrame, bucket_s: float = BUCKET_S) -> DataFrame:
    """All photons, and ``in_good_time``: whether ``filter_good_time`` would keep them."""
    return _in_good_time(photons, gti, bucket_s, "left").withColumn("in_good_time", F.col("gti_bucket").isNotNull()).drop("start_s", "stop_s", "gti_bucket")


def merge_append(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, duplicates kept, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)
