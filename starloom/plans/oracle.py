"""DuckDB texts of the registered queries, put together from common table expressions."""

from __future__ import annotations

import math
import re

NSIDE = 8
_NPIX = 12 * NSIDE * NSIDE
_CAP = 2 * NSIDE * (NSIDE - 1)


def _ait(lon: str, lat: str, binsz: float, nx: int, ny: int) -> tuple[str, str]:
    half, b = f"(radians(CASE WHEN {lon} > 180 THEN {lon} - 360 ELSE {lon} END)/2)", f"radians({lat})"
    gamma = f"sqrt(2.0/(1.0 + cos({b})*cos({half})))"
    return (
        f"CAST(floor(degrees({gamma}*sin({b}))/{binsz} + {ny / 2}) AS INT)",
        f"CAST(floor(-degrees(2*{gamma}*cos({b})*sin({half}))/{binsz} + {nx / 2}) AS INT)",
    )


def _center(iy: str, ix: str, binsz: float, nx: int, ny: int) -> tuple[str, str, str]:
    x, y = f"radians(-({ix} + 0.5 - {nx / 2})*{binsz})", f"radians(({iy} + 0.5 - {ny / 2})*{binsz})"
    z2 = f"(1.0 - ({x}/4)*({x}/4) - ({y}/2)*({y}/2))"
    z = f"sqrt(greatest({z2}, 0.0))"
    return f"degrees(2*atan2({z}*{x}/2, 2*{z2} - 1))", f"degrees(asin(greatest(-1.0, least(1.0, {y}*{z}))))", f"{z2} >= 0.5"


def _sep(l1: str, b1: str, l2: str, b2: str) -> str:
    l1, b1, l2, b2 = (f"radians({x})" for x in (l1, b1, l2, b2))
    hav = f"pow(sin(({b2} - {b1})/2), 2) + cos({b1})*cos({b2})*pow(sin(({l2} - {l1})/2), 2)"
    return f"degrees(2*asin(sqrt(least(1.0, {hav}))))"


def _bin(emin: float, emax: float, n: int) -> str:
    return f"CASE WHEN energy_mev > 0 THEN CAST(floor({n}*ln(energy_mev/{emin})/{math.log(emax / emin)!r}) AS INT) END"


def _cube(source: str, iy: str, ix: str, ny: int, nx: int, planes: int) -> str:
    return (
        f"SELECT plane, iy, ix, count(*) AS counts FROM (SELECT {_bin(1000.0, 10000.0, planes)} AS plane, {iy} AS iy, {ix} AS ix FROM {source}) "
        f"WHERE plane BETWEEN 0 AND {planes - 1} AND iy BETWEEN 0 AND {ny - 1} AND ix BETWEEN 0 AND {nx - 1} GROUP BY ALL"
    )


_AIT2, _AIT5 = _ait("lon_deg", "lat_deg", 2.0, 180, 90), _ait("lon_deg", "lat_deg", 5.0, 72, 36)
_CAR = (
    "CAST(floor((lat_deg + 90)/180*18 + 0.5) AS INT)",
    "CAST(floor((CASE WHEN lon_deg >= 180 THEN lon_deg - 360 ELSE lon_deg END + 180)/360*36 + 0.5) AS INT)",
)
_LON5, _LAT5, _ON5 = _center("iy", "ix", 5.0, 72, 36)


def _ring(i: str) -> tuple[str, str, str, str]:
    """First pixel, pixels, colatitude, shift of a ring."""
    j = f"({4 * NSIDE} - {i})"
    sized = lambda a, b, c: f"(CASE WHEN {i} < {NSIDE} THEN {a} WHEN {i} > {3 * NSIDE} THEN {b} ELSE {c} END)"
    cap = lambda k: f"1.0 - {k}*{k}/{3.0 * NSIDE * NSIDE}"
    return (
        sized(f"2*{i}*({i} - 1)", f"{_NPIX} - 2*{j}*({j} + 1)", f"{_CAP} + {4 * NSIDE}*({i} - {NSIDE})"),
        sized(f"4*{i}", f"4*{j}", str(4 * NSIDE)),
        f"acos({sized(cap(i), f'-({cap(j)})', f'{4.0 / 3!r} - 2*{i}/{3.0 * NSIDE}')})",
        sized("0.5", "0.5", f"CASE WHEN ({i} - {NSIDE}) % 2 = 0 THEN 0.5 ELSE 0.0 END"),
    )


def _neighbours(source: str, key: str) -> str:
    """``key``, ipix and w for each row of ``source`` (key, theta, phi): per ring two pixels, and the four at a pole."""
    a, b = _ring("ra"), _ring("rb")
    two_pi = repr(2 * math.pi)
    return f"""
      rings_1 AS (SELECT {key}, theta, phi, cos(theta) AS z FROM {source}),
      rings_2 AS (SELECT *, CASE WHEN abs(z) <= {2.0 / 3!r} THEN floor({NSIDE}*(2.0 - 1.5*z)) WHEN z > 0 THEN floor({NSIDE}*sqrt(3*(1.0 - abs(z)))) ELSE {4 * NSIDE - 1} - floor({NSIDE}*sqrt(3*(1.0 - abs(z)))) END AS up FROM rings_1),
      rings_3 AS (SELECT {key}, theta, phi, CAST(least(greatest(up, 0), {4 * NSIDE - 1}) AS BIGINT) AS r FROM rings_2),
      rings_4 AS (SELECT *, greatest(r, 1) AS ra, least(r + 1, {4 * NSIDE - 1}) AS rb FROM rings_3),
      rings_5 AS (SELECT *, {a[0]} AS fa, {a[1]} AS na, {a[2]} AS ta, phi*{a[1]}/{two_pi} - {a[3]} AS xa, {b[0]} AS fb, {b[1]} AS nb, {b[2]} AS tb, phi*{b[1]}/{two_pi} - {b[3]} AS xb FROM rings_4),
      rings_6 AS (SELECT *, CASE WHEN r = 0 THEN theta/tb WHEN r = {4 * NSIDE - 1} THEN (theta - ta)/({math.pi!r} - ta) ELSE (theta - ta)/(tb - ta) END AS t FROM rings_5),
      near AS (
        SELECT {key}, fa + (CAST(floor(xa) AS BIGINT) + j + na) % na AS ipix, (CASE WHEN j = 0 THEN 1 - (xa - floor(xa)) ELSE xa - floor(xa) END)*(1 - t) AS w FROM rings_6, (VALUES (0), (1)) AS v(j) WHERE r > 0
        UNION ALL SELECT {key}, fb + (CAST(floor(xb) AS BIGINT) + j + nb) % nb, (CASE WHEN j = 0 THEN 1 - (xb - floor(xb)) ELSE xb - floor(xb) END)*t FROM rings_6, (VALUES (0), (1)) AS v(j) WHERE r < {4 * NSIDE - 1}
        UNION ALL SELECT {key}, CASE WHEN r = 0 THEN j ELSE {_NPIX - 4} + j END, (CASE WHEN r = 0 THEN 1 - t ELSE t END)/4 FROM rings_6, (VALUES (0), (1), (2), (3)) AS v(j) WHERE r = 0 OR r = {4 * NSIDE - 1}
      )"""


_WEIGHT = "exposure*exposure/greatest(CAST(counts AS DOUBLE), 1.0)"

#: Name -> (what it needs, its text); a text that holds several expressions begins with a newline.
_CTE: dict[str, tuple[str, str]] = {
    "photons": (
        "",
        """SELECT event_id, t_us/1e6 AS time_s, value*100 AS energy_mev, ((event_id*48271)%3600000)/1e4 AS lon_deg, ((event_id*69621)%1800001)/1e4-90 AS lat_deg,
      ((event_id*16807)%3600000)/1e4 AS ra_deg, ((event_id*40692)%1800001)/1e4-90 AS dec_deg, ((event_id*7919)%1200)/1e1 AS zenith_deg,
      CAST(1+user_id%255 AS INT) AS event_class, CAST(1+event_id%3 AS INT) AS event_type, CAST(floor(t_us/6.048e11) AS INT) AS week,
      concat('w', CAST(CAST(floor(t_us/6.048e11) AS INT) AS VARCHAR)) AS source_file FROM (SELECT *, epoch_us(ts) - 1704067200000000 AS t_us FROM events)""",
    ),
    "spacecraft": (
        "photons",
        """SELECT h*3600e0 AS start_s, (h+1)*3600e0 AS stop_s, 3060e0+(h*13)%11*36 AS livetime_s, CASE WHEN h%9=4 THEN 0 ELSE 1 END AS data_qual, CASE WHEN h%14=6 THEN 0 ELSE 1 END AS lat_config,
      (h*317)%3600/1e1 AS z_lon_deg, CAST((h*17)%81-40 AS DOUBLE) AS z_lat_deg, ((h*317)+200)%3600/1e1 AS zen_lon_deg, CAST((h*17)%81-30 AS DOUBLE) AS zen_lat_deg
      FROM (SELECT DISTINCT CAST(floor(time_s/3600) AS BIGINT) AS h FROM photons)""",
    ),
    "good": ("spacecraft", "SELECT * FROM spacecraft WHERE data_qual > 0 AND lat_config = 1"),
    "islands": (
        "good",
        """SELECT start_s, stop_s, CAST(sum(CASE WHEN upto IS NULL OR start_s > upto THEN 1 ELSE 0 END) OVER (ORDER BY start_s, stop_s) AS BIGINT) AS island
      FROM (SELECT *, max(stop_s) OVER (ORDER BY start_s, stop_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM good)""",
    ),
    "gti": ("islands", "SELECT min(start_s) AS start_s, max(stop_s) AS stop_s FROM islands GROUP BY island"),
    "good_photons": ("photons gti", "SELECT * FROM photons p WHERE energy_mev BETWEEN 1000 AND 10000 AND zenith_deg <= 90 AND EXISTS (SELECT 1 FROM gti g WHERE p.time_s >= g.start_s AND p.time_s < g.stop_s)"),
    "counts": ("good_photons", _cube("good_photons", "CAST(floor((lat_deg + 90)/10) AS INT)", "CAST(floor(lon_deg/10) AS INT)", 18, 36, 1)),
    "exposure": ("", "SELECT 0 AS plane, CAST(p//36 AS INT) AS iy, CAST(p%36 AS INT) AS ix, CASE WHEN p%13=0 THEN 0e0 ELSE 1e3+p%50 END AS exposure FROM range(648) t(p)"),
    "template": ("", "SELECT CAST(p//36 AS INT) AS iy, CAST(p%36 AS INT) AS ix, 1e0+(p*97%1000)/1e3 AS value FROM range(648) t(p)"),
    "pixels": (
        "counts exposure",
        """SELECT e.*, coalesce(counts, 0) AS counts, CASE WHEN exposure > 0 THEN coalesce(counts, 0)/exposure ELSE 0e0 END AS intensity, exposure > 0 AS valid,
      -90.0 + 180.0*e.iy/17 AS lat_deg, exposure > 0 AND abs(-90.0 + 180.0*e.iy/17) >= 10 AS fit FROM exposure e LEFT JOIN counts c USING (plane, iy, ix)""",
    ),
    "sums": (
        "pixels template",
        f"SELECT sum(w) AS s0, sum(w*t) AS s1, sum(w*t*t) AS s2, sum(w*intensity) AS d0, sum(w*t*intensity) AS d1, count(*) AS n FROM (SELECT *, {_WEIGHT} AS w, value AS t FROM pixels JOIN template USING (iy, ix) WHERE fit)",
    ),
    "coefficients": ("sums", "SELECT (s2*d0 - s1*d1)/(s0*s2 - s1*s1) AS a0, (s0*d1 - s1*d0)/(s0*s2 - s1*s1) AS a1, n FROM sums"),
    "removed": ("coefficients", "SELECT p.*, a1*value AS model, intensity - a1*value AS residual FROM pixels p JOIN template USING (iy, ix), coefficients"),
    "scores": (
        "removed",
        """SELECT sqrt(avg(intensity*intensity)) AS rms_before, sqrt(avg(residual*residual)) AS rms_after, avg(abs(intensity)) AS mean_before, avg(abs(residual)) AS mean_after,
      median(abs(intensity)) AS median_before, median(abs(residual)) AS median_after, count(*) FILTER (WHERE abs(residual) < abs(intensity)) AS n_improved, count(*) AS n_pixels FROM removed WHERE fit""",
    ),
    "changes": (
        "scores",
        """SELECT *, CASE WHEN rms_after < rms_before THEN 'improves' ELSE 'worsens' END AS verdict, 100*(rms_before - rms_after)/nullif(rms_before, 0) AS rms_change,
      100*(mean_before - mean_after)/nullif(mean_before, 0) AS mean_change, 100*(median_before - median_after)/nullif(median_before, 0) AS median_change, 100.0*n_improved/n_pixels AS percent_improved FROM scores""",
    ),
    "sky": (
        "photons",
        f"SELECT r.p AS ipix, coalesce(value, 1.0) AS value FROM range({_NPIX}) r(p) LEFT JOIN (SELECT event_id*97 % {_NPIX} AS ipix, 1 + avg(energy_mev)/1000 AS value FROM photons GROUP BY 1) m ON m.ipix = r.p",
    ),
    "directions": (
        "",
        """SELECT *, cos(radians(b_deg))*cos(radians(l_deg)) AS px, cos(radians(b_deg))*sin(radians(l_deg)) AS py, sin(radians(b_deg)) AS pz
      FROM (SELECT CAST(p//36 AS INT) AS iy, CAST(p%36 AS INT) AS ix, (p%36)*10 - 175.0 AS l_deg, (p//36)*10 - 85.0 AS b_deg FROM range(648) t(p))""",
    ),
    "clipped": (
        "spacecraft gti",
        """SELECT s.* REPLACE (livetime_s*(least(s.stop_s, g.stop_s) - greatest(s.start_s, g.start_s))/(s.stop_s - s.start_s) AS livetime_s)
      FROM spacecraft s JOIN gti g ON g.stop_s > s.start_s AND g.start_s < s.stop_s""",
    ),
    "paired": (
        "clipped directions",
        """SELECT iy, ix, l_deg, b_deg, zen_lon_deg, zen_lat_deg, livetime_s, cos(radians(z_lat_deg))*cos(radians(z_lon_deg))*px + cos(radians(z_lat_deg))*sin(radians(z_lon_deg))*py + sin(radians(z_lat_deg))*pz AS costheta
      FROM clipped, directions""",
    ),
    "livetime": ("paired", "SELECT iy, ix, CAST(least(floor(costheta/0.025), 39) AS INT) AS cbin, sum(livetime_s) AS livetime_s FROM paired WHERE costheta >= 0 GROUP BY ALL"),
    "livetime_zenith": (
        "paired",
        f"SELECT iy, ix, CAST(least(floor(costheta/0.025), 39) AS INT) AS cbin, sum(livetime_s) AS livetime_s FROM paired WHERE costheta >= 0 AND {_sep('zen_lon_deg', 'zen_lat_deg', 'l_deg', 'b_deg')} <= 105 GROUP BY ALL",
    ),
    "area": (
        "",
        """SELECT CAST(p//120 AS INT) AS plane, CAST(p%40 AS INT) AS cbin, CAST(sum(1000 + p//120*100 + p%40*7 + ((p//40)%3 + 1)*3) AS DOUBLE) AS area
      FROM range(240) t(p) WHERE (((p//40)%3 + 1) & 3) <> 0 GROUP BY ALL""",
    ),
    "exposed": ("livetime area", "SELECT plane, iy, ix, sum(livetime_s*area) AS exposure FROM livetime JOIN area USING (cbin) GROUP BY ALL"),
    "exposed_zenith": ("livetime_zenith area", "SELECT plane, iy, ix, sum(livetime_s*area) AS exposure FROM livetime_zenith JOIN area USING (cbin) GROUP BY ALL"),
    "centers": ("", f"SELECT iy, ix, {_LON5} AS lon_deg, {_LAT5} AS lat_deg FROM (SELECT CAST(p//72 AS INT) AS iy, CAST(p%72 AS INT) AS ix FROM range(2592) t(p)) WHERE {_ON5}"),
    "fine": ("centers", "SELECT iy, ix, CAST(least(floor((lat_deg + 90)/10), 17) AS INT) AS cy, CAST(floor((lon_deg + 180)/10) AS INT) % 36 AS cx FROM centers"),
    "refined": ("fine exposed", "SELECT plane, f.iy, f.ix, exposure FROM fine f JOIN exposed e ON e.iy = f.cy AND e.ix = f.cx"),
    "refined_zenith": ("fine exposed_zenith", "SELECT plane, f.iy, f.ix, exposure FROM fine f JOIN exposed_zenith e ON e.iy = f.cy AND e.ix = f.cx"),
    "angles": ("photons", f"SELECT event_id, radians(90.0 - lat_deg) AS theta, CASE WHEN radians(lon_deg) < 0 THEN radians(lon_deg) + {2 * math.pi!r} ELSE radians(lon_deg) END AS phi FROM photons"),
    "near_photons": ("angles", "\n" + _neighbours("angles", "event_id")),
    "grid_angles": (
        "",
        f"SELECT k, radians(90.0 - (-90.0 + 180.0*(k//37)/18)) AS theta, CASE WHEN l < 0 THEN radians(l) + {2 * math.pi!r} ELSE radians(l) END AS phi FROM (SELECT p AS k, -180.0 + 360.0*(p%37)/36 AS l FROM range(703) t(p))",
    ),
    "near_grid": ("grid_angles", "\n" + _neighbours("grid_angles", "k")),
    "center_angles": ("centers", f"SELECT iy*72 + ix AS k, radians(90.0 - lat_deg) AS theta, CASE WHEN lon_deg < 0 THEN radians(lon_deg) + {2 * math.pi!r} ELSE radians(lon_deg) END AS phi FROM centers"),
    "near_centers": ("center_angles", "\n" + _neighbours("center_angles", "k")),
    "sky_places": (
        "sky",
        f"""SELECT ipix, value, CASE WHEN ipix < {_CAP} THEN (pl + 0.5)*90.0/ri WHEN ipix >= {_NPIX - _CAP} THEN 360.0 - (pl + 0.5)*90.0/ri ELSE (pl + CASE WHEN (ri - {NSIDE}) % 2 = 0 THEN 0.5 ELSE 0.0 END)*90.0/{NSIDE} END AS lon,
      degrees(asin(CASE WHEN ipix < {_CAP} THEN 1.0 - ri*ri/{3.0 * NSIDE * NSIDE} WHEN ipix >= {_NPIX - _CAP} THEN -(1.0 - ri*ri/{3.0 * NSIDE * NSIDE}) ELSE {4.0 / 3!r} - 2*ri/{3.0 * NSIDE} END)) AS lat
      FROM (SELECT *, CASE WHEN polar THEN spot - 2*ri*(ri - 1) ELSE spot % {4 * NSIDE} END AS pl FROM (
        SELECT *, CASE WHEN polar THEN CAST(floor((1 + sqrt(1 + 2*spot))/2) AS BIGINT) ELSE spot // {4 * NSIDE} + {NSIDE} END AS ri FROM (
          SELECT *, ipix < {_CAP} OR ipix >= {_NPIX - _CAP} AS polar, CASE WHEN ipix < {_CAP} THEN ipix WHEN ipix >= {_NPIX - _CAP} THEN {_NPIX - 1} - ipix ELSE ipix - {_CAP} END AS spot FROM sky)))""",
    ),
    "sky_pairs": (
        "sky_places",
        f"SELECT a.ipix, b.ipix AS other, {_sep('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS distance, b.value FROM sky_places a, sky_places b",
    ),
}


def _text(body: str) -> str:
    """``body`` under a WITH clause of all the expressions that it names."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in _CTE[name][0].split():
                need(other)
            if name not in order:
                order.append(name)

    for name in _CTE:
        if re.search(rf"\b{name}\b", re.sub(r"'[^']*'", "", body.split("--")[0])) and re.search(rf"(FROM|JOIN|,)\s+{name}\b", body):
            need(name)
    parts = [_CTE[n][1].strip() if _CTE[n][1].startswith("\n") else f"{n} AS (\n      {_CTE[n][1]})" for n in order]
    return "WITH " + ",\n  ".join(parts) + "\n" + body if parts else body


_BEFORE_AFTER = "SELECT round({0}_before, 9) AS before, round({0}_after, 9) AS after FROM scores"
_STATUS = """SELECT source_file, count(*) AS n_read, count(*) FILTER (WHERE energy_mev BETWEEN 1000 AND 10000) AS n_selected,
  count(*) FILTER (WHERE event_id IN (SELECT event_id FROM good_photons)) AS n_good,
  CASE WHEN count(*) FILTER (WHERE event_id IN (SELECT event_id FROM good_photons)) = 0 THEN 'empty' ELSE 'ok' END AS status FROM photons GROUP BY source_file"""
_LON2, _LAT2, _ON2 = _center("iy", "ix", 2.0, 180, 90)

ORACLE_SQL = {
    name: _text(body)
    for name, body in {
        "scan_files": "SELECT 'events.parquet' AS file_name, count(*) AS n_rows FROM events",
        "ingest_events": "SELECT * FROM photons",
        "scan_spacecraft": "SELECT * FROM spacecraft",
        "pointing_files": "SELECT * FROM spacecraft",
        "pointing_faults": """SELECT start_s, stop_s, CASE WHEN start_s > upto THEN 'gap' ELSE 'overlap' END AS fault, CASE WHEN start_s > upto THEN start_s - upto ELSE least(upto, stop_s) - start_s END AS seconds
          FROM (SELECT start_s, stop_s, max(stop_s) OVER (ORDER BY start_s, stop_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
          FROM (SELECT start_s, CASE WHEN start_s%7=1 THEN stop_s + 1800 ELSE stop_s END AS stop_s FROM spacecraft)) WHERE start_s <> upto""",
        "scan_plane": f"SELECT * FROM ({_cube('photons', *_AIT2, 90, 180, 4)}) WHERE plane = 1",
        "write_map": "SELECT * FROM counts",
        "event_mask": "SELECT event_id FROM photons WHERE (event_class & 6) <> 0 AND (event_type & 2) <> 0",
        "cone": f"SELECT event_id FROM photons WHERE {_sep('ra_deg', 'dec_deg', '120.0', '-30.0')} <= 40",
        "time_range": "SELECT event_id FROM photons WHERE time_s BETWEEN 259200 AND 1728000",
        "energy_range": "SELECT event_id FROM photons WHERE energy_mev BETWEEN 1000 AND 10000",
        "zenith_max": "SELECT event_id FROM photons WHERE zenith_deg <= 90",
        "select_events": f"""SELECT event_id, energy_mev, source_file FROM photons WHERE (event_class & 255) <> 0 AND (event_type & 3) <> 0 AND time_s >= 86400
          AND energy_mev BETWEEN 1000 AND 10000 AND zenith_deg <= 90 AND {_sep("ra_deg", "dec_deg", "120.0", "-30.0")} <= 90""",
        "quality_rows": "SELECT start_s, stop_s, livetime_s FROM good",
        "with_valid": "SELECT iy, ix, counts, valid FROM pixels",
        "with_fit_mask": "SELECT iy, ix, round(lat_deg, 6) AS lat_deg, valid, fit FROM pixels",
        "fit_pixels": "SELECT count(*) FILTER (WHERE fit) AS n_fit, count(*) AS n_total FROM pixels",
        "blank_invalid": "SELECT iy, ix, CASE WHEN valid THEN round(intensity, 9) END AS intensity FROM pixels",
        "filter_good_time": "SELECT event_id, source_file FROM good_photons",
        "intensity": "SELECT plane, iy, ix, counts, round(intensity, 9) AS intensity FROM pixels",
        "stored_maps": "SELECT plane, iy, ix, counts, round(intensity, 9) AS intensity FROM pixels",
        "ratio_map": "SELECT iy, ix, round(CASE WHEN exposure <> 0 THEN counts/exposure ELSE 0 END, 9) AS value FROM pixels",
        "attach_template": "SELECT iy, ix, counts, round(value, 6) AS template FROM pixels JOIN template USING (iy, ix)",
        "pair_livetime": "SELECT iy, ix, round(sum(livetime_s), 2) AS livetime_s, round(sum(livetime_s*costheta), 2) AS weighted FROM paired WHERE costheta >= 0 GROUP BY ALL",
        "pair_response": "SELECT plane, cbin, count(*) AS n, max(area) AS area, round(sum(livetime_s), 2) AS livetime_s FROM livetime JOIN area USING (cbin) GROUP BY ALL",
        "interpolate": "SELECT CAST(k//37 AS INT) AS iy, CAST(k%37 AS INT) AS ix, round(sum(w*value), 6) AS value FROM near JOIN sky USING (ipix) /* FROM near_grid */ GROUP BY k",
        "neighbour_pairs": "SELECT ipix, other, round(distance, 6) AS distance, round(value, 6) AS value FROM sky_pairs WHERE distance <= 12",
        "missing_files": "SELECT DISTINCT source_file FROM photons WHERE source_file NOT IN (SELECT source_file FROM good_photons WHERE time_s BETWEEN 0 AND 1000000)",
        "refine": "SELECT plane, iy, ix, round(exposure, 1) AS exposure FROM refined",
        "make_gti": "SELECT * FROM gti",
        "interval_islands": "SELECT * FROM islands",
        "counts_cube": _cube("good_photons", *_AIT2, 90, 180, 3),
        "counts_plate_carree": _cube("photons", *_CAR, 19, 37, 1),
        "merge_sum": _cube("photons", *_AIT2, 90, 180, 1),
        "merge_append": "SELECT event_id, source_file FROM photons WHERE event_id % 2 = 0 UNION ALL SELECT event_id, source_file FROM photons WHERE event_id % 3 = 0",
        "merge_custom": "SELECT event_type, max(energy_mev) AS most, count(*) AS n FROM photons GROUP BY 1",
        "livetime_cube": "SELECT iy, ix, cbin, round(livetime_s, 4) AS livetime_s FROM livetime_zenith",
        "exposure_cube": "SELECT plane, iy, ix, round(exposure, 1) AS exposure FROM exposed",
        "merge_livetime": "SELECT iy, ix, cbin, round(livetime_s, 4) AS livetime_s FROM livetime",
        "fit_template": "SELECT round(a0, 9) AS a0, round(a1, 9) AS a1, n AS n_fit FROM coefficients",
        "rms": _BEFORE_AFTER.format("rms"),
        "mean_abs": _BEFORE_AFTER.format("mean"),
        "median_abs": _BEFORE_AFTER.format("median"),
        "improved": "SELECT n_improved, n_pixels FROM scores",
        "percent_change": "SELECT verdict, round(rms_change, 4) AS rms_change, round(mean_change, 4) AS mean_change, round(median_change, 4) AS median_change, round(percent_improved, 4) AS percent_improved FROM changes",
        "file_status": _STATUS,
        "reported_status": """SELECT source_file, count(*) AS n_read, count(*) FILTER (WHERE cut) AS n_selected, count(*) FILTER (WHERE cut AND early) AS n_good,
          CASE WHEN count(*) FILTER (WHERE cut AND early) = 0 THEN 'empty' ELSE 'ok' END AS status
          FROM (SELECT *, energy_mev BETWEEN 1000 AND 10000 AND zenith_deg <= 90 AS cut, EXISTS (SELECT 1 FROM gti g WHERE g.start_s < 1500000 AND p.time_s >= g.start_s AND p.time_s < g.stop_s) AS early FROM photons p)
          GROUP BY source_file UNION ALL SELECT 'broken', 0, 0, 0, 'failed'""",
        "gate": """SELECT count(*) AS n_files, count(*) FILTER (WHERE first > 1500000) AS n_failed, round(count(*) FILTER (WHERE first > 1500000)/count(*), 6) AS share
          FROM (SELECT source_file, min(time_s) AS first FROM photons GROUP BY 1)""",
        "sky_functions": f"""SELECT event_id, CASE WHEN lon_deg > 180 THEN lon_deg - 360 ELSE lon_deg END AS lon, round(radians(90.0 - lat_deg), 9) AS theta, round(radians(lon_deg), 9) AS phi,
          {_bin(100, 50000, 8)} AS bin, {_CAR[0]} AS cy, {_CAR[1]} AS cx, {_AIT2[0]} AS ay, {_AIT2[1]} AS ax, round({_sep("lon_deg", "lat_deg", "ra_deg", "dec_deg")}, 6) AS apart,
          round(exp(-zenith_deg*zenith_deg/(2*pow(60.0/sqrt(8*ln(2.0)), 2))), 9) AS beam, CASE WHEN zenith_deg <> 0 THEN round(energy_mev/zenith_deg, 6) END AS ratio, source_file AS stem FROM photons""",
        "aitoff_round_trip": f"SELECT event_id, CASE WHEN {_ON2} THEN round({_LON2}, 6) END AS lon, CASE WHEN {_ON2} THEN round({_LAT2}, 6) END AS lat FROM (SELECT event_id, {_AIT2[0]} AS iy, {_AIT2[1]} AS ix FROM photons)",
        "inclusive_grid": f"SELECT iy, ix, -90.0 + 180.0*iy/18 AS lat_deg, -180.0 + 360.0*ix/36 AS lon_deg, counts FROM ({_cube('photons', *_CAR, 19, 37, 1)})",
        "hp_neighbours": "SELECT event_id, round(sum(w), 6) AS total, round(sum(w*ipix), 4) AS mean FROM near /* FROM near_photons */ GROUP BY 1",
        "counts_map": _cube("good_photons", *_AIT2, 90, 180, 1),
        "exposure_map": "SELECT plane, iy, ix, round(exposure, 1) AS exposure FROM refined_zenith",
        "corrected_map": f"SELECT plane, iy, ix, CASE WHEN exposure <> 0 THEN round(coalesce(counts, 0)/exposure*1e6, 4) END AS value FROM refined_zenith LEFT JOIN ({_cube('good_photons', *_AIT5, 36, 72, 2)}) USING (plane, iy, ix)",
        "resample": "SELECT CAST(k//72 AS INT) AS iy, CAST(k%72 AS INT) AS ix, round(sum(w*value), 6) AS value FROM near JOIN sky USING (ipix) /* FROM near_centers */ GROUP BY k",
        "smooth": f"""SELECT ipix, round(sum(w*value)/sum(w), 6) AS value FROM (SELECT *, exp(-distance*distance/{2 * (8.0 / math.sqrt(8 * math.log(2))) ** 2!r}) AS w
          FROM sky_pairs WHERE distance <= {5 * 8.0 / math.sqrt(8 * math.log(2))!r}) GROUP BY 1""",
        "remove_foreground": "SELECT iy, ix, round(intensity, 9) AS intensity, round(model, 9) AS model, round(residual, 9) AS residual, valid, fit FROM removed",
        "assess": "SELECT verdict, n_improved, n_pixels, "
        + ", ".join(f"round({c}_{k}, 9) AS {c}_{k}" for c in ("rms", "mean", "median") for k in ("before", "after"))
        + ", "
        + ", ".join(f"round({c}_change, 4) AS {c}_change" for c in ("rms", "mean", "median"))
        + " FROM changes",
    }.items()
}
