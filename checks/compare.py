"""Differences, overlays and correlations."""

from __future__ import annotations

import graticule as g
from checks.common import OTHER, grid, other, rounded, rs, with_grid
from checks.select import AXES

P1, P2 = ("1995-01-01", "1998-06-30"), ("1998-06-30", "2002-01-01")


def _v(s, d):
    return grid(s, d).select("time", "lat", "lon", "v")


def _w(s, d):
    return grid(s, d).select("time", "lat", "lon", "w")


QUERIES = {
    "j1_diff_periods": lambda s, d: rounded(
        g.diff_periods(grid(s, d), "v", P1, P2, target=400), "v_1", "v_2", "difference"
    ),
    "j1_difference_limit": lambda s, d: rounded(
        g.difference_limit(g.diff_periods(grid(s, d), "v", P1, P2, target=400)), "max_abs_difference"
    ),
    "j1_diff_halves": lambda s, d: rounded(g.diff_periods(grid(s, d), "v", target=400), "v_1", "v_2", "difference"),
    "j2_diff_levels": lambda s, d: rounded(
        g.diff_levels(grid(s, d), "v", 1.0, 7.0, target=400), "v_1", "v_2", "difference"
    ),
    "j3_cross_variable": lambda s, d: rounded(g.cross_variable(_v(s, d), _w(s, d)), "correlation", d=8),
    "j3_cross_variable_one_frame": lambda s, d: rounded(
        g.cross_variable(grid(s, d).drop("level"), var_a="v", var_b="w"), "correlation", d=8
    ),
    "j4_overlay": lambda s, d: rounded(g.overlay(grid(s, d), "v", "w", target=400), "fill", "contour"),
    "j4_overlay_two_frames": lambda s, d: rounded(
        g.overlay(_v(s, d), "v", "w", _w(s, d), target=400), "fill", "contour"
    ),
    "j5_compare_grids": lambda s, d: rounded(
        g.compare_grids(grid(s, d), other(s, d), "v", target=400, b_lat="latitude", b_lon="longitude"),
        "v_primary", "v_compare", "difference",
    ),
    "j6_correlation_map": lambda s, d: rounded(
        g.correlation_map(g.resample(_v(s, d), "time", "MS", "mean", ["lat", "lon"]), "v", 10.0, -100.0, target=400),
        "correlation", d=6,
    ),
    "j6_correlation_map_full": lambda s, d: rounded(
        g.correlation_map(g.resample(_v(s, d), "time", "MS", "mean", ["lat", "lon"]), "v", 10.0, -100.0, target=None),
        "correlation", d=6,
    ),
}


def _difference(c1: str, c2: str) -> str:
    return f"""
        , a AS (SELECT lat, lon, AVG(v) AS v FROM binned WHERE {c1} GROUP BY lat, lon),
        b AS (SELECT lat, lon, AVG(v) AS v FROM binned WHERE {c2} GROUP BY lat, lon)
        SELECT lat, lon, {rs('a.v')} AS v_1, {rs('b.v')} AS v_2, {rs('b.v - a.v')} AS difference
        FROM a JOIN b USING (lat, lon)
        """


def _period(p: tuple[str, str]) -> str:
    return f"time BETWEEN TIMESTAMP '{p[0]}' AND TIMESTAMP '{p[1]}'"


def _correlation(lat: str, lon: str) -> str:
    return with_grid(
        f"""
        , raw AS (SELECT lat, lon, CAST(date_trunc('month', time) AS TIMESTAMP) AS time, AVG(v) AS v
                  FROM grid GROUP BY 1, 2, 3),
        spine AS (SELECT lat, lon, UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL 1 MONTH)) AS time
                  FROM raw GROUP BY 1, 2),
        s AS (SELECT lat, lon, time, v FROM spine LEFT JOIN raw USING (lat, lon, time)),
        cell AS (SELECT lat AS y, lon AS x FROM (SELECT DISTINCT lat, lon FROM s)
                 ORDER BY ABS(lat - 10.0) + ABS(lon + 100.0), lat, lon LIMIT 1),
        ref AS (SELECT time, AVG(v) AS ref FROM s, cell WHERE lat = y AND lon = x GROUP BY time),
        m AS (SELECT time, {lat} AS lat, {lon} AS lon, AVG(v) AS v FROM s, widths GROUP BY 1, 2, 3),
        st AS (SELECT lat, lon, COVAR_SAMP(v, ref) AS c,
                      STDDEV_SAMP(CASE WHEN ref IS NOT NULL THEN v END) AS sv,
                      STDDEV_SAMP(CASE WHEN v IS NOT NULL THEN ref END) AS sr
               FROM m LEFT JOIN ref USING (time) WHERE v IS NOT NULL GROUP BY lat, lon)
        SELECT lat, lon, {rs('c / NULLIF(sv * sr, 0)', 6)} AS correlation FROM st
        """,
        AXES,
    )


ORACLE = {
    "j1_diff_periods": with_grid(_difference(_period(P1), _period(P2)), AXES),
    "j1_difference_limit": (
        "SELECT "
        + rs("MAX(ABS(y - x))")
        + " AS max_abs_difference FROM ("
        + with_grid(
            f"""
            SELECT lat, lon, AVG(v) FILTER (WHERE {_period(P1)}) AS x, AVG(v) FILTER (WHERE {_period(P2)}) AS y
            FROM binned GROUP BY lat, lon
            """,
            AXES,
        )
        + ")"
    ),
    "j2_diff_levels": with_grid(_difference("level = 1", "level = 7"), AXES),
    "j3_cross_variable": with_grid(
        f"""
        SELECT 'time,lat,lon' AS shared_coords, COUNT(*) AS points, {rs('CORR(a.v, b.w)', 8)} AS correlation
        FROM grid a JOIN grid b USING (time, lat, lon)
        """
    ),
    "j4_overlay": with_grid(
        f"SELECT lat, lon, {rs('AVG(v)')} AS fill, {rs('AVG(w)')} AS contour FROM binned GROUP BY lat, lon", AXES
    ),
    "j5_compare_grids": with_grid(
        f"""
        , p AS (SELECT lat, lon, AVG(v) AS v FROM binned GROUP BY lat, lon),
        c AS (SELECT FLOOR(latitude / blat) * blat AS lat, FLOOR(longitude / blon) * blon AS lon, AVG(v) AS v
              FROM other, widths GROUP BY 1, 2)
        SELECT lat, lon, {rs('p.v')} AS v_primary, {rs('c.v')} AS v_compare, {rs('c.v - p.v')} AS difference
        FROM p JOIN c USING (lat, lon)
        """,
        AXES,
        OTHER,
    ),
    "j6_correlation_map": _correlation("FLOOR(lat / blat) * blat", "FLOOR(lon / blon) * blon"),
    "j6_correlation_map_full": _correlation("lat", "lon"),
}
_MIDDLE = "(SELECT CAST(MIN(time) + (MAX(time) - MIN(time)) / 2 AS DATE) FROM grid)"
ORACLE["j1_diff_halves"] = with_grid(_difference(f"time <= {_MIDDLE}", f"time >= {_MIDDLE}"), AXES)
ORACLE["j3_cross_variable_one_frame"] = ORACLE["j3_cross_variable"]
ORACLE["j4_overlay_two_frames"] = ORACLE["j4_overlay"]
