"""Filters and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import DIMS, grid, r, rs, table, with_grid

QUERIES = {
    "s3_select_variables": lambda s, d: g.select_variables(grid(s, d), ["w"]),
    "s5_drop_missing": lambda s, d: g.drop_missing(grid(s, d), "v"),
    "f1_get_scalar": lambda s, d: g.get(grid(s, d), lat=12.5, __limit=3),
    "f1_get_list": lambda s, d: g.get(grid(s, d), lat=[-12.5, 12.5, 1.0], level=[1, 2]),
    "f1_get_slice": lambda s, d: g.get(grid(s, d), time=slice("1996-01-01", "1997-06-30"), lon=slice(0, None)),
    "f1_get_empty_list": lambda s, d: g.get(grid(s, d), lat=[]),
    "f2_dim_slice_time": lambda s, d: g.dim_slice(grid(s, d), "time", "1996-03-01", "1996-03-31"),
    "f2_dim_slice_number": lambda s, d: g.dim_slice(grid(s, d), "lat", start=-22.5, stop=40),
    "f2_dim_slice_absent": lambda s, d: g.dim_slice(grid(s, d), "depth", start=1, stop=2),
    "f3_dim_slice_values": lambda s, d: g.dim_slice(grid(s, d), "lon", values=[2.5, 7.5, 400.0]),
    # 10.0 lies exactly between 7.5 and 12.5, 95.0 outside the axis
    "f4_dim_slice_nearest": lambda s, d: g.dim_slice(grid(s, d), "lat", values=[10.0, 95.0, -41.0], nearest=True),
    "f5_bbox": lambda s, d: g.bbox(grid(s, d), lat_min=-30, lat_max=45.0, lon_min=100),
    "f6_sel": lambda s, d: g.sel(g.Grid(grid(s, d), DIMS), lat=-62.5, level=3.0),
    "f7_isel": lambda s, d: g.isel(g.Grid(grid(s, d), DIMS), time=-1, level=0),
    "f7_isel_axes_table": lambda s, d: g.isel(_with_axes(s, d), time=slice(0, 100, 7), lat=-2),
    "f8_time_steps": lambda s, d: g.time_steps(grid(s, d), 200),
    "f8_time_steps_all": lambda s, d: g.time_steps(grid(s, d)),
    "f9_frame_at": lambda s, d: g.frame_at(grid(s, d), "1997-05-05", "v", target=400).withColumn("v", r("v")),
    "f10_nearest_cell": lambda s, d: g.nearest_cell(grid(s, d), 10.0, -100.0),
    "f11_filter_ranges": lambda s, d: g.filter_ranges(
        grid(s, d),
        {"time": ("1996-01-01", "1998-12-31"), "lat": (-45, 45), "lon": (-90, 90), "level": (2, 5)},
    ),
    "f12_top_k": lambda s, d: g.top_k(
        g.get(grid(s, d), v=slice(None, 2000.0)), "v", 10, desc=False, ties=["time", "lat", "lon", "level", "w"]
    ),
    "f12_hottest_cells": lambda s, d: g.top_k(
        grid(s, d).groupBy("lat", "lon").agg(F.avg("v").alias("v")), "v", 5, ties=["lat", "lon"]
    ).withColumn("v", r("v")),
    "f13_sample_n": lambda s, d: g.sample_n(table(s, d, "events"), 50, ["event_id"], seed=7),
    "f14_convert_units": lambda s, d: _celsius(grid(s, d)),
}


def _celsius(df):
    out = g.convert_units(df.withMetadata("v", {"units": "K"}), "v")
    return out.select("time", "level", "lat", "lon", r("v").alias("v"))



def _with_axes(s, d):
    return g.Grid(grid(s, d), DIMS, axes=g.axes_table(grid(s, d), DIMS))


AXES = """
axes AS (
  SELECT COUNT(DISTINCT lat) AS nlat, MIN(lat) AS lat0, MAX(lat) AS lat1,
         COUNT(DISTINCT lon) AS nlon, MIN(lon) AS lon0, MAX(lon) AS lon1 FROM grid),
ratio AS (SELECT *, SQRT(CAST(nlat * nlon AS DOUBLE) / 400.0) AS q FROM axes),
widths AS (
  SELECT CASE WHEN nlat * nlon > 400 THEN (lat1 - lat0) / GREATEST(10.0, FLOOR(nlat / q)) END AS blat,
         CASE WHEN nlat * nlon > 400 THEN (lon1 - lon0) / GREATEST(10.0, FLOOR(nlon / q)) END AS blon
  FROM ratio),
binned AS (
  SELECT time, level, v, w, lat AS lat_raw, lon AS lon_raw,
         FLOOR(lat / blat) * blat AS lat, FLOOR(lon / blon) * blon AS lon
  FROM grid, widths)
"""


ORACLE = {
    "s3_select_variables": with_grid("SELECT time, level, lat, lon, w FROM grid"),
    "s5_drop_missing": with_grid("SELECT * FROM grid WHERE v IS NOT NULL"),
    "f1_get_scalar": with_grid("SELECT * FROM grid WHERE lat = 12.5"),
    "f1_get_list": with_grid("SELECT * FROM grid WHERE lat IN (-12.5, 12.5, 1.0) AND level IN (1, 2)"),
    "f1_get_slice": with_grid(
        "SELECT * FROM grid WHERE time >= TIMESTAMP '1996-01-01' AND time <= TIMESTAMP '1997-06-30' AND lon >= 0"
    ),
    "f1_get_empty_list": with_grid("SELECT * FROM grid WHERE FALSE"),
    "f2_dim_slice_time": with_grid(
        "SELECT * FROM grid WHERE time BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-31'"
    ),
    "f2_dim_slice_number": with_grid("SELECT * FROM grid WHERE lat BETWEEN -22.5 AND 40"),
    "f2_dim_slice_absent": with_grid("SELECT * FROM grid"),
    "f3_dim_slice_values": with_grid("SELECT * FROM grid WHERE lon IN (2.5, 7.5, 400.0)"),
    "f4_dim_slice_nearest": with_grid(
        """
        SELECT * FROM grid WHERE lat IN (
          SELECT (SELECT lat FROM grid ORDER BY ABS(lat - x), lat LIMIT 1)
          FROM (VALUES (10.0), (95.0), (-41.0)) t(x))
        """
    ),
    "f5_bbox": with_grid("SELECT * FROM grid WHERE lat >= -30 AND lat <= 45 AND lon >= 100"),
    "f6_sel": with_grid("SELECT time, lon, v, w FROM grid WHERE lat = -62.5 AND level = 3"),
    "f7_isel": with_grid(
        "SELECT lat, lon, v, w FROM grid WHERE time = (SELECT MAX(time) FROM grid)"
        " AND level = (SELECT MIN(level) FROM grid)"
    ),
    "f7_isel_axes_table": with_grid(
        """
        , t AS (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM grid))
        SELECT time, level, lon, v, w FROM grid WHERE time IN (SELECT time FROM t WHERE i < 100 AND i % 7 = 0)
          AND lat = (SELECT lat FROM (SELECT DISTINCT lat FROM grid) ORDER BY lat DESC OFFSET 1 LIMIT 1)
        """
    ),
    "f8_time_steps": with_grid("SELECT DISTINCT time FROM grid ORDER BY time LIMIT 200"),
    "f8_time_steps_all": with_grid("SELECT DISTINCT time FROM grid ORDER BY time"),
    "f9_frame_at": with_grid(
        f"SELECT lat, lon, {rs('AVG(v)')} AS v FROM binned WHERE time = TIMESTAMP '1997-05-05' GROUP BY lat, lon",
        AXES,
    ),
    "f10_nearest_cell": with_grid(
        """
        SELECT lat, lon, ABS(lat - 10.0) + ABS(lon + 100.0) AS distance
        FROM (SELECT DISTINCT lat, lon FROM grid) ORDER BY distance, lat, lon LIMIT 1
        """
    ),
    "f11_filter_ranges": with_grid(
        """
        SELECT * FROM grid WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
          AND lat BETWEEN -45 AND 45 AND lon BETWEEN -90 AND 90 AND level BETWEEN 2 AND 5
        """
    ),
    "f12_top_k": with_grid("SELECT * FROM grid WHERE v <= 2000 ORDER BY v, time, lat, lon, level, w LIMIT 10"),
    "f12_hottest_cells": with_grid(
        f"SELECT lat, lon, {rs('m')} AS v FROM (SELECT lat, lon, AVG(v) AS m FROM grid GROUP BY lat, lon)"
        " ORDER BY m DESC NULLS LAST, lat, lon LIMIT 5"
    ),
    "f13_sample_n": "SELECT * FROM events ORDER BY md5('7|' || event_id), event_id LIMIT 50",
    "f14_convert_units": with_grid(f"SELECT time, level, lat, lon, {rs('v - 273.15')} AS v FROM grid"),
}


def _narrow(s, d):
    """The grid with 32-bit latitudes such as 0.1, which no double equals."""
    return table(s, d, "lineitem").select(
        (F.col("l_suppkey") % 36 / 10.0).cast("float").alias("lat"),
        F.col("l_partkey").cast("float").alias("lon"),
        F.col("l_extendedprice").alias("v"),
    )


_NARROW = """
    WITH n AS (SELECT CAST((l_suppkey % 36) / 10.0 AS FLOAT) AS lat, CAST(l_partkey AS FLOAT) AS lon, l_extendedprice AS v FROM lineitem)
    SELECT * FROM n WHERE """
QUERIES |= {
    "f1_get_float32": lambda s, d: g.get(_narrow(s, d), lat=1.1),
    "f2_dim_slice_float32": lambda s, d: g.dim_slice(_narrow(s, d), "lat", start=0.3, stop=0.7),
    "f3_values_float32": lambda s, d: g.dim_slice(_narrow(s, d), "lat", values=[0.1, 2.3]),
    "f6_sel_float32": lambda s, d: g.sel(g.Grid(_narrow(s, d), ["lat", "lon"]), lat=0.7),
}
ORACLE |= {
    "f1_get_float32": _NARROW + "lat = CAST(1.1 AS FLOAT)",
    "f2_dim_slice_float32": _NARROW + "lat BETWEEN CAST(0.3 AS FLOAT) AND CAST(0.7 AS FLOAT)",
    "f3_values_float32": _NARROW + "lat IN (CAST(0.1 AS FLOAT), CAST(2.3 AS FLOAT))",
    "f6_sel_float32": (_NARROW + "lat = CAST(0.7 AS FLOAT)").replace("SELECT * FROM n", "SELECT lon, v FROM n"),
}
