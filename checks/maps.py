"""Binned maps, gradients and transects."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import grid, r, rounded, rs, table, with_grid
from checks.select import AXES

START, END = (-60.0, -120.0), (62.0, 131.0)


def _mean_map(s, d):
    return grid(s, d).groupBy("lat", "lon").agg(F.avg("v").alias("v"))


def _lines(s, d):
    """One line per nation, some of them leaving the grid."""
    n = F.col("n_nationkey").cast("double")
    return table(s, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("line"),
        (n * 6.0 - 70.0).alias("lat0"), (n * 13.0 - 165.0).alias("lon0"),
        (65.0 - n * 5.0).alias("lat1"), (n * 15.0 - 175.0).alias("lon1"),
    )


QUERIES = {
    "b1_bin_expr": lambda s, d: _bins(s, d),
    "b2_map_mean": lambda s, d: rounded(g.map_mean(grid(s, d), "v", target=400), "v"),
    "b2_map_mean_auto": lambda s, d: rounded(g.map_mean(grid(s, d), "v"), "v"),
    "b3_hovmoller_lat": lambda s, d: rounded(g.hovmoller(grid(s, d), "v", "lat", target=400), "v"),
    "b3_hovmoller_lon": lambda s, d: rounded(g.hovmoller(grid(s, d), "v", "lon", target=400), "v"),
    "b4_cross_section_lat_level": lambda s, d: rounded(
        g.cross_section(grid(s, d), "v", "lat_level", target=400), "v"
    ),
    "b4_cross_section_time_level": lambda s, d: rounded(g.cross_section(grid(s, d), "v", "time_level"), "v"),
    "b5_map_any_dims": lambda s, d: rounded(
        g.map_mean(grid(s, d), "v", target=None, x="level", y="lat"), "v"
    ),
    "s7_to_matrix": lambda s, d: _matrix(s, d),
    "s7_to_matrix_arrays": lambda s, d: g.to_matrix(grid(s, d), "lat", "lon", "v").select(
        "lat", F.posexplode("cells").alias("pos", "cell")
    ).select("lat", F.col("pos").cast("bigint").alias("pos"), F.col("cell.label").alias("lon"), r("cell.value").alias("v")),
    "g1_gradient": lambda s, d: rounded(
        g.gradient(_mean_map(s, d), "v", dims=["lat", "lon"]), "v", "v_grad_lat", "v_grad_lon"
    ),
    "g1_gradient_levels": lambda s, d: rounded(
        g.gradient(grid(s, d).groupBy("level", "lat", "lon").agg(F.avg("v").alias("v")), "v"),
        "v", "v_grad_lat", "v_grad_lon",
    ),
    "g2_transect": lambda s, d: rounded(
        g.transect(grid(s, d), "v", START, END, 50), "distance_deg", "v"
    ),
    # the axes count as too long to travel here: the joining path
    "g2_transect_long_axes": lambda s, d: rounded(
        g.transect(grid(s, d), "v", START, END, 50, max_axis=10), "distance_deg", "v"
    ),
    "g3_transect_lines": lambda s, d: rounded(
        g.transect(grid(s, d), "v", n=40, lines=_lines(s, d)), "distance_deg", "v"
    ),
}


def _bins(s, d):
    df = grid(s, d)
    bins = g.Binning(df, target=400)
    return df.select(bins.key("lat"), bins.key("lon")).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))


def _matrix(s, d):
    out = g.to_matrix(grid(s, d), "lat", "level", "v", values=[float(i) for i in range(1, 8)])
    return out.select("lat", *[r(F.col(f"`{i}.0`")).alias(f"level_{i}") for i in range(1, 8)])


def _gradient_sql(keys: str, extra: str) -> str:
    def slope(axis: str, w: str) -> str:
        hm, hp = f"({axis} - LAG({axis}) OVER {w})", f"(LEAD({axis}) OVER {w} - {axis})"
        vm, vp = f"LAG(v) OVER {w}", f"LEAD(v) OVER {w}"
        return (
            f"CASE WHEN LAG({axis}) OVER {w} IS NULL THEN ({vp} - v) / {hp}"
            f" WHEN LEAD({axis}) OVER {w} IS NULL THEN (v - {vm}) / {hm}"
            f" ELSE ({hm} * {hm} * {vp} + ({hp} * {hp} - {hm} * {hm}) * v - {hp} * {hp} * {vm})"
            f" / ({hm} * {hp} * ({hm} + {hp})) END"
        )

    return with_grid(
        f"""
        , m AS (SELECT {keys}, AVG(v) AS v FROM grid GROUP BY {keys})
        SELECT {keys}, {rs('v')} AS v, {rs(slope('lat', 'wy'))} AS v_grad_lat,
               {rs(slope('lon', 'wx'))} AS v_grad_lon
        FROM m WINDOW wy AS (PARTITION BY {extra} lon ORDER BY lat), wx AS (PARTITION BY {extra} lat ORDER BY lon)
        """
    )


def _transect_sql(lines: str, n: int, keys: str) -> str:
    return with_grid(
        f"""
        , m AS (SELECT lat, lon, AVG(v) AS v FROM grid GROUP BY lat, lon),
        ys AS (SELECT lat AS lo, LEAD(lat) OVER (ORDER BY lat) AS hi FROM (SELECT DISTINCT lat FROM m)),
        xs AS (SELECT lon AS lo, LEAD(lon) OVER (ORDER BY lon) AS hi FROM (SELECT DISTINCT lon FROM m)),
        lines AS ({lines}),
        pts AS (
          SELECT line, k AS point, lat0 + k / {n - 1}.0 * (lat1 - lat0) AS y, lon0 + k / {n - 1}.0 * (lon1 - lon0) AS x,
                 lat0, lon0
          FROM lines, (SELECT UNNEST(RANGE({n})) AS k)),
        cells AS (
          SELECT p.*, ys.lo AS y0, ys.hi AS y1, xs.lo AS x0, xs.hi AS x1 FROM pts p
          LEFT JOIN ys ON p.y >= ys.lo AND (p.y < ys.hi OR (p.y = ys.hi AND ys.hi = (SELECT MAX(lat) FROM m)))
          LEFT JOIN xs ON p.x >= xs.lo AND (p.x < xs.hi OR (p.x = xs.hi AND xs.hi = (SELECT MAX(lon) FROM m)))),
        f AS (SELECT *, (y - y0) / (y1 - y0) AS fy, (x - x0) / (x1 - x0) AS fx FROM cells)
        SELECT {keys}, CAST(point AS BIGINT) AS point,
               {rs('SQRT(POW(y - lat0, 2) + POW(x - lon0, 2))')} AS distance_deg,
               {rs('a.v * (1 - fy) * (1 - fx) + b.v * (1 - fy) * fx + c.v * fy * (1 - fx) + e.v * fy * fx')} AS v
        FROM f LEFT JOIN m a ON a.lat = y0 AND a.lon = x0 LEFT JOIN m b ON b.lat = y0 AND b.lon = x1
               LEFT JOIN m c ON c.lat = y1 AND c.lon = x0 LEFT JOIN m e ON e.lat = y1 AND e.lon = x1
        """
    ).replace("SELECT , CAST", "SELECT CAST")


ORACLE = {
    "b1_bin_expr": with_grid("SELECT lat, lon, COUNT(*) AS n FROM binned GROUP BY lat, lon", AXES),
    "b2_map_mean": with_grid(f"SELECT lat, lon, {rs('AVG(v)')} AS v FROM binned GROUP BY lat, lon", AXES),
    "b2_map_mean_auto": with_grid(f"SELECT lat, lon, {rs('AVG(v)')} AS v FROM grid GROUP BY lat, lon"),
    "b3_hovmoller_lat": with_grid(f"SELECT time, lat, {rs('AVG(v)')} AS v FROM binned GROUP BY time, lat", AXES),
    "b3_hovmoller_lon": with_grid(f"SELECT time, lon, {rs('AVG(v)')} AS v FROM binned GROUP BY time, lon", AXES),
    "b4_cross_section_lat_level": with_grid(
        f"SELECT lat, level, {rs('AVG(v)')} AS v FROM binned GROUP BY lat, level", AXES
    ),
    "b4_cross_section_time_level": with_grid(
        f"SELECT time, level, {rs('AVG(v)')} AS v FROM grid GROUP BY time, level"
    ),
    "b5_map_any_dims": with_grid(f"SELECT lat, level, {rs('AVG(v)')} AS v FROM grid GROUP BY lat, level"),
    "s7_to_matrix": with_grid(
        "SELECT lat, "
        + ", ".join(f"{rs(f'AVG(v) FILTER (WHERE level = {i})')} AS level_{i}" for i in range(1, 8))
        + " FROM grid GROUP BY lat"
    ),
    "s7_to_matrix_arrays": with_grid(
        f"SELECT lat, ROW_NUMBER() OVER (PARTITION BY lat ORDER BY lon) - 1 AS pos, lon, {rs('AVG(v)')} AS v"
        " FROM grid GROUP BY lat, lon"
    ),
    "g1_gradient": _gradient_sql("lat, lon", ""),
    "g1_gradient_levels": _gradient_sql("level, lat, lon", "level,"),
    "g2_transect": _transect_sql(
        f"SELECT 0 AS line, {START[0]} AS lat0, {START[1]} AS lon0, {END[0]} AS lat1, {END[1]} AS lon1", 50, ""
    ),
    "g3_transect_lines": _transect_sql(
        "SELECT CAST(n_nationkey AS BIGINT) AS line, n_nationkey * 6.0 - 70.0 AS lat0, n_nationkey * 13.0 - 165.0 AS lon0,"
        " 65.0 - n_nationkey * 5.0 AS lat1, n_nationkey * 15.0 - 175.0 AS lon1 FROM nation", 40, "line"
    ),
}
ORACLE["g2_transect_long_axes"] = ORACLE["g2_transect"]
