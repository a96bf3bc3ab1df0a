"""SQL over variable views, compositions and plain SQL categories."""

from __future__ import annotations

from functools import partial

import graticule as g
from checks.common import DIMS, SERIES, grid, rounded, rs, with_grid
from checks.temporal import bucket_sql


def _grid(s, d):
    return g.Grid(grid(s, d), DIMS)


def _defined(s, d):
    data = _grid(s, d)
    data.define("zonal_mean", "SELECT lat, AVG(v) AS m FROM v GROUP BY lat")
    return rounded(data.sql('SELECT "lat", m FROM zonal_mean WHERE m > (SELECT AVG(m) FROM zonal_mean)'), "m")


def _plain(query, *names):
    def run(s, d):
        out = _grid(s, d).sql(query)
        return rounded(out, *names) if names else out

    return run


_CHAIN = [
    partial(g.dim_slice, dim="lat", start=-30, stop=60),
    partial(g.reduce_dims, dims=["level", "lat", "lon"], value_columns=["v"]),
    partial(g.resample, freq="MS", values=["v"]),
    partial(g.anomaly, var="v", groupby="month"),
]

# SQL kinds users may pass through; the same text runs in both engines
PASS_THROUGH = {
    "left_join": "SELECT a.lat, COUNT(*) AS n FROM v a LEFT JOIN (SELECT DISTINCT lat FROM w WHERE w > 0.09) b"
    " ON a.lat = b.lat GROUP BY a.lat",
    "semi_join": "SELECT COUNT(*) AS n FROM v WHERE lon IN (SELECT lon FROM w WHERE w = 0.05 AND lat > 80)",
    "anti_join": "SELECT COUNT(*) AS n FROM v a WHERE NOT EXISTS"
    " (SELECT 1 FROM w b WHERE b.time = a.time AND b.lat = a.lat AND b.w > 0.08)",
    "rollup": "SELECT lat, level, COUNT(*) AS n, MAX(v) AS m FROM v GROUP BY ROLLUP (lat, level)",
    "cube": "SELECT lon, level, COUNT(v) AS n FROM v GROUP BY CUBE (lon, level)",
    "grouping_sets": "SELECT lat, lon, COUNT(v) AS n FROM v GROUP BY GROUPING SETS ((lat), (lon), ())",
    "window_rank": "SELECT lat, lon, n, CAST(RANK() OVER (PARTITION BY lat ORDER BY n DESC) AS BIGINT) AS place FROM"
    " (SELECT lat, lon, COUNT(v) AS n FROM v GROUP BY lat, lon)",
    "window_lag": "SELECT time, n, LAG(n) OVER (PARTITION BY EXTRACT(YEAR FROM time) ORDER BY time) AS before"
    " FROM (SELECT time, COUNT(v) AS n FROM v GROUP BY time)",
    "set_operations": "SELECT lat FROM v WHERE lat > 0 UNION SELECT lat FROM v WHERE lat < -80"
    " EXCEPT SELECT lat FROM v WHERE lat > 70",
    "cte": "WITH c AS (SELECT lat, COUNT(v) AS n FROM v GROUP BY lat) SELECT lat, n FROM c"
    " WHERE n >= (SELECT AVG(n) FROM c)",
    "extremes": "SELECT lat, lon, MAX(v) AS top FROM v WHERE level = 2 GROUP BY lat, lon ORDER BY top DESC, lat, lon LIMIT 12",
    "zones": "SELECT CASE WHEN lon < 0 THEN 'west' ELSE 'east' END AS side, level,"
    " COUNT(DISTINCT lat) AS rings, MAX(v) - MIN(v) AS width FROM v GROUP BY side, level",
    "months": "SELECT CAST(EXTRACT(MONTH FROM time) AS BIGINT) AS month, COUNT(*) - COUNT(v) AS gaps FROM v GROUP BY 1",
    "descriptive": "SELECT COUNT(DISTINCT time) AS steps, COUNT(DISTINCT lat) * COUNT(DISTINCT lon) AS cells FROM v",
}


def _as_duckdb(text: str) -> str:
    return (
        with_grid("", "v AS (SELECT time, level, lat, lon, v FROM grid)", "w AS (SELECT time, level, lat, lon, w FROM grid)")
        + f" SELECT * FROM ({text})"
    )


QUERIES = {
    "q1_sql": _plain("SELECT lat, AVG(v) AS avg_v, COUNT(*) AS n FROM v WHERE lat > 40 GROUP BY lat", "avg_v"),
    "q2_sql_positional": lambda s, d: rounded(
        _grid(s, d).sql("SELECT lon, AVG(v) AS m FROM v WHERE lat >= ? AND level = ? GROUP BY lon", [10.0, 3.0]), "m"
    ),
    "q2_sql_named": lambda s, d: rounded(
        _grid(s, d).sql("SELECT lon, AVG(w) AS m FROM w WHERE lat < :top GROUP BY lon", {"top": -20.0}), "m"
    ),
    "q3_table": lambda s, d: _grid(s, d).table('"V"'),
    "q4_define": _defined,
    "q4_define_two_grids": lambda s, d: _two_grids(s, d),
    "q5_cached": lambda s, d: rounded(_cached(s, d), "v"),
    "q6_preview": lambda s, d: g.preview(grid(s, d), 1000, ["time", "level", "lat", "lon", "v", "w"]),
    "q7_get_with_transforms": lambda s, d: _grid(s, d)
    .get("v", lat=slice(0, 50))
    .transform(g.top_k, "v", 25, True, ["time", "level", "lat", "lon"]),
    "q8_chained_transforms": lambda s, d: rounded(
        g.chain(_grid(s, d).table("v"), _CHAIN), "v", "v_anomaly", d=3
    ),
    # returns data values near the percentile: no exact counterpart
    "sql_approx_percentile": _plain(
        "SELECT lat, APPROX_PERCENTILE_CONT(v, 0.1) AS p10, APPROX_PERCENTILE_CONT(v, 0.5) AS median FROM v GROUP BY lat"
    ),
    "m6_table_metadata": lambda s, d: g.table_metadata(_described(s, d)),
    "s6_register": lambda s, d: _grid(s, d).register().spark.sql("SELECT COUNT(*) AS n, COUNT(w) AS m FROM w"),
}
QUERIES |= {f"sql_{name}": _plain(text) for name, text in PASS_THROUGH.items()}


def _two_grids(s, d):
    """The same name defined by two datasets."""
    parts = {"all": _grid(s, d), "south": g.Grid(grid(s, d).filter("lat < -50"), DIMS)}
    for data in parts.values():
        data.define("top", "SELECT MAX(v) AS top FROM v")
    south, every = (parts[p].table("top").selectExpr(f"'{p}' AS part", "top") for p in ("south", "all"))
    return every.unionByName(south)


def _described(s, d):
    df = grid(s, d).withMetadata("v", {"units": "K", "long_name": "Value"})
    return df.withMetadata("lat", {"units": "degrees_north"})


def _cached(s, d):
    data = _grid(s, d)
    data.cached(g.time_series(data.table("v"), "v"))
    return data.cached(g.time_series(data.table("v"), "v"))


def _meta_row(i, name, dtype, role, units="NULL", description="NULL"):
    if role is None:
        about = "CAST(NULL AS VARCHAR) AS role, CAST(NULL AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS min, CAST(NULL AS VARCHAR) AS max"
    else:
        about = f"'{role}' AS role, COUNT(DISTINCT {name}) AS size, CAST(MIN({name}) AS VARCHAR) AS min, CAST(MAX({name}) AS VARCHAR) AS max"
    return (
        f"SELECT CAST({i} AS INT) AS position, '{name}' AS \"column\", '{dtype}' AS data_type,"
        f" {'TRUE' if role else 'FALSE'} AS is_coordinate, CAST({units} AS VARCHAR) AS units,"
        f" CAST({description} AS VARCHAR) AS description, {about} FROM grid{'' if role else ' LIMIT 1'}"
    )


_META = " UNION ALL ".join(
    f"({x})"
    for x in (
        _meta_row(0, "time", "timestamp_ntz", "time"),
        _meta_row(1, "level", "double", "vertical"),
        _meta_row(2, "lat", "double", "latitude", "'degrees_north'"),
        _meta_row(3, "lon", "double", "longitude"),
        _meta_row(4, "v", "double", None, "'K'", "'Value'"),
        _meta_row(5, "w", "double", None),
    )
)

ORACLE = {
    "q4_define_two_grids": with_grid(
        "SELECT 'all' AS part, MAX(v) AS top FROM grid UNION ALL SELECT 'south' AS part, MAX(v) AS top FROM grid WHERE lat < -50"
    ),
    "m6_table_metadata": with_grid(_META),
    "q1_sql": with_grid(
        f"SELECT lat, {rs('AVG(v)')} AS avg_v, COUNT(*) AS n FROM grid WHERE lat > 40 GROUP BY lat"
    ),
    "q2_sql_positional": with_grid(
        f"SELECT lon, {rs('AVG(v)')} AS m FROM grid WHERE lat >= 10 AND level = 3 GROUP BY lon"
    ),
    "q2_sql_named": with_grid(f"SELECT lon, {rs('AVG(w)')} AS m FROM grid WHERE lat < -20 GROUP BY lon"),
    "q3_table": with_grid("SELECT time, level, lat, lon, v FROM grid"),
    "q4_define": with_grid(
        f"""
        , z AS (SELECT lat, AVG(v) AS m FROM grid GROUP BY lat)
        SELECT lat, {rs('m')} AS m FROM z WHERE m > (SELECT AVG(m) FROM z)
        """
    ),
    "q5_cached": with_grid(f"SELECT time, {rs('v')} AS v FROM series", SERIES),
    "q6_preview": with_grid(
        """
        SELECT *, (SELECT COUNT(*) FROM grid) AS total_rows FROM grid
        ORDER BY time, level, lat, lon, v NULLS FIRST, w LIMIT 1000
        """
    ),
    "q7_get_with_transforms": with_grid(
        """
        SELECT time, level, lat, lon, v FROM grid WHERE lat BETWEEN 0 AND 50
        ORDER BY v DESC NULLS LAST, time, level, lat, lon LIMIT 25
        """
    ),
    "q8_chained_transforms": with_grid(
        f"""
        , s AS (SELECT time, AVG(v) AS v FROM grid WHERE lat BETWEEN -30 AND 60 GROUP BY time),
        b AS (SELECT {bucket_sql('time', 'MS')} AS time, AVG(v) AS v FROM s GROUP BY 1),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL 1 MONTH)) AS time FROM b)
        SELECT spine.time, {rs('v', 3)} AS v,
               {rs('v - AVG(v) OVER (PARTITION BY EXTRACT(MONTH FROM spine.time))', 3)} AS v_anomaly
        FROM spine LEFT JOIN b ON b.time = spine.time
        """
    ),
    "s6_register": "SELECT COUNT(*) AS n, COUNT(l_discount) AS m FROM lineitem",
}
ORACLE |= {f"sql_{name}": _as_duckdb(text) for name, text in PASS_THROUGH.items()}
