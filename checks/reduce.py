"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import DIMS, OTHER, grid, other, r, rounded, rs, table, with_grid
from graticule.operators.reduction import REGIONS

METHODS = ("mean", "sum", "std", "min", "max", "median", "count")


def _sql(method: str, c: str, ddof: int = 1) -> str:
    return {
        "mean": f"AVG({c})",
        "sum": f"COALESCE(SUM({c}), 0)",
        "std": f"STDDEV_SAMP({c})" if ddof else f"STDDEV_POP({c})",
        "var": f"VAR_SAMP({c})" if ddof else f"VAR_POP({c})",
        "min": f"MIN({c})",
        "max": f"MAX({c})",
        "median": f"QUANTILE_CONT({c}, 0.5)",
        "count": f"COUNT({c})",
    }[method]


def _reduced(method):
    def query(s, d):
        out = g.reduce_dims(grid(s, d), ["time", "level"], method, ["v", "w"])
        return out if method == "count" else rounded(out, "v", "w")

    return query


def _reduced_sql(method):
    v, w = _sql(method, "v"), _sql(method, "w")
    if method != "count":
        v, w = rs(v), rs(w)
    return with_grid(f"SELECT lat, lon, {v} AS v, {w} AS w FROM grid GROUP BY lat, lon")


QUERIES = {f"a1_reduce_dims_{m}": _reduced(m) for m in METHODS}
ORACLE = {f"a1_reduce_dims_{m}": _reduced_sql(m) for m in METHODS}

QUERIES |= {
    "a1_reduce_dims_auto": lambda s, d: rounded(g.reduce_dims(grid(s, d), ["lat", "lon"]), "v", "w"),
    "a1_reduce_dims_all": lambda s, d: rounded(
        g.reduce_dims(grid(s, d), ["time", "level", "lat", "lon"]), "v", "w"
    ),
    "a2_grid_reduce_std": lambda s, d: rounded(g.Grid(grid(s, d), DIMS).reduce("v", ["time", "level"], "std"), "v"),
    "a2_grid_reduce_var": lambda s, d: rounded(
        g.Grid(grid(s, d), DIMS).reduce("w", ["time", "lat", "lon"], "var"), "w", d=6
    ),
    "a3_profile_zonal": lambda s, d: rounded(g.profile(grid(s, d), "v", "lat"), "v"),
    "a3_profile_meridional": lambda s, d: rounded(g.profile(grid(s, d), "v", "lon"), "v"),
    "a3_profile_vertical": lambda s, d: rounded(g.profile(grid(s, d), "v", "level"), "v"),
    "a4_summary": lambda s, d: rounded(g.summary(grid(s, d), ["v", "w"]), "mean", "std"),
    "a5_region_stats": lambda s, d: rounded(g.region_stats(grid(s, d), "v"), "mean", "std"),
    "a5_region_stats_custom": lambda s, d: rounded(
        g.region_stats(
            grid(s, d), "v", {"box": (-20, 33, 10, 100.5), "nowhere": (200, 210, 0, 1), "rest": (0, 90, -180, 0)}
        ),
        "mean", "std",
    ),
    "a6_coverage": lambda s, d: rounded(g.coverage(grid(s, d), "v"), "coverage_pct", d=6),
    "a6_overall_coverage": lambda s, d: rounded(g.overall_coverage(grid(s, d), "v"), "coverage_pct", d=6),
    "a7_zone_stats": lambda s, d: rounded(g.zone_stats(grid(s, d), "v"), "mean"),
    "a8_contrast": lambda s, d: rounded(
        g.contrast(grid(s, d), "v", "lon", F.col("lat") >= 50, F.col("lat") <= 30),
        "mean_a", "mean_b", "difference",
    ),
    "a9_percentiles_by": lambda s, d: rounded(
        g.percentiles(grid(s, d), "v", (0.1, 0.5, 0.9), ["lat"]), "v_p10", "v_p50", "v_p90", "v_spread"
    ),
    "a9_percentiles_global": lambda s, d: rounded(
        g.percentiles(grid(s, d), "v", (0.1, 0.5, 0.9)), "v_p10", "v_p50", "v_p90", "v_spread"
    ),
    # every group counts as too large for one task here: the narrowing path
    "a9_percentiles_large_groups": lambda s, d: rounded(
        g.percentiles(grid(s, d), "v", (0.1, 0.5, 0.9), ["level"], max_group_rows=500),
        "v_p10", "v_p50", "v_p90", "v_spread",
    ),
    "a9_percentiles_approx": lambda s, d: g.percentiles(grid(s, d), "v", (0.1, 0.5, 0.9), ["lat"], approx=True),
    "a10_histogram": lambda s, d: rounded(g.histogram(grid(s, d), "v"), "bin_start", "bin_end"),
    "a11_kde": lambda s, d: g.kde(grid(s, d), "v").select(
        "point", r("x").alias("x"), r(F.col("density") * 1e6, 6).alias("density_e6")
    ),
    "a11_kde_skewed": lambda s, d: g.kde(grid(s, d).withColumn("v", F.pow(F.col("v") / 1000.0, F.lit(4.0))), "v", 60).select(
        "point", r("x", 2).alias("x"), r(F.col("density") * 1e9, 4).alias("density_e9")
    ),
    "a12_calendar_month": lambda s, d: rounded(g.calendar_stats(grid(s, d), "v", "month"), "mean"),
    "a12_calendar_season": lambda s, d: rounded(g.calendar_stats(grid(s, d), "v", "season"), "mean"),
    "a12_calendar_hour": lambda s, d: rounded(
        g.calendar_stats(table(s, d, "events"), "value", "hour", time="ts"), "mean"
    ),
    "a13_time_series": lambda s, d: rounded(g.time_series(grid(s, d), "v"), "v"),
    "a14_compare_means": lambda s, d: rounded(
        g.compare_means(grid(s, d), other(s, d)), "primary_mean", "compare_mean", "difference"
    ),
    "m1_schema_profile": lambda s, d: g.schema_profile(grid(s, d)),
    "m1_schema_enums": lambda s, d: g.schema_enums(table(s, d, "lineitem")),
    "m2_dimension_profile": lambda s, d: g.dimension_profile(grid(s, d), DIMS),
    "m2_axes_table": lambda s, d: g.axes_table(grid(s, d), DIMS),
    "m3_column_report": lambda s, d: g.column_report(table(s, d, "lineitem")).drop("dtype"),
    "m4_estimate_size": lambda s, d: g.estimate_size(grid(s, d)),
}

_FIVE = (
    "COUNT(v) AS count, {m} AS mean, {s} AS std, CAST(MIN(v) AS DOUBLE) AS min, CAST(MAX(v) AS DOUBLE) AS max"
).format(m=rs("AVG(v)"), s=rs("STDDEV_SAMP(v)"))
_PCT = ", ".join(
    [f"{rs(f'QUANTILE_CONT(v, {p / 100})')} AS v_p{p}" for p in (10, 50, 90)]
    + [f"{rs('QUANTILE_CONT(v, 0.9) - QUANTILE_CONT(v, 0.1)')} AS v_spread"]
)
_THREE = f"{rs('AVG(v)')} AS mean, MIN(v) AS min, MAX(v) AS max"


def _profile(dim: str) -> str:
    return with_grid(
        f"SELECT {dim}, {rs('AVG(v)')} AS v, MIN(v) AS v_min, MAX(v) AS v_max FROM grid GROUP BY {dim}"
    )


def _regions(boxes) -> str:
    return with_grid(
        " UNION ALL ".join(
            f"SELECT '{name}' AS region, {_FIVE} FROM grid"
            f" WHERE lat BETWEEN {a} AND {b} AND lon BETWEEN {c} AND {e}"
            for name, (a, b, c, e) in boxes.items()
        )
    )


_DIM_TYPES = {"time": "time", "level": "vertical", "lat": "latitude", "lon": "longitude"}


def _dimension(d: str) -> str:
    if d == "time":
        return (
            "SELECT 'time' AS dim, 'datetime' AS kind, 'time' AS role, 'timestamp_ntz' AS dtype,"
            " COUNT(DISTINCT time) AS size, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,"
            " MIN(time) AS min_time, MAX(time) AS max_time, CAST(NULL AS DOUBLE) AS step FROM grid"
        )
    return (
        f"SELECT '{d}', 'numeric', '{_DIM_TYPES[d]}', 'double', COUNT(DISTINCT {d}), MIN({d}), MAX({d}),"
        f" CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP),"
        f" (SELECT MIN({d}) FROM grid WHERE {d} > (SELECT MIN({d}) FROM grid)) - MIN({d}) FROM grid"
    )


def _schema_row(c: str) -> str:
    if c == "time":
        return (
            "SELECT 'time' AS \"column\", 'datetime' AS type, COUNT(*) AS rows, CAST(NULL AS DOUBLE) AS min,"
            " CAST(NULL AS DOUBLE) AS max, MIN(time) AS min_time, MAX(time) AS max_time FROM grid"
        )
    return (
        f"SELECT '{c}', 'number', COUNT(*), MIN({c}), MAX({c}), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)"
        " FROM grid"
    )


_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate"
).split()

def _axis(d: str) -> str:
    number = "CAST(NULL AS DOUBLE)" if d == "time" else d
    moment = d if d == "time" else "CAST(NULL AS TIMESTAMP)"
    return (
        f"SELECT '{d}' AS dim, CAST(ROW_NUMBER() OVER (ORDER BY {d}) - 1 AS INT) AS idx, {number} AS coord_num,"
        f" {moment} AS coord_ts, CAST(NULL AS VARCHAR) AS coord_str FROM (SELECT DISTINCT {d} FROM grid)"
    )


ORACLE |= {
    "m2_axes_table": with_grid(" UNION ALL ".join(_axis(d) for d in DIMS)),
    "a1_reduce_dims_auto": with_grid(
        f"SELECT time, level, {rs('AVG(v)')} AS v, {rs('AVG(w)')} AS w FROM grid GROUP BY time, level"
    ),
    "a1_reduce_dims_all": with_grid(f"SELECT {rs('AVG(v)')} AS v, {rs('AVG(w)')} AS w FROM grid"),
    "a2_grid_reduce_std": with_grid(f"SELECT lat, lon, {rs('STDDEV_POP(v)')} AS v FROM grid GROUP BY lat, lon"),
    "a2_grid_reduce_var": with_grid(f"SELECT level, {rs('VAR_POP(w)', 6)} AS w FROM grid GROUP BY level"),
    "a3_profile_zonal": _profile("lat"),
    "a3_profile_meridional": _profile("lon"),
    "a3_profile_vertical": _profile("level"),
    "a4_summary": with_grid(
        f"SELECT 'v' AS variable, {_FIVE} FROM grid UNION ALL SELECT 'w', {_FIVE.replace('(v)', '(w)')} FROM grid"
    ),
    "a5_region_stats": _regions(REGIONS),
    "a5_region_stats_custom": _regions(
        {"box": (-20, 33, 10, 100.5), "nowhere": (200, 210, 0, 1), "rest": (0, 90, -180, 0)}
    ),
    "a6_coverage": with_grid(
        f"""
        SELECT lat, lon, COUNT(*) AS total, COUNT(v) AS valid,
               {rs('CAST(COUNT(v) AS DOUBLE) / COUNT(*) * 100.0', 6)} AS coverage_pct
        FROM grid GROUP BY lat, lon
        """
    ),
    "a6_overall_coverage": with_grid(
        f"""
        SELECT COUNT(*) AS total, COUNT(v) AS valid,
               {rs('CAST(COUNT(v) AS DOUBLE) * 100.0 / COUNT(*)', 6)} AS coverage_pct FROM grid
        """
    ),
    "a7_zone_stats": with_grid(
        f"""
        SELECT CASE WHEN lat >= 60 THEN 'Arctic (60-75N)' WHEN lat >= 40 THEN 'Mid-latitude (40-60N)'
                    WHEN lat >= 20 THEN 'Subtropical (20-40N)' ELSE 'Tropical (15-20N)' END AS zone,
               {_THREE}, COUNT(*) AS count
        FROM grid GROUP BY 1
        """
    ),
    "a8_contrast": with_grid(
        f"""
        SELECT lon, {rs('a')} AS mean_a, {rs('b')} AS mean_b, {rs('b - a')} AS difference FROM (
          SELECT lon, AVG(CASE WHEN lat >= 50 THEN v END) AS a, AVG(CASE WHEN lat <= 30 THEN v END) AS b
          FROM grid GROUP BY lon)
        """
    ),
    "a9_percentiles_by": with_grid(f"SELECT lat, {_PCT} FROM grid GROUP BY lat"),
    "a9_percentiles_global": with_grid(f"SELECT {_PCT} FROM grid"),
    "a9_percentiles_large_groups": with_grid(f"SELECT level, {_PCT} FROM grid GROUP BY level"),
    "a10_histogram": with_grid(
        f"""
        , ends AS (SELECT MIN(v) AS lo, (MAX(v) - MIN(v)) / 50.0 AS wd FROM grid),
        counts AS (
          SELECT LEAST(CAST(FLOOR((v - lo) / wd) AS BIGINT), 49) AS bin, COUNT(*) AS n
          FROM grid, ends WHERE v IS NOT NULL GROUP BY 1)
        SELECT CAST(b.bin AS BIGINT) AS bin, {rs('lo + b.bin * wd')} AS bin_start,
               {rs('lo + (b.bin + 1) * wd')} AS bin_end, COALESCE(n, 0) AS count
        FROM (SELECT UNNEST(RANGE(50)) AS bin) b CROSS JOIN ends LEFT JOIN counts USING (bin)
        """
    ),
    "a11_kde": with_grid(
        f"""
        , st AS (SELECT MIN(v) AS lo, MAX(v) AS hi, STDDEV_SAMP(v) * POW(COUNT(v), -0.2) AS h, COUNT(v) AS n FROM grid),
        pts AS (SELECT UNNEST(RANGE(100)) AS point),
        dens AS (
          SELECT point, lo + point * (hi - lo) / 99.0 AS x,
                 SUM(EXP(-0.5 * POW((lo + point * (hi - lo) / 99.0 - v) / h, 2))) / (MAX(n) * MAX(h) * SQRT(2 * PI())) AS density
          FROM pts, st, grid WHERE v IS NOT NULL GROUP BY point, lo, hi)
        SELECT CAST(point AS BIGINT) AS point, {rs('x')} AS x, {rs('density * 1e6', 6)} AS density_e6 FROM dens
        """
    ),
    "a11_kde_skewed": with_grid(
        f"""
        , sk AS (SELECT POW(v / 1000.0, 4) AS v FROM grid),
        st AS (SELECT MIN(v) AS lo, MAX(v) AS hi, STDDEV_SAMP(v) * POW(COUNT(v), -0.2) AS h, COUNT(v) AS n FROM sk),
        pts AS (SELECT UNNEST(RANGE(60)) AS point),
        dens AS (
          SELECT point, lo + point * (hi - lo) / 59.0 AS x,
                 SUM(EXP(-0.5 * POW((lo + point * (hi - lo) / 59.0 - v) / h, 2))) / (MAX(n) * MAX(h) * SQRT(2 * PI())) AS density
          FROM pts, st, sk WHERE v IS NOT NULL GROUP BY point, lo, hi)
        SELECT CAST(point AS BIGINT) AS point, {rs('x', 2)} AS x, {rs('density * 1e9', 4)} AS density_e9 FROM dens
        """
    ),
    "a12_calendar_month": with_grid(f"SELECT EXTRACT(MONTH FROM time) AS month, {_THREE} FROM grid GROUP BY 1"),
    "a12_calendar_season": with_grid(
        f"SELECT (EXTRACT(MONTH FROM time) % 12 + 3) // 3 AS season, {_THREE} FROM grid GROUP BY 1"
    ),
    "a12_calendar_hour": (
        f"SELECT EXTRACT(HOUR FROM ts) AS hour, {rs('AVG(value)')} AS mean, MIN(value) AS min, MAX(value) AS max"
        " FROM events GROUP BY 1"
    ),
    "a13_time_series": with_grid(f"SELECT time, {rs('AVG(v)')} AS v FROM grid GROUP BY time"),
    "a14_compare_means": with_grid(
        f"""
        SELECT 'v' AS variable, {rs('a')} AS primary_mean, {rs('b')} AS compare_mean, {rs('b - a')} AS difference
        FROM (SELECT AVG(v) AS a FROM grid), (SELECT AVG(v) AS b FROM other)
        """,
        OTHER,
    ),
    "m1_schema_profile": with_grid(" UNION ALL ".join(_schema_row(c) for c in ["time", *DIMS[1:], "v", "w"])),
    "m1_schema_enums": (
        "SELECT DISTINCT 'l_returnflag' AS \"column\", l_returnflag AS value FROM lineitem"
        " UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem"
    ),
    "m2_dimension_profile": with_grid(" UNION ALL ".join(_dimension(d) for d in DIMS)),
    "m3_column_report": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS total, COUNT({c}) AS non_null,"
        f" COUNT(DISTINCT {c}) AS unique_values FROM lineitem"
        for c in _LINEITEM
    ),
    "m4_estimate_size": (
        "SELECT COUNT(*) AS rows, CAST(6 AS BIGINT) AS columns, CAST(COUNT(*) * 48 AS BIGINT) AS estimated_bytes,"
        " ROUND(COUNT(*) * 48 / 1048576.0, 1) AS estimated_mb, COUNT(*) > 10000000 AS exceeds_warning FROM lineitem"
    ),
}
