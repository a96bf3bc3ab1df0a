"""Resampling, baselines, rolling windows, trends and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import SERIES, grid, r, rounded, rs, table, with_grid
from checks.reduce import _sql
from graticule.session import scratch_path
from graticule.streaming.resample import stream_resample

TRUNC = {"h": "hour", "D": "day", "MS": "month", "QS": "quarter", "YS": "year"}
STEP = {"h": "1 hour", "D": "1 day", "W": "7 days", "MS": "1 month", "QS": "3 months", "YS": "1 year"}


def bucket_sql(t: str, freq: str) -> str:
    if freq == "W":
        return f"CAST(date_trunc('week', {t}) + INTERVAL 6 DAYS AS TIMESTAMP)"
    return f"CAST(date_trunc('{TRUNC[freq]}', {t}) AS TIMESTAMP)"


def _series(s, d):
    return g.time_series(grid(s, d), "v")


def _daily(s, d):
    """One row per step and latitude."""
    return grid(s, d).groupBy("time", "lat").agg(F.avg("v").alias("v"))


def _resampled(freq, method):
    def query(s, d):
        out = g.resample(grid(s, d), "time", freq, method, values=["v", "w"])
        return out if method == "count" else rounded(out, "v", "w", d=3)

    return query


def _resampled_sql(freq, method):
    v, w = _sql(method, "v"), _sql(method, "w")
    if method in ("sum", "count"):
        outer = [f"COALESCE({c}, 0)" for c in ("v", "w")]
    else:
        outer = ["v", "w"]
    if method != "count":
        outer = [rs(c, 3) for c in outer]
    return with_grid(
        f"""
        , b AS (SELECT {bucket_sql('time', freq)} AS time, {v} AS v, {w} AS w FROM grid GROUP BY 1),
        spine AS (
          SELECT UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL {STEP[freq]})) AS time FROM b)
        SELECT spine.time, {outer[0]} AS v, {outer[1]} AS w FROM spine LEFT JOIN b ON b.time = spine.time
        """
    )


_RESAMPLES = [
    ("D", "mean"), ("W", "std"), ("MS", "mean"), ("MS", "median"), ("QS", "min"), ("YS", "max"),
    ("h", "sum"), ("h", "count"), ("W", "median"),
]
QUERIES = {f"t1_resample_{f.lower()}_{m}": _resampled(f, m) for f, m in _RESAMPLES}
ORACLE = {f"t1_resample_{f.lower()}_{m}": _resampled_sql(f, m) for f, m in _RESAMPLES}


def _grouped_resample(freq, method):
    def query(s, d):
        out = g.resample(table(s, d, "events"), "ts", freq, method, ["event_type", "user_id"], ["value"])
        return out if method == "count" else rounded(out, "value")

    return query


def _grouped_resample_sql(freq, method):
    value = "COALESCE(value, 0)" if method in ("sum", "count") else "value"
    value = value if method == "count" else rs(value)
    return f"""
        WITH b AS (SELECT event_type, user_id, {bucket_sql('ts', freq)} AS ts, {_sql(method, 'value')} AS value
                   FROM events GROUP BY 1, 2, 3),
        spine AS (
          SELECT event_type, user_id, UNNEST(GENERATE_SERIES(MIN(ts), MAX(ts), INTERVAL {STEP[freq]})) AS ts
          FROM b GROUP BY 1, 2)
        SELECT event_type, user_id, ts, {value} AS value FROM spine LEFT JOIN b USING (event_type, user_id, ts)
        """


for _f, _m in [("D", "mean"), ("W", "sum"), ("h", "count"), ("D", "median")]:
    QUERIES[f"t2_resample_groups_{_f.lower()}_{_m}"] = _grouped_resample(_f, _m)
    ORACLE[f"t2_resample_groups_{_f.lower()}_{_m}"] = _grouped_resample_sql(_f, _m)


def _cell_resample(freq, method):
    def query(s, d):
        cells = g.Grid(grid(s, d).select("time", "lat", "lon", "v"), ["time", "lat", "lon"])
        return rounded(cells.resample("v", freq, method), "v", d=1 if method == "var" else 4)

    return query


def _cell_resample_sql(freq, method):
    return with_grid(
        f"""
        , b AS (SELECT lat, lon, {bucket_sql('time', freq)} AS time, {_sql(method, 'v', 0)} AS v
                FROM grid GROUP BY 1, 2, 3),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL {STEP[freq]})) AS time FROM b),
        cells AS (SELECT DISTINCT lat, lon FROM grid)
        SELECT lat, lon, time, {rs('v', 1 if method == 'var' else 4)} AS v FROM cells CROSS JOIN spine LEFT JOIN b USING (lat, lon, time)
        """
    )


for _f, _m in [("MS", "std"), ("QS", "mean"), ("YS", "var")]:
    QUERIES[f"t3_grid_resample_{_f.lower()}_{_m}"] = _cell_resample(_f, _m)
    ORACLE[f"t3_grid_resample_{_f.lower()}_{_m}"] = _cell_resample_sql(_f, _m)

KEYS = {
    "month": "EXTRACT(MONTH FROM time)",
    "dayofyear": "EXTRACT(DOY FROM time)",
    "season": "((EXTRACT(MONTH FROM time) % 12 + 3) // 3)",
    "hour": "EXTRACT(HOUR FROM time)",
    "overall": "1",
}


def _baseline(op, unit, out):
    by = None if unit == "overall" else unit
    return lambda s, d: rounded(op(grid(s, d), "v", by), out)


for _unit, _key in KEYS.items():
    QUERIES[f"t4_anomaly_{_unit}"] = _baseline(g.anomaly, _unit, "v_anomaly")
    ORACLE[f"t4_anomaly_{_unit}"] = with_grid(
        f"SELECT *, {rs(f'v - AVG(v) OVER (PARTITION BY {_key})')} AS v_anomaly FROM grid"
    )
    if _unit in ("month", "season", "overall"):
        QUERIES[f"t5_climatology_{_unit}"] = _baseline(g.climatology, _unit, "v_climatology")
        ORACLE[f"t5_climatology_{_unit}"] = with_grid(
            f"SELECT *, {rs(f'AVG(v) OVER (PARTITION BY {_key})')} AS v_climatology FROM grid"
        )

_MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def _rolling(method, window, center, min_periods, **more):
    def query(s, d):
        out = g.rolling(_series(s, d), "v", window, method, center, min_periods, "time", **more)
        return out.select("time", r("v").alias("v"), r(f"v_rolling_{method}").alias("rolled"))

    return query


def _rolling_sql(method, window, center, min_periods):
    ahead = (window - 1) // 2 if center else 0
    frame = f"(ORDER BY time ROWS BETWEEN {window - 1 - ahead} PRECEDING AND {ahead} FOLLOWING)"
    value = "SUM(v)" if method == "sum" else _sql(method, "v")
    return with_grid(
        f"""
        SELECT time, {rs('v')} AS v,
               {rs(f'CASE WHEN COUNT(v) OVER {frame} >= {min_periods} THEN {value} OVER {frame} END')} AS rolled
        FROM series
        """,
        SERIES,
    )


_ROLLS = {
    "mean_7": ("mean", 7, False, 1),
    "sum_4_centred": ("sum", 4, True, 2),
    "std_7_centred": ("std", 7, True, 2),
    "min_30": ("min", 30, False, 5),
    "max_30": ("max", 30, False, 1),
    "median_7": ("median", 7, False, 2),
}
for _name, _args in _ROLLS.items():
    QUERIES[f"t7_rolling_{_name}"] = _rolling(*_args)
    ORACLE[f"t7_rolling_{_name}"] = _rolling_sql(*_args)
# the block form that series too long for one task take
QUERIES["t7_rolling_blocks_mean_7"] = _rolling("mean", 7, False, 1, max_group_rows=100)
ORACLE["t7_rolling_blocks_mean_7"] = ORACLE["t7_rolling_mean_7"]
QUERIES["t7_rolling_blocks_std_centred"] = _rolling("std", 7, True, 2, max_group_rows=64)
ORACLE["t7_rolling_blocks_std_centred"] = ORACLE["t7_rolling_std_7_centred"]


def _by_user(**more):
    def query(s, d):
        events = table(s, d, "events").select("event_id", "user_id", "ts", "value")
        out = g.rolling(events, "value", 5, order_by=["ts", "event_id"], partition_by=["user_id"], **more)
        return rounded(out, "value_rolling_mean")

    return query


QUERIES["t7_rolling_by_user"] = _by_user()
QUERIES["t7_rolling_by_user_blocks"] = _by_user(max_group_rows=50)
ORACLE["t7_rolling_by_user"] = ORACLE["t7_rolling_by_user_blocks"] = f"""
    SELECT event_id, user_id, ts, value,
           {rs('''AVG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)''')} AS value_rolling_mean
    FROM events
    """

_DAYS = "(EPOCH_US(time) / 86400000000.0)"


def _trend_sql(source: str, keys: str) -> str:
    return with_grid(
        f"""
        , s AS ({source}),
        fit AS (SELECT {keys} REGR_SLOPE(v, {_DAYS}) AS k, REGR_INTERCEPT(v, {_DAYS}) AS c FROM s {{group}})
        SELECT s.*, {rs(f'c + k * {_DAYS}', 3)} AS v_trend, {rs(f'v - (c + k * {_DAYS})', 3)} AS v_detrended
        FROM s {{join}}
        """
    )


def _poly_sql() -> str:
    """Degree 2 by the determinants of its normal equations, time scaled to -1..1."""
    p = [f"SUM(POW(u, {i}))" for i in range(5)]
    q = [f"SUM(POW(u, {i}) * v)" for i in range(3)]

    def det(m):
        (a, b, c), (d, e, f), (x, y, z) = m
        return f"({a} * ({e} * {z} - {f} * {y}) - {b} * ({d} * {z} - {f} * {x}) + {c} * ({d} * {y} - {e} * {x}))"

    names = [[f"p{i + j}" for j in range(3)] for i in range(3)]
    coefs = []
    for k in range(3):
        swapped = [[f"q{i}" if j == k else names[i][j] for j in range(3)] for i in range(3)]
        coefs.append(f"{det(swapped)} / {det(names)} AS c{k}")
    sums = ", ".join([f"{x} AS p{i}" for i, x in enumerate(p)] + [f"{x} AS q{i}" for i, x in enumerate(q)])
    return with_grid(
        f"""
        , ends AS (SELECT (MIN({_DAYS}) + MAX({_DAYS})) / 2 AS m, (MAX({_DAYS}) - MIN({_DAYS})) / 2 AS h
                   FROM series WHERE v IS NOT NULL),
        scaled AS (SELECT time, v, ({_DAYS} - m) / h AS u FROM series, ends),
        sums AS (SELECT {sums} FROM scaled WHERE v IS NOT NULL),
        fit AS (SELECT {', '.join(coefs)} FROM sums)
        SELECT time, {rs('v')} AS v, {rs('c0 + c1 * u + c2 * u * u', 3)} AS v_trend,
               {rs('v - (c0 + c1 * u + c2 * u * u)', 3)} AS v_detrended FROM scaled, fit
        """,
        SERIES,
    )


def _spectrum(out):
    return out.withColumn("power", r(F.log(F.col("power")), 5)).withColumn("period_days", r("period_days", 6)).withColumn(
        "frequency", r("frequency", 8)
    )


def _dft(source: str, keys: str) -> str:
    on = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    join = f"USING ({keys})" if keys else "ON TRUE"
    group = f"GROUP BY {keys}" if keys else ""
    return with_grid(
        f"""
        , s AS ({source}),
        dt AS (SELECT {lead} (LIST(EPOCH(time) ORDER BY time)[2] - LIST(EPOCH(time) ORDER BY time)[1]) / 86400.0 AS dt,
                      COUNT(*) AS steps FROM s {group}),
        x AS (SELECT {lead} ROW_NUMBER() OVER ({on} ORDER BY time) - 1 AS i, COUNT(*) OVER ({on}) AS n,
                     v - AVG(v) OVER ({on}) AS x FROM s WHERE v IS NOT NULL),
        k AS (SELECT {lead} n, UNNEST(RANGE(1, CAST(n // 2 + 1 AS BIGINT))) AS k FROM (SELECT DISTINCT {lead} n FROM x)),
        p AS (SELECT {lead} k.k, ANY_VALUE(x.n) AS n,
                     POW(SUM(x * COS(2 * PI() * ((k.k * i) % x.n) / x.n)), 2)
                     + POW(SUM(x * SIN(2 * PI() * ((k.k * i) % x.n) / x.n)), 2) AS power
              FROM k JOIN x {join} GROUP BY {lead} k.k)
        SELECT {lead} CAST(k AS BIGINT) AS k, k / CAST(n AS DOUBLE) AS frequency, dt * n / k AS period_days, power
        FROM p JOIN dt {join} WHERE steps >= 8
        """
    )


def _spectrum_sql(source: str, keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead} k, {rs('frequency', 8)} AS frequency, {rs('period_days', 6)} AS period_days,"
        f" {rs('LN(power)', 5)} AS power FROM ({_dft(source, keys)})"
    )


_BY_TIME = "SELECT time, AVG(v) AS v FROM grid GROUP BY time"


def _streamed(s, d):
    """The hourly resample of events as a stream; windows past the watermark are written."""
    schema = table(s, d, "events").schema
    stream = s.readStream.schema(schema).parquet(f"{d}/events.parq*")
    out = stream_resample(stream, "ts", "h", "mean", ["value"], "1 hour")
    target, state = scratch_path(s, "stream-out"), scratch_path(s, "stream-state")
    query = (
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state)
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    return rounded(s.read.schema(out.schema).parquet(target), "value")


QUERIES |= {
    "t6_climatology_table": lambda s, d: rounded(g.climatology_table(grid(s, d), "v"), "v_climatology"),
    "t6_climatology_table_season": lambda s, d: rounded(
        g.climatology_table(grid(s, d), "v", "season"), "v_climatology"
    ),
    "t8_trend": lambda s, d: rounded(rounded(g.trend(_series(s, d), "v"), "v"), "v_trend", "v_detrended", d=3),
    "t8_trend_by": lambda s, d: rounded(
        rounded(g.trend(_daily(s, d), "v", by=["lat"]), "v"), "v_trend", "v_detrended", d=3
    ),
    "t8_trend_degree_2": lambda s, d: rounded(
        rounded(g.trend(_series(s, d), "v", degree=2), "v"), "v_trend", "v_detrended", d=3
    ),
    "t9_spectrum": lambda s, d: _spectrum(g.spectrum(grid(s, d), "v")),
    "t9_spectrum_by_level": lambda s, d: _spectrum(g.spectrum(grid(s, d), "v", by=["level"])),
    # the axis counts as too long for one task here: the transform itself is spread
    "t9_spectrum_spread": lambda s, d: _spectrum(g.spectrum(grid(s, d), "v", max_steps=1000)),
    "t9_peak_period": lambda s, d: g.peak_period(g.spectrum(grid(s, d), "v")).select(
        r("peak_period_days", 6).alias("peak_period_days")
    ),
    "t10_climate_series": lambda s, d: rounded(
        g.climate_series(grid(s, d), "v"), "v", "v_trend", "v_detrended", "v_anomaly", d=3
    ),
    "streaming_resample_hourly": _streamed,
}

_SPECTRUM = _spectrum_sql(_BY_TIME, "")
ORACLE |= {
    "t9_spectrum_spread": _SPECTRUM,
    "t6_climatology_table": with_grid(
        f"""
        SELECT EXTRACT(MONTH FROM time) AS month, {rs('AVG(v)')} AS v_climatology,
               ({_MONTHS})[EXTRACT(MONTH FROM time)] AS month_name FROM grid GROUP BY ALL
        """
    ),
    "t6_climatology_table_season": with_grid(
        f"SELECT {KEYS['season']} AS season, {rs('AVG(v)')} AS v_climatology FROM grid GROUP BY 1"
    ),
    "t8_trend": _trend_sql(_BY_TIME, "")
    .format(group="", join=", fit")
    .replace("s.*", f"time, {rs('v')} AS v"),
    "t8_trend_by": _trend_sql("SELECT time, lat, AVG(v) AS v FROM grid GROUP BY time, lat", "lat,")
    .format(group="GROUP BY lat", join="JOIN fit USING (lat)")
    .replace("s.*", f"time, lat, {rs('v')} AS v"),
    "t8_trend_degree_2": _poly_sql(),
    "t9_spectrum": _SPECTRUM,
    "t9_spectrum_by_level": _spectrum_sql("SELECT level, time, AVG(v) AS v FROM grid GROUP BY level, time", "level"),
    "t9_peak_period": (
        f"SELECT {rs('period_days', 6)} AS peak_period_days FROM ({_dft(_BY_TIME, '')}) ORDER BY power DESC, k LIMIT 1"
    ),
    "t10_climate_series": with_grid(
        f"""
        , b AS (SELECT {bucket_sql('time', 'MS')} AS time, AVG(v) AS v FROM series GROUP BY 1),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL 1 MONTH)) AS time FROM b),
        s AS (SELECT spine.time, v FROM spine LEFT JOIN b USING (time)),
        fit AS (SELECT REGR_SLOPE(v, {_DAYS}) AS k, REGR_INTERCEPT(v, {_DAYS}) AS c FROM s)
        SELECT time, {rs('v', 3)} AS v, {rs(f'c + k * {_DAYS}', 3)} AS v_trend,
               {rs(f'v - (c + k * {_DAYS})', 3)} AS v_detrended,
               {rs('v - AVG(v) OVER (PARTITION BY EXTRACT(MONTH FROM time))', 3)} AS v_anomaly
        FROM s, fit
        """,
        SERIES,
    ),
    "streaming_resample_hourly": f"""
        SELECT date_trunc('hour', ts) AS ts, {rs('AVG(value)')} AS value FROM events GROUP BY 1
        HAVING date_trunc('hour', ANY_VALUE(ts)) + INTERVAL 1 HOUR
               <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
        """,
}


def _counted_sql(source, width, origin, method):
    """Buckets of a fixed width counted from an origin, with the empty ones."""
    value = "COALESCE(v, 0)" if method == "sum" else "v"
    return f"""
        , s AS ({source}),
        b AS (SELECT TIME_BUCKET(INTERVAL {width}, t, {origin}) AS t, {_sql(method, 'v')} AS v FROM s GROUP BY 1),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(t), MAX(t), INTERVAL {width})) AS t FROM b)
        SELECT spine.t AS time, {rs(value, 3)} AS v FROM spine LEFT JOIN b ON b.t = spine.t
        """


def _events(s, d):
    return table(s, d, "events").select(F.col("ts").alias("time"), F.col("value").alias("v"))


_MIDNIGHT = "(SELECT DATE_TRUNC('day', MIN(t)) FROM s)::TIMESTAMP"
QUERIES |= {
    "t1_resample_6h_mean": lambda s, d: rounded(g.resample(_events(s, d), "time", "6h", "mean"), "v", d=3),
    "t1_resample_2d_sum": lambda s, d: rounded(g.resample(grid(s, d), "time", "2D", "sum", values=["v"]), "v", d=3),
    "t1_resample_me_max": lambda s, d: rounded(g.resample(grid(s, d), "time", "ME", "max", values=["v"]), "v", d=3),
    "t2_resample_groups_6h": lambda s, d: rounded(
        g.resample(table(s, d, "events"), "ts", "6h", "max", ["event_type"], ["value"]), "value", d=3
    ),
}
ORACLE |= {
    "t1_resample_6h_mean": with_grid(_counted_sql("SELECT ts AS t, value AS v FROM events", "6 HOUR", _MIDNIGHT, "mean")),
    "t1_resample_2d_sum": with_grid(_counted_sql("SELECT time::TIMESTAMP AS t, v FROM grid", "2 DAY", _MIDNIGHT, "sum")),
    "t1_resample_me_max": with_grid(
        f"""
        , b AS (SELECT DATE_TRUNC('month', time) AS t, MAX(v) AS v FROM grid GROUP BY 1),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(t), MAX(t), INTERVAL 1 MONTH)) AS t FROM (SELECT t::TIMESTAMP AS t FROM b))
        SELECT LAST_DAY(spine.t)::TIMESTAMP AS time, {rs('v', 3)} AS v FROM spine LEFT JOIN b ON b.t = spine.t
        """
    ),
    "t2_resample_groups_6h": f"""
        WITH b AS (SELECT event_type, TIME_BUCKET(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS ts, MAX(value) AS value
                   FROM events GROUP BY 1, 2),
        spine AS (SELECT event_type, UNNEST(GENERATE_SERIES(MIN(ts), MAX(ts), INTERVAL 6 HOUR)) AS ts FROM b GROUP BY 1)
        SELECT event_type, ts, {rs('value', 3)} AS value FROM spine LEFT JOIN b USING (event_type, ts)
        """,
}
