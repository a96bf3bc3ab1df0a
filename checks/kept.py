"""Kept sketches, pyramids and file indexes; many boxes, targets and columns at once; calendar streams."""

from __future__ import annotations

from pyspark.sql import functions as F

import graticule as g
from checks.common import DIMS, grid, r, rounded, rs, table, with_grid
from graticule.operators.profiling import column_report_approx, column_sketches, distinct_error, merged_report
from graticule.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketch_percentiles
from graticule.session import materialize, scratch_path
from graticule.sources.index import files_for, index_files, read_ranges, time_continuity
from graticule.streaming.calendar import close_stream, resample_stream

PS = (0.1, 0.5, 0.9)


# ---- A9: sketches per month and latitude, kept as a table, merged for a range ----


def _kept_sketches(s, d):
    return materialize(quantile_sketches(grid(s, d), "v", ["lat"], time="time", freq="MS"), "sketches")


def _in_range(df):
    return df.filter((F.col("time") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("time") < F.lit("1999-01-01").cast("timestamp_ntz")))


def _sketch_error(s, d):
    """Per latitude and percentile: n, and whether the estimate's true rank is as near as stated."""
    estimates = sketch_percentiles(_in_range(_kept_sketches(s, d)), "v", PS, ["lat"])
    flat = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"v_p{p * 100:g}").alias("x")) for p in PS])).alias("e")
    flat = estimates.select("lat", "n", "rank_error", flat).select("lat", "n", "rank_error", "e.p", "e.x")
    rows = _in_range(grid(s, d)).select("lat", "v").filter("v IS NOT NULL")
    ranks = rows.join(F.broadcast(flat), "lat").groupBy("lat", "p", "n", "rank_error").agg(
        F.avg((F.col("v") < F.col("x")).cast("double")).alias("low"), F.avg((F.col("v") <= F.col("x")).cast("double")).alias("high")
    )
    # a step of one row at either end; a percentile of few values falls between two of them
    slack = 2 * F.col("rank_error") + 1.0 / F.col("n")
    return ranks.select("lat", "p", "n", ((F.col("low") <= F.col("p") + slack) & (F.col("high") >= F.col("p") - slack)).alias("as_stated"))


def _approx_error(s, d):
    """The same of the built-in approximation."""
    estimates = g.percentiles(grid(s, d), "v", PS, ["lat"], approx=True)
    flat = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"v_p{p * 100:g}").alias("x")) for p in PS])).alias("e")
    flat = estimates.select("lat", flat).select("lat", "e.p", "e.x")
    rows = grid(s, d).select("lat", "v").filter("v IS NOT NULL")
    ranks = rows.join(F.broadcast(flat), "lat").groupBy("lat", "p").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("v") < F.col("x")).cast("double")).alias("low"), F.avg((F.col("v") <= F.col("x")).cast("double")).alias("high")
    )
    slack = 1e-4 + 1.0 / F.col("n")
    return ranks.select("lat", "p", "n", ((F.col("low") <= F.col("p") + slack) & (F.col("high") >= F.col("p") - slack)).alias("as_stated"))


def _exact_from_sketches(s, d):
    """Exact percentiles of large groups, bracketed by kept sketches of finer groups."""
    kept = merge_sketches(materialize(quantile_sketches(grid(s, d), "v", ["level"], time="time", freq="YS"), "sketches"), ["level"])
    out = g.percentiles(grid(s, d), "v", PS, ["level"], max_group_rows=500, sketches=kept)
    return rounded(out, "v_p10", "v_p50", "v_p90", "v_spread")


_STATED = "SELECT lat, p, COUNT(v) AS n, TRUE AS as_stated FROM {source}, (VALUES (0.1::DOUBLE), (0.5), (0.9)) AS ps(p) GROUP BY lat, p HAVING COUNT(v) > 0"
_PCT = ", ".join(f"{rs(f'QUANTILE_CONT(v, {p})')} AS v_p{p * 100:g}" for p in PS)
_PCT += f", {rs('QUANTILE_CONT(v, 0.9) - QUANTILE_CONT(v, 0.1)')} AS v_spread"
_RANGE = "(SELECT * FROM grid WHERE time >= '1996-01-01' AND time < '1999-01-01')"


# ---- B2: a pyramid of sums ----

WIDTHS = (5.0, 5.0)


def _pyramid(s, d):
    return g.Pyramid.build(grid(s, d), scratch_path(s, "pyramid"), ["v", "w"], levels=4, time="time", freq="QS", keys=["level"], widths=WIDTHS)


def _pyramid_range(s, d):
    """A range that cuts two quarters: whole ones from the pyramid, cut ones from the data."""
    return rounded(_pyramid(s, d).map("v", 1, start="1996-02-10", end="2000-11-20 12:00:00", df=grid(s, d)), "v")


def _pyramid_refreshed(s, d):
    """Built without the rows of 1997 and then told which quarters have changed."""
    before = grid(s, d).filter((F.col("time") < F.lit("1997-01-01").cast("timestamp_ntz")) | (F.col("time") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    pyramid = g.Pyramid.build(before, scratch_path(s, "pyramid"), ["v"], levels=3, time="time", freq="QS", widths=WIDTHS)
    pyramid.refresh(grid(s, d), ["1997-02-01", "1997-05-05", "1997-08-01", "1997-12-31"])
    return rounded(pyramid.map("v", 2), "v")


def _pyramid_sql(level, where="TRUE", by=""):
    w = WIDTHS[0] * 2**level
    return with_grid(
        f"SELECT {by} FLOOR(lat / {w}) * {w} AS lat, FLOOR(lon / {w}) * {w} AS lon, {rs('AVG(v)')} AS v FROM grid WHERE {where} GROUP BY ALL"
    )


# ---- S2: an index of files ----


def _files(s, d):
    """The orders of each year as a file or more, and a file that repeats a quarter."""
    folder = scratch_path(s, "orders")
    orders = table(s, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").withColumn("y", F.year("o_orderdate"))
    for year in range(1995, 2002):
        part = orders.filter(F.col("y") == year).drop("y")
        if year == 1995:
            part = part.filter((F.month("o_orderdate") < 5) | (F.month("o_orderdate") > 8))
            g.write_table(part.filter(F.month("o_orderdate") < 5).coalesce(1), f"{folder}/y=1995a", "parquet")
            part = part.filter(F.month("o_orderdate") > 8)
        g.write_table(part.coalesce(1), f"{folder}/y={year}", "parquet")
    again = orders.filter((F.col("y") == 1997) & (F.month("o_orderdate") < 4)).drop("y")
    g.write_table(again.coalesce(1), f"{folder}/y=1997b", "parquet")
    return [f"{folder}/{name}" for name in ("y=1995a", "y=1995", "y=1996", "y=1997", "y=1997b", "y=1998", "y=1999", "y=2000", "y=2001")]


def _continuity(s, d):
    out = time_continuity(index_files(s, _files(s, d), ["o_orderdate"], "parquet"), "o_orderdate", 86_400.0)
    return out.select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), F.col("covered_until").cast("timestamp_ntz").alias("covered_until"), "gap_seconds", "overlap_seconds"
    )


def _pruned(s, d):
    """Rows of a range from the files that can hold some, with how many files that are."""
    index = materialize(index_files(s, _files(s, d), ["o_orderdate", "o_totalprice"], "parquet"), "index")
    ranges = {"o_orderdate": ("1996-06-01", "1997-02-15"), "o_totalprice": (1000.0, None)}
    opened = files_for(index, ranges).count()
    rows = read_ranges(s, index, ranges, "parquet")
    return rows.groupBy(F.month("o_orderdate").cast("bigint").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")).withColumn("files", F.lit(opened).cast("bigint"))


_PARTS = """
  parts AS (
    SELECT CASE WHEN YEAR(o_orderdate) = 1995 AND MONTH(o_orderdate) < 5 THEN '1995a' ELSE YEAR(o_orderdate)::VARCHAR END AS file, o_orderdate AS t, o_totalprice AS price
    FROM orders WHERE YEAR(o_orderdate) <> 1995 OR MONTH(o_orderdate) NOT BETWEEN 5 AND 8
    UNION ALL SELECT '1997b', o_orderdate, o_totalprice FROM orders WHERE YEAR(o_orderdate) = 1997 AND MONTH(o_orderdate) < 4),
  files AS (SELECT file, MIN(t)::TIMESTAMP AS start, MAX(t)::TIMESTAMP AS "end", MIN(price) AS lo, MAX(price) AS hi FROM parts GROUP BY file)
"""


# ---- A5: many boxes ----


def _boxes(s, d):
    """A box per supplier and customer, of many sizes, some without points and some beyond the grid."""
    k = F.col("k")
    keys = table(s, d, "customer").select(F.col("c_custkey").cast("bigint").alias("k")).unionByName(table(s, d, "supplier").select((-1 - F.col("s_suppkey")).cast("bigint").alias("k")))
    keys = keys.filter(k <= 990)
    y, x = (F.abs(k) * 37 % 1800) / 10.0 - 95.0, (F.abs(k) * 101 % 3600) / 10.0 - 185.0
    high, wide = (F.abs(k) % 13) * 3.5 - 1.0, (F.abs(k) % 29) * 6.25
    return keys.select(k.alias("region"), y.alias("lat_min"), (y + high).alias("lat_max"), x.alias("lon_min"), (x + wide).alias("lon_max"))


_BOXES = """
  boxes AS (
    SELECT k AS region, (ABS(k) * 37 % 1800) / 10.0 - 95.0 AS y0, (ABS(k) * 37 % 1800) / 10.0 - 95.0 + ((ABS(k) % 13) * 3.5 - 1.0) AS y1,
           (ABS(k) * 101 % 3600) / 10.0 - 185.0 AS x0, (ABS(k) * 101 % 3600) / 10.0 - 185.0 + (ABS(k) % 29) * 6.25 AS x1
    FROM (SELECT c_custkey::BIGINT AS k FROM customer UNION ALL SELECT -1 - s_suppkey::BIGINT FROM supplier) WHERE k <= 990),
  m AS (SELECT lat, lon, LIST(v) FILTER (WHERE v IS NOT NULL) AS vs FROM grid GROUP BY lat, lon),
  inside AS (SELECT region, UNNEST(vs) AS v FROM boxes JOIN m ON lat BETWEEN y0 AND y1 AND lon BETWEEN x0 AND x1)
"""


# ---- F4, F10: many targets ----


def _targets(s, d):
    k = F.col("c_custkey").cast("bigint")
    return table(s, d, "customer").select(k.alias("id"), ((k * 41 % 200) - 100.0).alias("lat"), ((k * 7 % 380) - 190.0).alias("lon"))


def _at_nearest(s, d):
    """Rows and mean at each target's nearest latitude; a latitude is summed up once, however many targets it has."""
    sums = [F.count(F.lit(1)).alias("rows"), F.sum("v").alias("total"), F.count("v").alias("known")]
    found = g.nearest_frame(grid(s, d).filter("level = 2 AND lon < -150"), _targets(s, d).select("id", "lat"), ["lat"], summary=sums)
    return found.groupBy("id", "lat", "nearest_lat").agg(F.sum("rows").alias("n"), r(F.try_divide(F.sum("total"), F.sum("known"))).alias("v"))


_TARGETS = """
  targets AS (SELECT c_custkey::BIGINT AS id, (c_custkey * 41 % 200) - 100.0 AS lat, (c_custkey * 7 % 380) - 190.0 AS lon FROM customer)
"""


def _near_sql(axis):
    return f"""
      near_{axis} AS (
        SELECT t.{axis} AS target, l.{axis} AS label FROM (SELECT DISTINCT {axis} FROM targets) t, (SELECT DISTINCT {axis} FROM grid) l
        QUALIFY ROW_NUMBER() OVER (PARTITION BY t.{axis} ORDER BY ABS(l.{axis} - t.{axis}), l.{axis}) = 1)
    """


# ---- streams ----


def _streamed(freq, method, groups, delay):
    """The orders as a stream of six files, each with a few rows of the one before, closed at the end."""

    def query(s, d):
        folder = scratch_path(s, "stream-in")
        orders = table(s, d, "orders").select("o_orderdate", "o_orderpriority", "o_totalprice", "o_orderkey")
        first, last = orders.agg(F.min(F.unix_micros(F.col("o_orderdate").cast("timestamp"))), F.max(F.unix_micros(F.col("o_orderdate").cast("timestamp")))).first()
        # rows come up to 20 days late
        arrives = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (F.col("o_orderkey") % 21) * 86_400_000_000
        part = F.least(F.floor((arrives - first) / ((last - first) / 6.0)), F.lit(5))
        for i in range(6):
            orders.filter(part == i).coalesce(1).write.mode("append").parquet(folder)
        close_stream(s, folder, orders.schema, "o_orderdate", "2010-01-01")
        stream = s.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        out = resample_stream(stream, "o_orderdate", freq, method, ["o_totalprice"], delay, groups)
        target = scratch_path(s, "stream-out")
        run = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", scratch_path(s, "stream-state"))
        run.trigger(availableNow=True).start(target).awaitTermination()
        return rounded(s.read.schema(out.schema).parquet(target), "o_totalprice", d=3)

    return query


_BUCKETS = {"W": "CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAYS AS TIMESTAMP)", "MS": "date_trunc('month', o_orderdate)::TIMESTAMP", "QE": "LAST_DAY(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTHS)::TIMESTAMP"}


def _streamed_sql(freq, function, keys):
    return f"SELECT {keys} {_BUCKETS[freq]} AS o_orderdate, {rs(f'{function}(o_totalprice)', 3)} AS o_totalprice FROM orders GROUP BY ALL"


# ---- M2, M3: distinct values from sketches ----


def _within(s, d):
    """Per column: counts, and whether the estimate is within four standard errors of the exact number."""
    df = table(s, d, "lineitem")
    exact = g.column_report(df).select("column", F.col("unique_values").alias("exact"))
    found = column_report_approx(df).join(exact, "column")
    close = F.abs(F.col("unique_values") - F.col("exact")) <= 4 * distinct_error() * F.col("exact") + 1
    return found.select("column", "total", "non_null", close.alias("within"))


def _united(s, d):
    """Sketches kept per ship mode, united for two of them."""
    kept = materialize(column_sketches(table(s, d, "lineitem").select("l_returnflag", "l_orderkey", "l_shipdate", "l_tax"), ["l_returnflag"]), "sketches")
    some = merged_report(kept.filter("l_returnflag IN ('A', 'R')"))
    exact = table(s, d, "lineitem").filter("l_returnflag IN ('A', 'R')").agg(*[F.count_distinct(c).alias(c) for c in ("l_orderkey", "l_shipdate", "l_tax")]).first()
    wanted = F.create_map(*[x for c, n in exact.asDict().items() for x in (F.lit(c), F.lit(n))])
    close = F.abs(F.col("unique_values") - wanted[F.col("column")]) <= 4 * distinct_error() * wanted[F.col("column")] + 1
    return some.select("column", "total", "non_null", close.alias("within"))


# ---- A2, F7: more reductions, stepped slices ----


def _reduced(var, dims, method):
    return lambda s, d: g.Grid(grid(s, d), DIMS).reduce(var, dims, method)


def _product(s, d):
    """Products of factors near 1, as those of prices would be infinite."""
    near_one = grid(s, d).withColumn("v", 1.0 + (F.col("v") - 40_000.0) / 1e9)
    return rounded(g.Grid(near_one, DIMS).reduce("v", ["time", "level"], "prod"), "v", d=6)


_STEPPED = "SELECT {what} FROM grid JOIN (SELECT time, ROW_NUMBER() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM grid)) USING (time)"

QUERIES = {
    "a9_sketch_rank_error": _sketch_error,
    "a9_percentiles_approx_error": _approx_error,
    "a9_percentiles_from_sketches": _exact_from_sketches,
    "b2_pyramid_finest": lambda s, d: rounded(_pyramid(s, d).map("v"), "v"),
    "b2_pyramid_coarse": lambda s, d: rounded(_pyramid(s, d).map("v", 3), "v"),
    "b2_pyramid_keys": lambda s, d: rounded(_pyramid(s, d).map("v", 2, by=["level"], where=F.col("level") >= 4), "v"),
    "b2_pyramid_range": _pyramid_range,
    "b2_pyramid_refreshed": _pyramid_refreshed,
    "s2_time_continuity": _continuity,
    "s2_pruned_files": _pruned,
    "a5_region_stats_1000": lambda s, d: rounded(g.region_stats_many(grid(s, d), "v", _boxes(s, d)), "mean", "std"),
    "f4_nearest_frame": _at_nearest,
    "f10_nearest_cells": lambda s, d: g.nearest_cells(grid(s, d), _targets(s, d)),
    "streaming_resample_week": _streamed("W", "mean", [], "21 days"),
    "streaming_resample_month": _streamed("MS", "sum", ["o_orderpriority"], "21 days"),
    "streaming_resample_quarter": _streamed("QE", "max", ["o_orderpriority"], "21 days"),
    "m3_column_report_approx": _within,
    "m3_column_report_united": _united,
    "a2_grid_reduce_first": _reduced("v", ["time", "level", "lon"], "first"),
    "a2_grid_reduce_last": _reduced("v", ["time", "level", "lon"], "last"),
    "a2_grid_reduce_prod": _product,
    "a2_grid_reduce_any": _reduced("w", ["time", "lat", "level"], "any"),
    "a2_grid_reduce_all": _reduced("w", ["time", "lat", "level"], "all"),
    "t3_grid_resample_ms_last": lambda s, d: g.Grid(grid(s, d).groupBy("time", "lat").agg(F.max("v").alias("v")), ["time", "lat"]).resample("v", "MS", "last"),
    "f7_isel_step": lambda s, d: g.isel(g.Grid(grid(s, d), DIMS), time=slice(3, -5, 7), level=0),
    "a7_zone_bands": lambda s, d: rounded(g.band_stats(grid(s, d), "v", [(60, 90, "north"), (-20, 20, "tropics"), (0, 45, "rest")]), "mean"),
}

ORACLE = {
    "a9_sketch_rank_error": with_grid(_STATED.format(source=_RANGE)),
    "a9_percentiles_approx_error": with_grid(_STATED.format(source="grid")),
    "a9_percentiles_from_sketches": with_grid(f"SELECT level, {_PCT} FROM grid GROUP BY level"),
    "b2_pyramid_finest": _pyramid_sql(0),
    "b2_pyramid_coarse": _pyramid_sql(3),
    "b2_pyramid_keys": _pyramid_sql(2, "level >= 4", "level,"),
    "b2_pyramid_range": _pyramid_sql(1, "time >= '1996-02-10' AND time < '2000-11-20 12:00:00'"),
    "b2_pyramid_refreshed": _pyramid_sql(2),
    "s2_time_continuity": f"""
        WITH {_PARTS},
        swept AS (SELECT *, MAX("end") OVER (ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered_until FROM files)
        SELECT start, "end", covered_until,
               CASE WHEN EPOCH(start) - EPOCH(covered_until) > 86400 THEN EPOCH(start) - EPOCH(covered_until) ELSE 0.0 END AS gap_seconds,
               CASE WHEN covered_until > start THEN EPOCH(LEAST("end", covered_until)) - EPOCH(start) ELSE 0.0 END AS overlap_seconds
        FROM swept
        """,
    "s2_pruned_files": f"""
        WITH {_PARTS},
        opened AS (SELECT COUNT(*) AS files FROM files WHERE "end" >= '1996-06-01' AND start <= '1997-02-15' AND hi >= 1000)
        SELECT MONTH(t) AS month, COUNT(*) AS n, MAX(price) AS top, ANY_VALUE(files) AS files
        FROM parts, opened WHERE t >= '1996-06-01' AND t <= '1997-02-15' AND price >= 1000 GROUP BY 1
        """,
    "a5_region_stats_1000": with_grid(
        f"""
        SELECT boxes.region, COUNT(v) AS count, {rs('AVG(v)')} AS mean, {rs('STDDEV_SAMP(v)')} AS std, MIN(v) AS min, MAX(v) AS max
        FROM boxes LEFT JOIN inside USING (region) GROUP BY boxes.region
        """,
        _BOXES,
    ),
    "f4_nearest_frame": with_grid(
        f"""
        SELECT id, t.lat, label AS nearest_lat, COUNT(*) AS n, {rs('AVG(v)')} AS v
        FROM targets t JOIN near_lat ON target = t.lat JOIN (SELECT * FROM grid WHERE level = 2 AND lon < -150) q ON q.lat = label
        GROUP BY ALL
        """,
        _TARGETS,
        _near_sql("lat").replace("FROM grid", "FROM grid WHERE level = 2 AND lon < -150"),
    ),
    "f10_nearest_cells": with_grid(
        """
        SELECT id, t.lat, t.lon, a.label AS nearest_lat, o.label AS nearest_lon, ABS(a.label - t.lat) + ABS(o.label - t.lon) AS distance
        FROM targets t JOIN near_lat a ON a.target = t.lat JOIN near_lon o ON o.target = t.lon
        JOIN (SELECT DISTINCT lat, lon FROM grid) q ON q.lat = a.label AND q.lon = o.label
        """,
        _TARGETS,
        _near_sql("lat"),
        _near_sql("lon"),
    ),
    "streaming_resample_week": _streamed_sql("W", "AVG", ""),
    "streaming_resample_month": _streamed_sql("MS", "SUM", "o_orderpriority,"),
    "streaming_resample_quarter": _streamed_sql("QE", "MAX", "o_orderpriority,"),
    "m3_column_report_approx": "SELECT column_name AS column, n AS total, n AS non_null, TRUE AS within FROM (DESCRIBE lineitem), (SELECT COUNT(*) AS n FROM lineitem)",
    "m3_column_report_united": """
        SELECT UNNEST(['l_orderkey', 'l_shipdate', 'l_tax']) AS column, COUNT(*) AS total, COUNT(*) AS non_null, TRUE AS within
        FROM lineitem WHERE l_returnflag IN ('A', 'R')
        """,
    "a2_grid_reduce_first": with_grid("SELECT lat, FIRST(v ORDER BY time, level, lon, v) AS v FROM grid WHERE v IS NOT NULL GROUP BY lat"),
    "a2_grid_reduce_last": with_grid("SELECT lat, LAST(v ORDER BY time, level, lon, v) AS v FROM grid WHERE v IS NOT NULL GROUP BY lat"),
    "a2_grid_reduce_prod": with_grid(f"SELECT lat, lon, {rs('COALESCE(PRODUCT(1.0 + (v - 40000.0) / 1e9), 1.0)', 6)} AS v FROM grid GROUP BY lat, lon"),
    "a2_grid_reduce_any": with_grid("SELECT lon, BOOL_OR(COALESCE(w <> 0, TRUE)) AS w FROM grid GROUP BY lon"),
    "a2_grid_reduce_all": with_grid("SELECT lon, BOOL_AND(COALESCE(w <> 0, TRUE)) AS w FROM grid GROUP BY lon"),
    "t3_grid_resample_ms_last": with_grid(
        """
        , s AS (SELECT time, lat, MAX(v) AS v FROM grid GROUP BY ALL),
        b AS (SELECT lat, date_trunc('month', time)::TIMESTAMP AS time, LAST(v ORDER BY time) FILTER (WHERE v IS NOT NULL) AS v FROM s GROUP BY 1, 2),
        spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(time), MAX(time), INTERVAL 1 MONTH)) AS time FROM b)
        SELECT lat, time, v FROM (SELECT DISTINCT lat FROM grid) CROSS JOIN spine LEFT JOIN b USING (lat, time)
        """
    ),
    "f7_isel_step": with_grid(
        f"{_STEPPED.format(what='time, lat, lon, v, w')} WHERE i >= 3 AND i < (SELECT COUNT(DISTINCT time) FROM grid) - 5 AND (i - 3) % 7 = 0"
        " AND level = (SELECT MIN(level) FROM grid)"
    ),
    "a7_zone_bands": with_grid(
        f"""
        SELECT CASE WHEN lat >= 60 AND lat <= 90 THEN 'north' WHEN lat >= -20 AND lat < 20 THEN 'tropics' WHEN lat >= 0 AND lat < 45 THEN 'rest' END AS zone,
               {rs('AVG(v)')} AS mean, MIN(v) AS min, MAX(v) AS max, COUNT(*) AS count FROM grid GROUP BY 1 HAVING zone IS NOT NULL
        """
    ),
}
