"""Headline queries over the gridded view; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select
data and cores. Each query runs once to warm up, then BENCH_RUNS times; the
median counts. Every run builds its plan anew and materialises the whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import graticule as g  # noqa: E402
from checks.common import DIMS, grid  # noqa: E402
from graticule.session import local_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def headline(spark, sf):
    """name -> function returning the frame to materialise.

    A dataset is opened once and its axes are kept, so map queries start from them.
    """
    data = g.Grid(grid(spark, sf), DIMS)
    df = data.df
    axes = data.axis_stats(["lat", "lon"])
    monthly = lambda: g.resample(df.select("time", "lat", "lon", "v"), "time", "MS", "mean", ["lat", "lon"])
    return {
        "open_dataset_axes": lambda: spark.createDataFrame(
            [(n, s.size, s.min, s.max) for n, s in g.Grid(df, DIMS).axis_stats(["lat", "lon"]).items()],
            "dim string, size long, min double, max double",
        ),
        "f5_bbox_profile": lambda: g.profile(g.bbox(df, -30, 45, lon_min=100), "v", "lat"),
        "b2_map_binned": lambda: g.map_mean(df, "v", 400, axes=axes),
        "b2_map_unaided": lambda: g.map_mean(df, "v", 400),
        "b2_map_full": lambda: g.map_mean(df, "v", None),
        "b3_hovmoller": lambda: g.hovmoller(df, "v", "lat", 400, axes=axes),
        "a1_reduce_time": lambda: g.reduce_dims(df, ["time", "level"], "mean", ["v", "w"]),
        "a4_summary": lambda: g.summary(df, ["v", "w"]),
        "a5_region_stats": lambda: g.region_stats(df, "v"),
        "a9_percentiles_by_lat": lambda: g.percentiles(df, "v", (0.1, 0.5, 0.9), ["lat"]),
        "a10_histogram": lambda: g.histogram(df, "v"),
        "t1_resample_month": lambda: g.resample(df, "time", "MS", "mean", values=["v", "w"]),
        "t2_resample_cells": monthly,
        "t4_anomaly_month": lambda: g.anomaly(df, "v", "month"),
        "t7_rolling_30": lambda: g.rolling(g.time_series(df, "v"), "v", 30),
        "t8_trend": lambda: g.trend(df, "v"),
        "t9_spectrum": lambda: g.spectrum(df, "v"),
        "j1_diff_periods": lambda: g.diff_periods(
            df, "v", ("1995-01-01", "1998-06-30"), ("1998-07-01", "2002-01-01"), 400, axes=axes
        ),
        "j3_cross_variable": lambda: g.cross_variable(df, var_a="v", var_b="w", dims=["time", "lat", "lon"]),
        "j6_correlation_map": lambda: g.correlation_map(df, "v", 10.0, -100.0, 400, axes=axes),
        "g1_gradient": lambda: g.gradient(g.map_mean(df, "v", None), "v"),
        "g2_transect": lambda: g.transect(df, "v", (-60.0, -120.0), (62.0, 131.0), 50, axes=axes),
    }


def measure(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name, make in headline(spark, sf).items():
        measure(make)
        seconds[name] = round(statistics.median(measure(make) for _ in range(RUNS)), 4)
    total = round(sum(seconds.values()), 4)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
