"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import graticule as g


@pytest.fixture(scope="module")
def stored(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "s.parquet")
    sample.withColumn("other", F.rand(1)).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main_plan(df) -> str:
    """The plan without its one-row subqueries."""
    return re.split(r"Subquery ", plan(df))[0]


def test_map_shuffles_cells_not_rows(stored):
    axes = g.Grid(stored).axis_stats()
    text = plan(g.map_mean(stored, "air", target=6, axes=axes))
    assert text.index("partial_avg") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1 and "Python" not in text
    assert "ReadSchema: struct<lat:double,lon:double,air:double>" in text


def test_anomaly_broadcasts_the_calendar_means(stored):
    text = plan(g.anomaly(stored, "air", "month"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("make", [
    lambda d: g.anomaly(d, "air", None),
    lambda d: g.trend(d, "air"),
    lambda d: g.histogram(d, "air"),
])
def test_global_numbers_come_from_subqueries_not_cross_joins(stored, make):
    text = plan(make(stored))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Window" not in text


def test_trend_does_not_move_rows(stored):
    assert "Exchange" not in main_plan(g.trend(stored, "air"))


def test_few_group_fits_are_broadcast(stored):
    text = plan(g.trend(stored, "air", by=["lat"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_top_k_and_time_steps_do_not_sort_everything(stored):
    assert "TakeOrderedAndProject" in plan(g.top_k(stored, "air", 5))
    assert "TakeOrderedAndProject" in plan(g.time_steps(stored, 200))
    assert "TakeOrderedAndProject" in plan(g.sample_n(stored, 5, ["time", "lat", "lon"]))


def test_nearest_cell_is_an_aggregate(stored):
    text = plan(g.nearest_cell(stored, 1, 2))
    assert "Sort [" not in text and "partial_min" in text
    assert "ReadSchema: struct<lat:double,lon:double>" in text


def test_regions_are_one_scan_without_join(stored):
    text = plan(g.region_stats(stored, "air"))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_known_axes_add_no_job_and_no_scan(stored):
    axes = g.Grid(stored).axis_stats()
    for make in (
        lambda: g.coverage(stored, "air", axes=axes),
        lambda: g.hovmoller(stored, "air", axes=axes),
        lambda: g.cross_section(stored.withColumn("level", F.lit(1)), "air", axes=axes),
    ):
        assert plan(make()).count("FileScan") == 1


def test_bins_follow_the_definition():
    from graticule.functions.bins import AxisStats, bin_width

    lat, lon = AxisStats(6336, -80.0, 79.0), AxisStats(10800, -180.0, 180.0)
    cells = lat.size * lon.size
    ratio = (cells / 60_000) ** 0.5
    assert bin_width(lat, cells, 60_000) == 159.0 / int(6336 / ratio)
    assert bin_width(AxisStats(5, 0.0, 4.0), 10**9, 10) == 0.4
    assert bin_width(lat, cells, None) is None and bin_width(lat, cells, cells) is None
    assert bin_width(AxisStats(1, 3.0, 3.0), 10**9, 10) is None


def test_axis_of_one_label_is_not_binned(spark):
    df = spark.range(100).select(F.lit(5.0).alias("lat"), F.col("id").cast("double").alias("lon"), F.lit(1.0).alias("v"))
    assert {r.lat for r in g.map_mean(df, "v", target=20).collect()} == {5.0}
