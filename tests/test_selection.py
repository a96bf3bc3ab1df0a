import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from tests.conftest import frame, rows


def test_range_slice_is_inclusive(sample):
    lats = {r.lat for r in g.dim_slice(sample, "lat", start=20.0, stop=40.0).select("lat").distinct().collect()}
    assert lats == {20.0, 30.0, 40.0}


def test_time_range_stops_at_midnight(spark):
    df = frame(spark, pd.DataFrame({"time": pd.to_datetime(["2020-03-31 00:00", "2020-03-31 06:00"]), "v": [1.0, 2.0]}))
    assert [r.v for r in g.dim_slice(df, "time", stop="2020-03-31").collect()] == [1.0]


def test_values_slice(sample):
    assert g.dim_slice(sample, "lat", values=[10.0, 50.0, 51.0]).select("lat").distinct().count() == 2
    assert g.dim_slice(sample, "lat", values=[]).count() == 0


@pytest.mark.parametrize("value, expected", [(14.9, 10.0), (15.0, 10.0), (15.1, 20.0), (-500.0, 10.0), (99.0, 50.0)])
def test_nearest_takes_all_rows_and_the_smaller_tie(sample, value, expected):
    out = g.dim_slice(sample, "lat", values=[value], nearest=True)
    assert out.count() == 300
    assert {r.lat for r in out.select("lat").distinct().collect()} == {expected}


def test_nearest_after_a_filter(sample):
    out = g.dim_slice(sample.filter("lat > 15"), "lat", values=[11.0, 47.0], nearest=True)
    assert {r.lat for r in out.select("lat").distinct().collect()} == {20.0, 50.0}


def test_nearest_on_empty_input(sample):
    assert g.dim_slice(sample.filter("lat > 900"), "lat", values=[1.0], nearest=True).count() == 0


def test_missing_dimension_is_a_no_op(sample):
    assert g.dim_slice(sample, "depth", start=1) is sample
    assert g.bbox(sample, lat_min=5, lat="nope") is sample


def test_bbox(sample):
    out = g.bbox(sample, lat_min=20, lat_max=40, lon_min=105)
    assert out.agg(F.min("lat"), F.max("lat"), F.min("lon")).first()[:] == (20.0, 40.0, 110.0)


def test_get_kinds(synthetic):
    assert g.get(synthetic, lat=30).count() == 40
    assert g.get(synthetic, lat=[10.0, 20.0], lon=100.0).count() == 20
    assert g.get(synthetic, lat=slice(20, 40)).count() == 120
    assert g.get(synthetic, lat=[]).count() == 0
    assert g.get(synthetic, time=dt.datetime(2020, 1, 3)).count() == 20
    assert g.get(synthetic, time=pd.Timestamp("2020-01-03"), __index=True).count() == 20
    with pytest.raises(ValueError, match="depth"):
        g.get(synthetic, depth=1)


def test_get_on_integers_keeps_fractions_apart(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert g.get(df, k=3.5).count() == 0
    assert g.get(df, k=slice(2.5, 4.5)).count() == 2
    assert g.get(df, k=3.0).count() == 1


def test_select_variables_names_what_is_missing(synthetic):
    assert g.select_variables(synthetic, ["pressure"]).columns == ["time", "lat", "lon", "pressure"]
    with pytest.raises(ValueError, match="humidity.*pressure"):
        g.select_variables(synthetic, ["humidity"])


def test_nearest_cell_ties_and_outside(sample):
    assert g.nearest_cell(sample, 15.0, 105.0).first()[:2] == (10.0, 100.0)
    assert g.nearest_cell(sample, 900.0, -900.0).first()[:2] == (50.0, 100.0)
    assert g.nearest_cell(sample.filter("lat < 0"), 0, 0).count() == 0


def test_sample_does_not_depend_on_partitioning(sample):
    pick = [
        rows(g.sample_n(sample.repartition(n), 20, ["time", "lat", "lon"], seed=3), "time", "lat", "lon")
        for n in (1, 7)
    ]
    assert pick[0].equals(pick[1]) and len(pick[0]) == 20


def test_unit_conversion_reads_and_rewrites_units(synthetic):
    out = g.convert_units(synthetic, "temperature")
    assert out.schema["temperature"].metadata["units"] == "degC"
    assert out.agg(F.max("temperature")).first()[0] < 40
    assert g.convert_units(synthetic, "pressure") is synthetic


def test_time_steps(sample):
    steps = [r.time for r in g.time_steps(sample, 3).collect()]
    assert steps == [dt.datetime(2020, 1, d) for d in (1, 2, 3)]


def test_top_k_skips_missing(spark):
    df = frame(spark, pd.DataFrame({"k": [1, 2, 3], "v": [None, 5.0, 7.0]}))
    assert [r.v for r in g.top_k(df, "v", 2, desc=False).collect()] == [5.0, 7.0]


def test_labels_of_32_bits(spark):
    """0.1 as a float is another number than 0.1 as a double."""
    df = spark.range(10).selectExpr("CAST(id / 10 AS FLOAT) AS lat", "id AS v", "5.0 AS lon")
    assert g.get(df, lat=0.1).count() == 1
    assert g.get(df, lat=[0.1, 0.3, 0.7]).count() == 3
    assert g.dim_slice(df, "lat", 0.1, 0.3).count() == 3
    assert g.dim_slice(df, "lat", values=[0.6, 0.9]).count() == 2
    assert g.bbox(df, lat_min=0.2, lat_max=0.7).count() == 6
    assert g.sel(g.Grid(df, dims=["lat", "lon"]), lat=0.7).collect()[0]["v"] == 7


def test_all_time_steps(spark):
    df = spark.range(450).selectExpr("id % 300 AS time")
    assert [r.time for r in g.time_steps(df).collect()] == list(range(300))
