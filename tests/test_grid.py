import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(synthetic):
    return g.Grid(synthetic, attrs={"title": "test"})


def test_tables_are_the_variables(data):
    assert data.tables() == ["pressure", "temperature"]
    assert data.dims == ["time", "lat", "lon"]
    assert data.table("pressure").columns == ["time", "lat", "lon", "pressure"]
    assert data.table("pressure").count() == 200


def test_subset_of_variables(synthetic):
    assert g.Grid(synthetic, variables=["pressure"]).tables() == ["pressure"]
    with pytest.raises(ValueError, match="humidity.*temperature"):
        g.Grid(synthetic, variables=["humidity"])


@pytest.mark.parametrize("name", ["temperature", '"temperature"', "'Temperature'", "`TEMPERATURE`"])
def test_table_names_are_normalized(data, name):
    assert data.normalize(name) == "temperature"


def test_unknown_tables(data):
    assert data.normalize('"other"') == "other"
    with pytest.raises(ValueError, match="other"):
        data.table("other")


def test_sql(data):
    assert data.sql("SELECT COUNT(*) AS n FROM temperature").first().n == 200
    assert data.sql("SELECT lat, AVG(temperature) AS m FROM temperature GROUP BY lat").count() == 5
    assert data.sql('SELECT "lat" FROM temperature WHERE "lat" > ?', [30.0]).count() == 80
    assert data.sql("SELECT * FROM pressure WHERE lat = :lat AND lon = :lon", {"lat": 10.0, "lon": 100.0}).count() == 10


def test_parameters_are_values_not_text(data):
    assert data.sql("SELECT * FROM temperature WHERE CAST(lat AS STRING) = :x", {"x": "1' OR '1'='1"}).count() == 0


def test_derived_tables(data):
    data.define("warm", "SELECT lat, temperature FROM temperature WHERE temperature > 300")
    assert "warm" in data.tables()
    assert data.sql("SELECT MIN(temperature) AS m FROM warm").first().m > 300
    assert data.get("WARM", lat=[10.0]).count() <= 40


def test_get_drops_missing_on_request(spark):
    pdf = pd.DataFrame({"lat": [1.0, 2.0], "v": [np.nan, 2.0]})
    grid = g.Grid(spark.createDataFrame(pdf), dims=["lat"])
    assert grid.get("v").filter("v IS NULL").count() == 1
    assert grid.get("v", drop_missing=True).count() == 1


def test_sel_and_isel(data):
    assert g.sel(data, lat=30.0).columns == ["time", "lon", "temperature", "pressure"]
    assert g.sel(data, lat=30.0).count() == 40
    assert g.sel(data, lat=[10.0, 50.0], time=slice("2020-01-02", "2020-01-03")).count() == 16
    assert g.sel(data, method="nearest", lat=33.0).count() == 40
    assert g.sel(data, time="2020-01-02").count() == 20
    with pytest.raises(KeyError):
        g.sel(data, lat=31.0)
    assert g.isel(data, time=0).count() == 20
    assert g.isel(data, time=-1, lat=0, lon=-1).count() == 1
    assert g.isel(data, lat=[0, -1]).count() == 80
    assert g.isel(data, lat=slice(1, 3)).count() == 80
    assert g.isel(data, lat=slice(3, 1)).count() == 0
    with pytest.raises(IndexError):
        g.isel(data, lat=5)
    with pytest.raises(IndexError):
        g.isel(data, lat=-6)


def test_positions_follow_the_axes_table(spark, synthetic):
    axis = spark.createDataFrame([(i, float(50 - 10 * i)) for i in range(5)], "idx int, label double")
    grid = g.Grid(synthetic, axes={"lat": axis})
    assert grid.label_at("lat", 0) == 50.0 and grid.label_at("lat", -1) == 10.0
    assert g.isel(grid, lat=slice(0, 4, 2)).select("lat").distinct().count() == 2
    assert grid.dimension_info()["lat"]["step"] == -10.0


def test_dimension_info(data):
    info = data.dimension_info()
    assert info["lat"] == {"size": 5, "dtype": "double", "type": "numeric", "role": "latitude", "min": 10.0, "max": 50.0, "step": 10.0}
    assert info["time"]["type"] == "datetime" and info["time"]["size"] == 10
    assert info["time"]["min"].startswith("2020-01-01")


def test_schema_and_metadata(data):
    schema = data.schema("temperature")
    assert schema["__len__"] == 200
    assert schema["lat"] == {"type": "number", "inclusiveMinimum": 10.0, "inclusiveMaximum": 50.0}
    assert schema["time"]["type"] == "datetime"
    meta = data.metadata("temperature")
    assert meta["description"] == "Air temperature [K] — dimensions: time(10) x lat(5) x lon(4)"
    assert meta["shape"] == [10, 5, 4] and meta["dataset_attrs"] == {"title": "test"}
    assert meta["columns"]["lat"]["units"] == "degrees_north" and meta["columns"]["lat"]["size"] == 5
    assert meta["columns"]["temperature"] == {"data_type": "double", "is_coordinate": False, "units": "K", "description": "Air temperature"}


def test_enums_are_listed(spark):
    df = spark.createDataFrame([("b", True, 1.0), ("a", True, 2.0), (None, False, 3.0)], "k string, f boolean, v double")
    schema = g.Grid(df, dims=["k", "f"]).schema("v")
    listed = lambda values: [r[0] for r in values.collect()]
    assert listed(schema["k"]["enum"]) == ["a", "b"] and listed(schema["f"]["enum"]) == ["false", "true"]
    assert listed(g.Grid(df, dims=["k", "f"]).dimension_info()["k"]["values"]) == ["a", "b"]


def test_derived_tables_of_two_grids(spark):
    one, two = (g.Grid(spark.createDataFrame([(10.0, x)], "lat double, v double")) for x in (1.0, 99.0))
    for grid in (one, two):
        grid.define("z", "SELECT MAX(v) AS m FROM v")
    assert [x.table("z").first()["m"] for x in (one, two)] == [1.0, 99.0]
    assert [x.sql("SELECT m + 1 AS m FROM z").first()["m"] for x in (one, two)] == [2.0, 100.0]


def test_size_estimate(data):
    size = data.estimate_size("temperature")
    assert size == {"rows": 200, "columns": 4, "estimated_bytes": 6400, "estimated_mb": 0.0, "exceeds_warning": False}


def test_reduce_and_resample(data, synthetic_pdf):
    got = rows(data.reduce("temperature", "time"), "lat", "lon")
    np.testing.assert_allclose(got["temperature"], synthetic_pdf.groupby(["lat", "lon"])["temperature"].mean())
    assert data.resample("pressure", "W", "max").count() == 40
    with pytest.raises(ValueError):
        data.reduce("pressure", "time", "mode")


def test_cache_reuses_and_evicts(data):
    frames = [data.table("pressure").filter(F.col("lat") == float(i)) for i in range(22)]
    first = data.cached(frames[0])
    assert data.cached(data.table("pressure").filter(F.col("lat") == 0.0)) is first
    for f in frames[1:]:
        data.cached(f)
    assert len(data._cache) == 20 and not first.is_cached
    data.clear_cache()
    assert len(data._cache) == 0


def test_axis_stats_feed_the_maps(data):
    stats = data.axis_stats()
    assert stats["lat"] == g.AxisStats(5, 10.0, 50.0)
    out = g.map_mean(data.table("pressure"), "pressure", axes=stats)
    assert out.count() == 20


@pytest.mark.parametrize(
    "columns, roles",
    [
        ("Latitude double, Longitude double, valid_time timestamp_ntz, depth double, v double",
         ("Latitude", "Longitude", "valid_time", "depth")),
        ("when timestamp, v double", (None, None, "when", None)),
        ("a double, b double", (None, None, None, None)),
    ],
)
def test_roles_by_name_and_type(spark, columns, roles):
    found = g.detect_roles(spark.createDataFrame([], columns))
    assert tuple(found[r] for r in ("latitude", "longitude", "time", "vertical")) == roles


def test_roles_by_attribute_come_first(spark):
    df = spark.createDataFrame([], "a double, b double, lev double, v double")
    df = df.withMetadata("a", {"standard_name": "latitude"}).withMetadata("b", {"axis": "X"})
    assert g.detect_roles(df) == {"latitude": "a", "longitude": "b", "time": None, "vertical": "lev"}
    assert g.numeric_variables(df) == ["v"]


def test_nan_becomes_null_and_metadata_stays(spark):
    df = spark.createDataFrame(pd.DataFrame({"lat": [1.0], "v": [np.nan]})).withMetadata("v", {"units": "K"})
    grid = g.Grid(df)
    assert grid.df.first().v is None and grid.df.schema["v"].metadata["units"] == "K"


def test_preview(sample):
    got = g.preview(sample, 10, ["time", "lat", "lon"]).toPandas()
    assert len(got) == 10 and set(got["total_rows"]) == {1500}
    assert got["time"].iloc[0] == pd.Timestamp(dt.datetime(2020, 1, 1))


def test_chained_transforms(sample):
    out = g.chain(
        sample,
        [
            lambda d: g.bbox(d, lat_min=20, lat_max=40),
            lambda d: g.reduce_dims(d, ["lat", "lon"], value_columns=["air"]),
            lambda d: g.resample(d, "time", "MS"),
            lambda d: g.anomaly(d, "air", None),
            lambda d: g.rolling(d, "air", 2),
        ],
    )
    assert out.count() == 4 and out.columns == ["time", "air", "air_anomaly", "air_rolling_mean"]


def test_axes_table_and_chunks(spark, synthetic, data):
    axes = g.axes_table(synthetic, ["time", "lat", "lon"])
    grid = g.Grid(synthetic, axes=axes)
    assert grid.label_at("lon", -1) == 130.0 and grid.label_at("time", 1) == dt.datetime(2020, 1, 2)
    chunk = spark.createDataFrame([([0, 0], [2, 2], [1.0, 2.0, 3.0, float("nan")])], "origin array<int>, shape array<int>, values array<double>")
    small = g.Grid.from_chunks(chunk, {"lat": grid.axes["lat"], "lon": grid.axes["lon"]}, ["lat", "lon"], "v")
    assert {r[:] for r in small.table("v").collect()} == {(10.0, 100.0, 1.0), (10.0, 110.0, 2.0), (20.0, 100.0, 3.0), (20.0, 110.0, None)}


def test_schema_of_a_sample_keeps_the_whole_count(data):
    assert data.schema("pressure", limit=5)["__len__"] == 200


def test_coordinate_metadata(synthetic):
    assert g.coordinate_metadata(synthetic) == {"time": {}, "lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}}


def test_whole_dataset_forms(data):
    names = ["pressure", "temperature"]
    assert list(data.metadata()) == list(data.estimate_size()) == names
    assert list(data.schema()) == data.tables() and data.schema()["pressure"]["__len__"] == 200
    assert data.estimate_size()["pressure"] == data.estimate_size("pressure")
    assert data.metadata()["temperature"] == data.metadata("temperature")
