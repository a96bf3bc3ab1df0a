import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from graticule.session import scratch_dir
from tests.conftest import frame, rows


@pytest.fixture(scope="module")
def mixed(spark):
    pdf = pd.DataFrame(
        {
            "time": pd.to_datetime(["2020-01-01 06:00", "2020-01-02", "2020-01-03 12:30:15.25"], format="mixed"),
            "name": ["a,b", 'say "hi"', None],
            "v": [1.5, np.nan, -3.0],
        }
    )
    return frame(spark, pdf)


@pytest.mark.parametrize("fmt", ["csv", "tsv", "json", "jsonl", "parquet"])
def test_round_trip(spark, mixed, tmp_path, fmt):
    path = str(tmp_path / f"out.{fmt}")
    g.write_table(mixed, path, fmt)
    back = g.read_table(spark, path).select("time", "name", "v")
    assert back.schema["time"].dataType.simpleString() == "timestamp_ntz"
    pd.testing.assert_frame_equal(rows(back, "time"), rows(mixed, "time"))


def test_json_times_are_iso_and_missing_values_kept(spark, mixed, tmp_path):
    g.write_table(mixed.coalesce(1), str(tmp_path / "o"), "json")
    lines = [json.loads(x) for p in (tmp_path / "o").glob("*.json") for x in p.read_text().splitlines()]
    assert {x["time"] for x in lines} >= {"2020-01-01T06:00:00.000000"}
    assert all("v" in x for x in lines)


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[\n {"k": 1, "v": 2.5},\n {"k": 2, "v": 3.5}\n]')
    assert g.read_table(spark, str(path)).agg(F.sum("v")).first()[0] == 6.0


def test_nan_in_parquet_becomes_null(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    spark.createDataFrame(pd.DataFrame({"lat": [1.0, 2.0], "v": [np.nan, 1.0]})).write.parquet(path)
    assert g.read_table(spark, path).filter("v IS NULL").count() == 1


def test_no_numeric_column_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nx,y\n")
    with pytest.raises(ValueError, match="numeric"):
        g.read_table(spark, str(tmp_path / "t.csv"))


def test_unknown_format(mixed, tmp_path):
    with pytest.raises(ValueError, match="xlsx"):
        g.write_table(mixed, str(tmp_path / "x"), "xlsx")


def test_many_files_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("t,v\n1,2.0\n")
    (tmp_path / "2.csv").write_text("v,t,extra\n4.0,2,7\n")
    got = rows(g.read_many(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")]), "t")
    assert got["v"].tolist() == [2.0, 4.0] and np.isnan(got["extra"][0])
    (tmp_path / "2.csv").write_text("t,v\n2,4.0\n")
    assert g.read_many(spark, str(tmp_path / "*.csv")).count() == 2


def test_glob_of_several_headers(spark, tmp_path):
    for i, text in enumerate(["t,v,w\n1,2.0,5\n", "v,t,w\n4.0,2,6\n", "t,v\n3,6.0\n", "t,v,w\n4,8.0,7\n"]):
        (tmp_path / f"{i}.csv").write_text(text)
    got = rows(g.read_many(spark, str(tmp_path / "*.csv")), "t")
    assert got["t"].tolist() == [1, 2, 3, 4] and got["v"].tolist() == [2.0, 4.0, 6.0, 8.0]
    assert got["w"].isna().tolist() == [False, False, True, False]


def test_folder_without_extension_needs_a_format(spark, sample, tmp_path):
    sample.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="format"):
        g.read_table(spark, str(tmp_path / "plain"))
    assert g.read_table(spark, str(tmp_path / "plain"), "parquet").count() == sample.count()


def test_filters_reach_the_file_reader(spark, sample, tmp_path):
    path = str(tmp_path / "s.parquet")
    sample.write.parquet(path)
    df = g.read_table(spark, path)
    out = g.bbox(g.dim_slice(df, "time", "2020-02-01", "2020-03-01"), lat_min=20, lat_max=40)
    plan = g.profile(out, "air", "lat")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat,20.0)" in plan and "LessThanOrEqual(time,2020-03-01T00:00)" in plan
    assert "ReadSchema: struct<time:timestamp_ntz,lat:double,air:double>" in plan
    narrow = g.profile(df, "air", "lat")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lat:double,air:double>" in narrow


@pytest.mark.parametrize("limit", [100, 0])
def test_chunks_flatten_like_numpy(spark, limit):
    values = np.arange(5 * 4 * 6, dtype=float).reshape(5, 4, 6)
    values[2, 1, 3] = np.nan
    rows_ = []
    for t in range(0, 5, 2):
        for y in range(0, 4, 3):
            for x in range(0, 6, 4):
                part = values[t : t + 2, y : y + 3, x : x + 4]
                rows_.append(([t, y, x], list(part.shape), [float(f) for f in part.ravel()]))
    chunks = spark.createDataFrame(rows_, "origin array<int>, shape array<int>, values array<double>")
    axes = {
        "lat": spark.createDataFrame([(i, 10.0 * i) for i in range(4)], "idx int, label double"),
        "lon": spark.createDataFrame([(i, 100.0 - i) for i in range(6)], "idx int, label double"),
    }
    got = rows(g.flatten_chunks(chunks, axes, ["time", "lat", "lon"], "v", limit).orderBy("time", "lat", F.desc("lon")))
    assert len(got) == values.size
    np.testing.assert_array_equal(got["v"].astype(float).to_numpy(), values.ravel())
    assert got["lon"].tolist()[:6] == [100.0, 99.0, 98.0, 97.0, 96.0, 95.0]


def test_axis_of_a_long_axes_table(spark):
    axes = spark.createDataFrame([("lat", 0, 5.0), ("lon", 0, 7.0)], "dim string, idx int, coord_num double")
    assert g.axis_of(axes, "lat").collect()[0][:] == (0, 5.0)


def test_matrix_forms_agree(sample, sample_pdf):
    wide = rows(g.to_matrix(sample, "lat", "lon", "air", [100.0, 110.0, 120.0]), "lat")
    want = sample_pdf.pivot_table(index="lat", columns="lon", values="air")
    np.testing.assert_allclose(wide.drop(columns="lat"), want)
    arrays = rows(g.to_matrix(sample, "lat", "lon", "air"), "lat")
    np.testing.assert_allclose([[c["value"] for c in r] for r in arrays["cells"]], want)


def test_scratch_folder_is_stable_within_a_session(spark):
    assert scratch_dir(spark) == scratch_dir(spark)


@pytest.mark.parametrize("limit", [100, 0])
def test_positions_without_a_label_keep_their_cells(spark, limit):
    chunks = spark.createDataFrame([([0], [4], [1.0, 2.0, 3.0, 4.0])], "origin array<bigint>, shape array<bigint>, values array<double>")
    axis = spark.createDataFrame([(0, 10.0), (1, 20.0), (3, 40.0)], "idx int, label double")
    got = rows(g.flatten_chunks(chunks, {"lat": axis}, ["lat"], "v", limit), "v")
    assert got["lat"].fillna(-1).tolist() == [10.0, 20.0, -1.0, 40.0]


def test_long_axes(spark):
    chunks = spark.createDataFrame([([2**31 + 5], [2], [1.0, 2.0])], "origin array<bigint>, shape array<int>, values array<double>")
    assert rows(g.flatten_chunks(chunks, {}, ["x"], "v"), "v")["x"].tolist() == [2**31 + 5, 2**31 + 6]
