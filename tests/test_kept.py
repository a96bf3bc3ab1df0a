"""Sketches, pyramids, file indexes, many boxes and targets, calendar streams."""

from __future__ import annotations

import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from graticule.operators import percentile as pc
from graticule.operators import regions as rg
from tests.conftest import frame, long_table, rows


# ---- sketches ----


def spread(spark, n=60_000, parts=5):
    """Groups of very different sizes and shapes, with gaps and infinite values."""
    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": r.choice(["a", "b", "c", "d"], n, p=[0.7, 0.2, 0.0999, 0.0001]), "day": r.integers(0, 20, n), "v": r.gamma(0.5, 100.0, n)})
    pdf.loc[pdf["k"] == "b", "v"] = pdf["v"].round(-1)
    pdf.loc[r.random(n) < 0.05, "v"] = np.nan
    pdf.loc[pdf["k"] == "d", "v"] = np.nan
    pdf.loc[(pdf["k"] == "c") & (r.random(n) < 0.2), "v"] = np.inf
    pdf.loc[(pdf["k"] == "c") & (r.random(n) < 0.1), "v"] = -np.inf
    return pdf, frame(spark, pdf).repartition(parts).cache()


def test_sketches_merge_to_the_stated_error(spark):
    pdf, df = spread(spark)
    kept = g.quantile_sketches(df, "v", ["k", "day"])
    assert kept.count() == len(pdf.groupby(["k", "day"]))
    got = g.sketch_percentiles(kept.filter("day < 10"), "v", (0.0, 0.25, 0.5, 0.99, 1.0), ["k"])
    for row in got.collect():
        x = pdf[(pdf["k"] == row["k"]) & (pdf["day"] < 10)]["v"].dropna().to_numpy()
        assert row["n"] == len(x)
        for name, p in (("v_p0", 0.0), ("v_p25", 0.25), ("v_p50", 0.5), ("v_p99", 0.99), ("v_p100", 1.0)):
            if len(x):
                low, high = np.mean(x < row[name]), np.mean(x <= row[name])
                assert low - 2 * row["rank_error"] - 1 / len(x) <= p <= high + 2 * row["rank_error"] + 1 / len(x)
            else:
                assert row[name] is None


def test_sketches_per_file_and_bucket(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 1.0).alias("v"), F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("time"))
    for i in range(2):
        df.filter(F.col("v") % 2 == i).coalesce(1).write.parquet(str(tmp_path / f"f{i}.parquet"))
    back = spark.read.parquet(str(tmp_path / "f0.parquet"), str(tmp_path / "f1.parquet"))
    kept = g.quantile_sketches(back, "v", time="time", freq="MS", file="file")
    assert kept.count() == 2 * 4 and kept.columns[:2] == ["time", "file"]
    assert g.sketch_percentiles(kept, "v", (0.5,)).first()["v_p50"] in (49.0, 50.0)


@pytest.mark.parametrize("bracket", [2.0, 0.0, -0.5])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_bracketed_percentiles_are_exact(spark, monkeypatch, bracket, by):
    """Also with brackets that miss the wanted ranks, and values that repeat."""
    pdf, df = spread(spark)
    ps = (0.0, 0.1, 0.1003, 0.5, 0.999, 1.0)
    monkeypatch.setattr(pc, "BRACKET", bracket)
    got = rows(g.percentiles(df, "v", ps, by, max_group_rows=700), *by)
    want = rows(g.percentiles(df, "v", ps, by, max_group_rows=None), *by)
    pd.testing.assert_frame_equal(got, want)


def test_exact_from_kept_sketches_reads_once(spark, tmp_path, monkeypatch):
    _, df = spread(spark)
    df.write.parquet(str(tmp_path / "data"))
    back = spark.read.parquet(str(tmp_path / "data"))
    g.quantile_sketches(back, "v", ["k", "day"]).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    written = []
    keep = pc.materialize
    monkeypatch.setattr(pc, "materialize", lambda d, label: written.append(d) or keep(d, label))
    got = g.percentiles(back, "v", (0.1, 0.5), ["k"], max_group_rows=700, sketches=kept)
    assert len(written) == 1 and all(str(tmp_path / "data") in f for f in written[0].inputFiles() if "part-" in f and "kept" not in f)
    # what is left to compute reads the values kept, not the data
    assert not any(str(tmp_path / "data") in f for f in got.inputFiles())
    pd.testing.assert_frame_equal(rows(got, "k"), rows(g.percentiles(back, "v", (0.1, 0.5), ["k"], max_group_rows=None), "k"))


# ---- pyramid ----


@pytest.fixture(scope="module")
def hourly(spark):
    pdf = long_table(time=pd.date_range("2020-01-30", periods=400, freq="7h"), lat=np.arange(-60.0, 61.0, 15.0), lon=np.arange(-170.0, 171.0, 20.0))
    r = np.random.default_rng(5)
    pdf["t"], pdf["p"] = r.normal(280, 10, len(pdf)), r.normal(1000, 5, len(pdf))
    pdf.loc[r.random(len(pdf)) < 0.1, "t"] = np.nan
    return pdf, frame(spark, pdf).cache()


def binned(pdf, var, width, how="mean"):
    out = pdf.assign(lat=np.floor(pdf["lat"] / width) * width, lon=np.floor(pdf["lon"] / width) * width)
    return getattr(out.groupby(["lat", "lon"])[var], how)().reset_index()


def same_map(got, want, var):
    got = rows(got, "lat", "lon")
    assert len(got) == len(want)
    np.testing.assert_allclose(got[["lat", "lon", var]].to_numpy(float), want[["lat", "lon", var]].to_numpy(float))


def test_pyramid_levels(spark, hourly, tmp_path):
    pdf, df = hourly
    p = g.Pyramid.build(df, str(tmp_path / "p"), ["t", "p"], levels=4, time="time", widths=(20.0, 20.0))
    for level in range(4):
        for how in ("mean", "min", "max", "count", "sum"):
            same_map(p.map("t", level, how), binned(pdf, "t", 20.0 * 2**level, how), "t")
    again = g.Pyramid(spark, str(tmp_path / "p"))
    assert again.spec == p.spec
    assert p.level_for(20) == 2 and p.level_for("full") == 0 and p.level_for(1) == 3
    with pytest.raises(ValueError):
        p.map("t", 4)
    with pytest.raises(ValueError):
        p.map("q")


def test_pyramid_has_the_bins_of_a_map(spark, hourly, tmp_path):
    _, df = hourly
    p = g.Pyramid.build(df, str(tmp_path / "p"), ["t"], target=40, levels=2)
    want = rows(g.map_mean(df, "t", target=40), "lat", "lon")
    same_map(p.map("t"), want, "t")


def test_pyramid_ranges_read_whole_periods_only_from_it(spark, hourly, tmp_path):
    pdf, df = hourly
    df.write.parquet(str(tmp_path / "data"))
    back = spark.read.parquet(str(tmp_path / "data"))
    p = g.Pyramid.build(back, str(tmp_path / "p"), ["t"], levels=2, time="time", widths=(20.0, 20.0))
    aligned = p.map("t", 1, start="2020-02-01", end="2020-04-01")
    files = aligned.inputFiles()
    assert files and not any("data" in f.removeprefix("file://").removeprefix(str(tmp_path)).split("/")[1] for f in files)
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "p20200201000000" in plan
    kept = p.sums(1, "2020-02-01", "2020-04-01").select("period").distinct().collect()
    assert {r["period"] for r in kept} == {"p20200201000000", "p20200301000000"}
    for a, b in [("2020-02-01", "2020-04-01"), ("2020-02-03 05:00:00", "2020-04-20"), ("2020-03-05", "2020-03-06"), (None, "2020-03-10"), ("2020-05-06", None), ("2020-01-01", "2021-01-01"), ("2021-01-01", "2021-03-05")]:
        inside = pdf[(pdf["time"] >= (a or "1900-01-01")) & (pdf["time"] < (b or "2100-01-01"))]
        same_map(p.map("t", 1, start=a, end=b, df=back), binned(inside, "t", 40.0), "t")
    with pytest.raises(ValueError, match="inside a period"):
        p.map("t", start="2020-02-03")


def test_pyramid_refresh_touches_named_periods(spark, hourly, tmp_path):
    pdf, df = hourly
    p = g.Pyramid.build(df, str(tmp_path / "p"), ["t"], levels=3, time="time", widths=(20.0, 20.0))
    others = {f: os.path.getmtime(f) for f in glob.glob(str(tmp_path / "p/level-*/period=p20200401*/*.parquet"))}
    assert others
    changed = df.filter("time < '2020-03-01' OR time >= '2020-03-20'").withColumn("t", F.when(F.col("time") >= F.lit("2020-03-20").cast("timestamp_ntz"), 1.0).otherwise(F.col("t")))
    p.refresh(changed, ["2020-03-25"])
    assert {f: os.path.getmtime(f) for f in others} == others
    want = pdf[(pdf["time"] < "2020-03-01") | (pdf["time"] >= "2020-03-20")].copy()
    march = (want["time"] >= "2020-03-01") & (want["time"] < "2020-04-01")
    want.loc[march, "t"] = 1.0
    same_map(p.map("t", 2), binned(want, "t", 80.0), "t")
    # a period that has lost all its rows
    p.refresh(df.filter("time < '2020-03-01' OR time >= '2020-04-01'"), ["2020-03-01"])
    same_map(p.map("t", 1, "count"), binned(pdf[(pdf["time"] < "2020-03-01") | (pdf["time"] >= "2020-04-01")], "t", 40.0, "count"), "t")


def test_pyramid_keys_and_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, 0.0, "a", 5.0), (1.0, None, "a", 7.0), (None, 0.0, "b", 9.0), (-0.5, -0.5, "b", None), (-0.5, -0.25, None, 3.0)], "lat double, lon double, k string, v double"
    )
    p = g.Pyramid.build(df, str(tmp_path / "p"), ["v"], levels=2, keys=["k"], widths=(1.0, 1.0))
    got = {tuple(x) for x in p.map("v", 0, by=["k"]).collect()}
    assert got == {("a", 1.0, 0.0, 5.0), ("b", -1.0, -1.0, None), (None, -1.0, -1.0, 3.0)}
    assert {tuple(x) for x in p.map("v", 1, "count").collect()} == {(0.0, 0.0, 1), (-2.0, -2.0, 1)}
    assert p.map("v", where=F.col("k") == "a").count() == 1
    empty = g.Pyramid.build(df.limit(0), str(tmp_path / "e"), ["v"], widths=(1.0, 1.0))
    assert empty.map("v", 1).collect() == []


# ---- file index ----


@pytest.fixture
def folder(spark, tmp_path):
    """Daily rows: files 0-9, 10-19, 15-24 (overlaps), 40-49 (after a gap), 42-45 (inside), and one without rows."""
    place = str(tmp_path / "files")
    for i, (a, b) in enumerate([(0, 10), (10, 20), (15, 25), (40, 50), (42, 46)]):
        days = spark.range(a, b).select(F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("time"), (F.col("id") * 1.5).alias("v"), F.lit(i).alias("lat"))
        days.coalesce(1).write.parquet(f"{place}/{i}")
    return place


def test_index_and_continuity(spark, folder):
    index = g.index_files(spark, [f"{folder}/{i}" for i in range(5)], ["time", "lat"], "parquet")
    found = index.orderBy("lat_min").collect()
    assert [(x["rows"], x["lat_min"], x["lat_max"], x["time_nulls"]) for x in found] == [(n, i, i, 0) for i, n in enumerate([10, 10, 10, 10, 4])]
    swept = g.time_continuity(index, "time", 86_400).orderBy("start").toPandas()
    assert swept["gap_seconds"].tolist() == [0, 0, 0, 16 * 86_400.0, 0]
    assert swept["overlap_seconds"].tolist() == [0, 0, 4 * 86_400.0, 0, 3 * 86_400.0]
    assert pd.isna(swept["covered_until"][0]) and swept["covered_until"][4] == pd.Timestamp("2020-02-19")


def test_changed_files_only_are_read_again(spark, folder, monkeypatch):
    from graticule.sources import index as ix

    index = g.index_files(spark, f"{folder}/*", ["time"], "parquet")
    kept = spark.createDataFrame(index.collect(), index.schema)
    read = []
    real = ix.read_many
    monkeypatch.setattr(ix, "read_many", lambda s, paths, fmt=None: read.append(list(paths)) or real(s, paths, fmt))
    assert g.index_files(spark, f"{folder}/*", ["time"], "parquet", known=kept).count() == 5 and read == []
    spark.range(100, 103).select(F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("time"), F.lit(1.0).alias("v"), F.lit(9).alias("lat")).coalesce(1).write.parquet(f"{folder}/9")
    again = g.index_files(spark, f"{folder}/*", ["time"], "parquet", known=kept)
    again = spark.createDataFrame(again.collect(), index.schema)
    assert again.count() == 6 and len(read) == 1 and len(read[0]) == 1
    spark.range(5).select(F.expr("timestamp_ntz'2019-01-01' + make_dt_interval(id)").alias("time"), F.lit(1.0).alias("v"), F.lit(9).alias("lat")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/0")
    again = g.index_files(spark, f"{folder}/*", ["time"], "parquet", known=again)
    assert again.count() == 6 and str(again.agg(F.min("time_min")).first()[0]) == "2019-01-01 00:00:00"


def test_only_files_that_can_hold_rows_are_opened(spark, folder):
    index = g.index_files(spark, f"{folder}/*", ["time", "v"], "parquet")
    got = g.read_ranges(spark, index, {"time": ("2020-01-18", "2020-02-11"), "v": (24.0, None)})
    assert len(got.inputFiles()) == 3
    assert sorted(x["v"] for x in got.collect()) == sorted([1.5 * i for i in (17, 18, 19, 17, 18, 19, 20, 21, 22, 23, 24, 40, 41)])
    none = g.read_ranges(spark, index, {"time": ("2030-01-01", None)})
    assert none.columns == ["time", "v", "lat"] and none.count() == 0


# ---- many boxes ----


@pytest.mark.parametrize("split", [8, 2])
def test_many_boxes(spark, monkeypatch, split):
    r = np.random.default_rng(2)
    pdf = pd.DataFrame({"lat": r.uniform(-90, 90, 4000).round(1), "lon": r.uniform(-180, 180, 4000).round(1), "v": r.normal(1e6, 1.0, 4000)})
    pdf.loc[::17, "v"] = np.nan
    y, x = r.uniform(-100, 100, 300).round(1), r.uniform(-200, 200, 300).round(1)
    boxes = pd.DataFrame({"region": np.arange(300), "lat_min": y, "lat_max": y + r.choice([-1.0, 0.0, 0.4, 5.0, 60.0], 300), "lon_min": x, "lon_max": x + r.choice([0.1, 3.0, 50.0, 400.0], 300)})
    boxes.loc[0, ["lat_min", "lat_max", "lon_min", "lon_max"]] = [-np.inf, np.inf, -np.inf, np.inf]
    boxes.loc[1, "lat_min"] = np.nan
    boxes.loc[2, ["region"]] = 3
    monkeypatch.setattr(rg, "SPLIT", split)
    got = rows(g.region_stats_many(frame(spark, pdf), "v", spark.createDataFrame(boxes.astype(object).where(boxes.notna(), None).values.tolist(), "region long, lat_min double, lat_max double, lon_min double, lon_max double")), "region", "count")
    want = []
    for b in boxes.itertuples():
        v = pdf[pdf["lat"].between(b.lat_min, b.lat_max) & pdf["lon"].between(b.lon_min, b.lon_max)]["v"].dropna()
        want.append((b.region, len(v), v.mean(), v.std(), v.min(), v.max()))
    want = pd.DataFrame(want, columns=got.columns).sort_values(["region", "count"], ignore_index=True)
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), rtol=1e-9)


def test_plan_does_not_grow_with_boxes(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "lat double, lon double, v double")
    sizes = []
    for n in (2, 500):
        boxes = spark.range(n).selectExpr("id AS region", "0D AS lat_min", "2D AS lat_max", "CAST(id AS double) - 3 AS lon_min", "5D AS lon_max")
        out = g.region_stats_many(df, "v", boxes)
        sizes.append(out._jdf.queryExecution().analyzed().toString().count("\n"))
        assert out.agg(F.sum("count")).first()[0] == min(n, 6)
    assert sizes[0] == sizes[1]
    assert g.region_stats_many(df.limit(0), "v", boxes.limit(3)).select("count").collect() == [(0,)] * 3


# ---- many targets ----


def test_nearest_labels(spark):
    r = np.random.default_rng(1)
    labels = np.unique(r.integers(-50, 50, 40) * 1.0)
    targets = np.concatenate([r.integers(-300, 300, 200) / 4.0, [1e9, -1e9]])
    got = g.nearest_labels(spark.createDataFrame([(float(x),) for x in labels] + [(None,)], "x double"), spark.createDataFrame([(float(x),) for x in targets] + [(None,)], "x double"), "x")
    found = {x["target"]: x["label"] for x in got.collect()}
    assert found == {t: min(labels, key=lambda z: (abs(z - t), z)) for t in set(targets)}
    assert g.nearest_labels(spark.createDataFrame([], "x double"), spark.createDataFrame([(1.0,)], "x double"), "x").collect() == []


def test_nearest_frame_by_time_and_place(spark, sample, sample_pdf):
    wanted = pd.DataFrame({"station": ["a", "b", "c"], "when": pd.to_datetime(["2020-01-05 11:00", "2020-01-05 12:00", "2021-01-01 00:00"]), "lat": [14.9, 15.0, 99.0]})
    got = rows(g.nearest_frame(sample, frame(spark, wanted), {"when": "time", "lat": "lat"}), "station", "lon")
    assert set(got.columns) == {"when", "lat", "station", "nearest_time", "nearest_lat", "lon", "air"}
    assert got["nearest_time"].tolist() == [pd.Timestamp("2020-01-05")] * 6 + [pd.Timestamp("2020-04-09")] * 3
    assert got["nearest_lat"].tolist() == [10.0] * 6 + [50.0] * 3
    want = sample_pdf[(sample_pdf["time"] == "2020-01-05") & (sample_pdf["lat"] == 10.0)].sort_values("lon")["air"].tolist()
    np.testing.assert_allclose(got["air"][:3], want)


# ---- distinct values ----


def test_column_sketches(spark):
    df = spark.range(20_000).selectExpr("id", "id % 7 AS k", "CAST(id % 100 AS double) AS x", "CAST(NULL AS string) AS nothing", "timestamp_ntz'2020-01-01' + make_dt_interval(id % 3000) AS t", "id % 2 = 0 AS b")
    found = {r["column"]: r for r in g.column_report_approx(df).collect()}
    exact = {r["column"]: r for r in g.column_report(df).collect()}
    for name, want in exact.items():
        assert (found[name]["dtype"], found[name]["total"], found[name]["non_null"]) == (want["dtype"], want["total"], want["non_null"])
        assert abs(found[name]["unique_values"] - want["unique_values"]) <= 4 * found[name]["relative_error"] * want["unique_values"]
    kept = g.column_sketches(df, ["k"])
    both = {r["column"]: r["unique_values"] for r in g.merged_report(kept.filter("k < 2")).collect()}
    assert abs(both["id"] - 5715) < 200 and both["x"] == 100 and both["nothing"] == 0
    plan = g.column_report_approx(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 20000") == 1


# ---- reductions, slices, bands ----


def test_array_reductions(spark):
    pdf = pd.DataFrame({"time": [1, 2, 3, 1, 2, 3, 1, 2], "lat": [0, 0, 0, 1, 1, 1, 2, 2], "v": [2.0, -3.0, np.nan, 0.0, 5.0, 4.0, np.nan, np.nan]})
    data = g.Grid(frame(spark, pdf), ["time", "lat"])

    def got(method):
        return [None if x is None or x != x else x for x in rows(data.reduce("v", "time", method), "lat")["v"]]

    assert got("prod") == [-6.0, 0.0, 1.0]
    assert got("first") == [2.0, 0.0, None] and got("last") == [-3.0, 4.0, None]
    # a missing value counts as true, as in arrays
    assert got("any") == [True, True, True] and got("all") == [True, False, True]
    with pytest.raises(ValueError):
        data.reduce("v", "time", "mode")


def test_array_resampling_by_order(spark, sample, sample_pdf):
    data = g.Grid(sample, ["time", "lat", "lon"])
    cells = sample_pdf.set_index("time").groupby(["lat", "lon"])["air"]
    for method in ("first", "last", "prod"):
        got = rows(data.resample("air", "MS", method), "lat", "lon", "time")
        want = getattr(cells.resample("MS"), method)().reset_index().sort_values(["lat", "lon", "time"])
        np.testing.assert_allclose(got["air"], want["air"])


@pytest.mark.parametrize("where", [slice(0, None, 3), slice(1, 90, 7), slice(-20, -1, 2), slice(5, 5, 2)])
def test_stepped_slices_without_an_axes_table(sample, sample_pdf, where):
    got = g.isel(g.Grid(sample, ["time", "lat", "lon"]), time=where)
    want = np.sort(sample_pdf["time"].unique())[where]
    assert sorted(x["time"] for x in got.select("time").distinct().collect()) == [pd.Timestamp(t).to_pydatetime() for t in want]


def test_deep_positions(sample, sample_pdf, monkeypatch):
    from graticule.plans import grid as gr

    monkeypatch.setattr(gr, "DEEP", 3)
    data, steps = g.Grid(sample, ["time", "lat", "lon"]), np.sort(sample_pdf["time"].unique())
    for i in (0, 3, 4, 99, -1, -4, -5, -100):
        assert data.label_at("time", i) == pd.Timestamp(steps[i]).to_pydatetime()
    for i in (100, -101):
        with pytest.raises(IndexError):
            data.label_at("time", i)


def test_bands_leave_others_out(spark):
    df = spark.createDataFrame([(float(y), float(y)) for y in range(-90, 91, 10)], "lat double, v double")
    got = {r["zone"]: (r["min"], r["max"], r["count"]) for r in g.band_stats(df, "v", [(60, 90, "north"), (-20, 20, "tropics"), (0, 30, "half")]).collect()}
    assert got == {"north": (60.0, 90.0, 4), "tropics": (-20.0, 10.0, 4), "half": (20.0, 20.0, 1)}


# ---- streams ----


def streamed(spark, files, freq, method, tmp_path, delay="2 days", groups=("k",), close="2021-12-31"):
    schema = "t timestamp_ntz, k string, v double"
    place = str(tmp_path / "in")
    for part in files:
        spark.createDataFrame([(pd.Timestamp(t).to_pydatetime(), k, v) for t, k, v in part], schema).coalesce(1).write.mode("append").parquet(place)
    source = spark.read.schema(schema).parquet(place).schema
    if close:
        g.close_stream(spark, place, source, "t", close)
    stream = spark.readStream.schema(source).option("maxFilesPerTrigger", 1).parquet(place)
    out = g.resample_stream(stream, "t", freq, method, ["v"], delay, groups)
    run = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    run.awaitTermination()
    dropped = sum(int(op["numRowsDroppedByWatermark"]) for p in run.recentProgress for op in p["stateOperators"])
    return spark.read.schema(out.schema).parquet(str(tmp_path / "o")), dropped


FILES = [
    [("2020-01-05", "a", 1.0), ("2020-01-31 23:59:59", "a", 2.0), ("2020-01-20", "b", 5.0), ("2020-01-21", None, 9.0)],
    [("2020-02-01", "a", 3.0), ("2020-02-02", "a", 4.0)],
    # January is open: its end is not two days back
    [("2020-01-02", "a", 10.0), ("2020-02-03 01:00", "a", 5.0)],
    [("2020-03-01", "a", 7.0)],
    # January is closed, February is not, however late its rows are
    [("2020-01-03", "a", 100.0), ("2020-02-01", "b", 8.0)],
    [("2020-03-10", "b", None)],
    [("2020-04-20", "a", 1.0)],
]


@pytest.mark.parametrize("freq, ends", [("MS", ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01"]), ("ME", ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"])])
def test_months_in_streams(spark, tmp_path, freq, ends):
    out, dropped = streamed(spark, FILES, freq, "sum", tmp_path)
    got = {(r["k"], str(r["t"])[:10]): r["v"] for r in out.collect()}
    jan, feb, mar, apr = ends
    assert got == {("a", jan): 13.0, ("b", jan): 5.0, ("a", feb): 12.0, ("b", feb): 8.0, ("a", mar): 7.0, ("b", mar): 0.0, ("a", apr): 1.0}
    assert dropped >= 1


def test_open_buckets_are_not_written(spark, tmp_path):
    out, _ = streamed(spark, FILES, "MS", "sum", tmp_path, close=None)
    assert {str(r["t"])[:10] for r in out.collect()} == {"2020-01-01", "2020-02-01", "2020-03-01"}


@pytest.mark.parametrize("freq", ["W-WED", "QS", "6h"])
def test_streams_give_the_rows_of_tables(spark, tmp_path, freq):
    r = np.random.default_rng(4)
    when = pd.Timestamp("2019-12-28") + pd.to_timedelta(np.sort(r.integers(0, 200 * 86_400, 300)), unit="s")
    given = [(str(t), str(k), float(v)) for t, k, v in zip(when, r.integers(0, 3, 300), r.normal(size=300))]
    out, dropped = streamed(spark, [given[i * 75 : (i + 1) * 75] for i in range(4)], freq, "mean", tmp_path, "1 hour")
    table = spark.createDataFrame([(pd.Timestamp(t).to_pydatetime(), k, v) for t, k, v in given], "t timestamp_ntz, k string, v double")
    want = rows(g.resample(table, "t", freq, "mean", ["k"], ["v"], fill_gaps=False), "k", "t")
    pd.testing.assert_frame_equal(rows(out, "k", "t")[["k", "t", "v"]], want[["k", "t", "v"]])
    assert dropped == 0


def test_streams_need_an_origin(spark):
    df = spark.createDataFrame([(1.0,)], "v double").selectExpr("timestamp_ntz'2020-01-04' AS t", "v")
    with pytest.raises(ValueError, match="origin"):
        g.resample_stream(df, "t", "2D", "sum", ["v"])
    assert str(g.resample_stream(df, "t", "2D", "sum", ["v"], origin="2020-01-01").first()["t"]) == "2020-01-03 00:00:00"


# ---- windows longer than a task, stable trends ----


@pytest.mark.parametrize("center, method, by", [(False, "mean", []), (True, "sum", ["k"]), (True, "std", []), (False, "min", ["k"]), (True, "max", []), (False, "median", ["k"])])
def test_windows_longer_than_a_block(spark, method, center, by):
    r = np.random.default_rng(6)
    pdf = pd.DataFrame({"k": r.choice(["a", "b", "c"], 400, p=[0.8, 0.19, 0.01]), "t": r.permutation(400), "v": r.normal(1e5, 3, 400)})
    pdf.loc[r.random(400) < 0.2, "v"] = np.nan
    df = frame(spark, pdf)
    for window, block in ((57, 10), (5000, 50)):
        got = rows(g.rolling(df, "v", window, method, center, 3, "t", by, "out", max_group_rows=block), "t")
        sort = pdf.sort_values("t").set_index("t")
        roll = lambda x: getattr(x.rolling(window, min_periods=3, center=center), method)()
        want = sort.groupby("k")["v"].transform(roll) if by else roll(sort["v"])
        np.testing.assert_allclose(got["out"].to_numpy(float), want.to_numpy(float), rtol=1e-7)


def test_trends_of_high_degree(spark):
    """A century of hours on a large value, and a short series at its end."""
    n = 20_000
    t = np.sort(np.random.default_rng(1).integers(0, 100 * 365 * 24, n))
    u = t / t.max() * 2 - 1
    v = 1e6 + 5 * u - 3 * u**2 + 40 * u**3 + 9 * u**5 - 20 * u**6 + np.random.default_rng(2).normal(size=n)
    pdf = pd.DataFrame({"time": pd.Timestamp("1900-01-01") + pd.to_timedelta(t, unit="h"), "k": np.where(t > t.max() - 3000, "late", "rest"), "v": v})
    df = frame(spark, pdf)
    x = (pdf["time"] - pd.Timestamp("1970-01-01")) / pd.Timedelta(days=1)
    got = rows(g.trend(df, "v", 6), "time", "v")
    want = pd.Series(np.polynomial.Polynomial.fit(x, pdf["v"], 6)(x.to_numpy()))
    order = pdf.sort_values(["time", "v"]).index
    np.testing.assert_allclose(got["v_trend"], want[order], rtol=0, atol=1e-6)
    got = rows(g.trend(df, "v", 6, by=["k"]), "time", "v")
    for k, part in pdf.groupby("k"):
        want.loc[part.index] = np.polynomial.Polynomial.fit(x[part.index], part["v"], 6)(x[part.index].to_numpy())
    np.testing.assert_allclose(got["v_trend"], want[order], rtol=0, atol=1e-6)


def test_nearest_frame_summary_makes_no_pairs(spark, sample, sample_pdf):
    """Aggregates of the rows at each target's label, one row per target row (repeated ones too), not one per pair."""
    from pyspark.sql import functions as F

    wanted = pd.DataFrame({"station": [1, 1, 2, 3], "lat": [12.0, 12.0, 44.0, None]})
    targets = frame(spark, wanted)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("air").alias("total")]
    got = g.nearest_frame(sample, targets, ["lat"], summary=sums)
    assert got.columns == ["lat", "station", "nearest_lat", "n", "total"] or set(got.columns) == {"lat", "station", "nearest_lat", "n", "total"}
    each = g.nearest_frame(sample, targets, ["lat"]).groupBy("station", "lat", "nearest_lat").agg(F.count(F.lit(1)).alias("n"), F.sum("air").alias("total"))
    assert got.count() == 3 and each.agg(F.sum("n")).first()[0] == 900
    merged = rows(got.groupBy("station", "lat", "nearest_lat").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "station")
    pd.testing.assert_frame_equal(merged, rows(each, "station"), rtol=1e-9)
