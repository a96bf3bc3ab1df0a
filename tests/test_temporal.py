import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from tests.conftest import frame, rows

METHODS = ["mean", "sum", "std", "min", "max", "median", "count"]


@pytest.fixture(scope="module")
def uneven_pdf():
    """Gaps of weeks, a Sunday midnight, a late Sunday and a Monday midnight."""
    t = ["2020-01-05 00:00", "2020-01-05 23:30", "2020-01-06 00:00", "2020-01-08", "2020-02-20", "2020-05-01 12:00"]
    return pd.DataFrame({"time": pd.to_datetime(t, format="mixed"), "v": [1.0, 2.0, np.nan, 4.0, 8.0, 16.0], "n": [1, 2, 3, 4, 5, 6]})


@pytest.mark.parametrize("freq", ["D", "W", "MS", "QS", "YS", "h"])
@pytest.mark.parametrize("method", ["mean", "sum", "count"])
def test_resample_matches_pandas(spark, uneven_pdf, freq, method):
    got = rows(g.resample(frame(spark, uneven_pdf), "time", freq, method), "time")
    want = uneven_pdf.resample(freq, on="time")[["v", "n"]].agg(method).reset_index()
    assert got["time"].tolist() == want["time"].tolist()
    for c in ("v", "n"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float))


@pytest.mark.parametrize("method", METHODS)
def test_resample_methods(spark, uneven_pdf, method):
    got = rows(g.resample(frame(spark, uneven_pdf), "time", "MS", method, values=["v"]), "time")
    want = uneven_pdf.resample("MS", on="time")[["v"]].agg(method).reset_index()
    np.testing.assert_allclose(got["v"].astype(float), want["v"].astype(float))


@pytest.mark.parametrize("method", ["mean", "sum", "median"])
def test_resample_groups_span_their_own_buckets(spark, uneven_pdf, method):
    pdf = pd.concat([uneven_pdf.assign(k="a"), uneven_pdf.iloc[2:5].assign(k="b")])
    got = rows(g.resample(frame(spark, pdf), "time", "W", method, ["k"], ["v"]), "k", "time")
    want = pdf.groupby(["k"]).resample("W", on="time")[["v"]].agg(method).reset_index()
    assert got[["k", "time"]].equals(want[["k", "time"]].astype(got[["k", "time"]].dtypes.to_dict()))
    np.testing.assert_allclose(got["v"].astype(float), want["v"].astype(float))


def test_resample_ignores_missing_times_and_keys(spark):
    pdf = pd.DataFrame({"time": [pd.Timestamp("2020-01-01"), pd.NaT], "k": ["a", "a"], "v": [1.0, 2.0]})
    assert g.resample(frame(spark, pdf), "time", "D", "sum").collect()[0].v == 1.0
    assert g.resample(frame(spark, pdf.assign(k=None).astype({"k": "object"}).assign(k=[None, "a"])), "time", "D", "mean", ["k"]).count() == 0


def test_resample_edges(sample, spark):
    assert g.resample(sample, "nope") is sample
    assert g.resample(sample.filter("lat > 900"), "time", "MS").count() == 0
    with pytest.raises(ValueError, match="fortnight"):
        g.resample(sample, "time", "fortnight")
    text = spark.createDataFrame([("2020-01-01", 1.0), ("2020-01-03", 3.0)], "time string, v double")
    assert g.resample(text, "time", "D").count() == 3


def test_resample_same_for_any_partitioning(spark, sample):
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(g.resample(sample, "time", "W", "mean", ["lat"], ["air"]).withColumn("air", F.round("air", 8)), "lat", "time"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0].equals(results[1])


def test_grid_resample_shares_one_axis(spark):
    pdf = pd.DataFrame(
        {
            "time": pd.to_datetime(["2020-01-01", "2020-03-02", "2020-02-01"]),
            "lat": [1.0, 1.0, 2.0],
            "v": [1.0, 3.0, np.nan],
        }
    )
    got = rows(g.grid_resample(frame(spark, pdf), "v", "MS", "mean"), "lat", "time")
    assert len(got) == 6
    assert got["v"].fillna(-1).tolist() == [1.0, -1, 3.0, -1, -1, -1]
    assert g.grid_resample(frame(spark, pdf).drop("lat"), "v", "MS", "std").count() == 3
    with pytest.raises(ValueError):
        g.grid_resample(frame(spark, pdf), "v", "MS", "mode")


@pytest.mark.parametrize("groupby", ["month", "dayofyear", "season", "hour", None])
def test_anomaly_matches_pandas(sample, sample_pdf, groupby):
    t = sample_pdf["time"].dt
    key = {
        "month": t.month, "dayofyear": t.dayofyear, "hour": t.hour,
        "season": (t.month % 12 + 3) // 3, None: pd.Series(1, sample_pdf.index),
    }[groupby]
    want = sample_pdf["air"] - sample_pdf.groupby(key)["air"].transform("mean")
    got = rows(g.anomaly(sample, "air", groupby), "time", "lat", "lon")
    np.testing.assert_allclose(got["air_anomaly"], want, atol=1e-9)
    assert abs(got["air_anomaly"].mean()) < 1e-10
    clim = rows(g.climatology(sample, "air", groupby), "time", "lat", "lon")
    np.testing.assert_allclose(clim["air_climatology"], sample_pdf["air"] - want)


def test_anomaly_edges(sample, spark):
    assert g.anomaly(sample, "nope") is sample
    no_time = g.anomaly(sample.drop("time"), "air")
    assert abs(no_time.agg(F.avg("air_anomaly")).first()[0]) < 1e-10
    pdf = pd.DataFrame({"time": [pd.Timestamp("2020-01-01"), pd.NaT], "v": [1.0, 2.0]})
    got = rows(g.anomaly(frame(spark, pdf), "v"), "v")
    assert got["v_anomaly"].isna().tolist() == [False, True]
    with pytest.raises(ValueError):
        g.anomaly(sample, "air", "decade")


def test_climatology_table_names_months(sample):
    got = g.climatology_table(sample, "air").toPandas()
    assert got["month_name"].tolist() == ["Jan", "Feb", "Mar", "Apr"]


@pytest.mark.parametrize("degree", [1, 2, 5])
def test_trend_matches_polyfit(sample, sample_pdf, degree):
    got = rows(g.trend(sample, "air", degree), "time", "lat", "lon")
    x = sample_pdf["time"].astype("datetime64[ns]").astype("int64") / 86400e9
    x = x - x.mean()
    want = np.polyval(np.polyfit(x, sample_pdf["air"], degree), x)
    np.testing.assert_allclose(got["air_trend"], want, rtol=1e-8)
    np.testing.assert_allclose(got["air_detrended"], sample_pdf["air"] - want, atol=1e-5)


@pytest.mark.parametrize("degree", [1, 3])
def test_trend_by_group(sample, sample_pdf, degree):
    got = rows(g.trend(sample, "air", degree, by=["lat"]), "time", "lat", "lon")
    for lat, part in sample_pdf.groupby("lat"):
        x = (part["time"] - part["time"].mean()).dt.total_seconds() / 86400
        want = np.polyval(np.polyfit(x, part["air"], degree), x)
        np.testing.assert_allclose(got[got["lat"] == lat]["air_trend"], want, rtol=1e-7)


def test_trend_missing_values_and_single_step(spark):
    pdf = pd.DataFrame({"time": pd.to_datetime(["2020-01-01", "2020-01-02", "2020-01-04", None]), "v": [1.0, np.nan, 7.0, 5.0]})
    got = g.trend(frame(spark, pdf), "v").toPandas()
    assert got["v_trend"].round(9).tolist()[:3] == [1.0, 3.0, 7.0]
    assert got["v_trend"].isna().tolist()[3] and got["v_detrended"].isna().tolist() == [False, True, False, True]
    one = g.trend(frame(spark, pdf.iloc[:1]), "v").first()
    assert one.v_trend == 1.0 and one.v_detrended == 0.0


def test_climate_series_adds_trend_and_anomaly(sample):
    out = g.climate_series(sample, "air")
    assert out.columns == ["time", "air", "air_trend", "air_detrended", "air_anomaly"]
    assert out.count() == 4


@pytest.fixture(scope="module")
def series_pdf():
    rng = np.random.RandomState(1)
    v = rng.normal(size=300)
    v[rng.rand(300) < 0.2] = np.nan
    v[40:52] = np.nan
    return pd.DataFrame({"time": pd.date_range("2020-01-01", periods=300, freq="h"), "v": v})


ROLLS = [
    ("mean", 1, False, 1), ("mean", 4, True, 1), ("mean", 30, False, 1), ("mean", 30, True, 1),
    ("sum", 4, False, 1), ("sum", 7, True, 3), ("std", 7, False, 3), ("std", 4, True, 1),
    ("min", 7, False, 3), ("max", 4, False, 1), ("median", 7, False, 3), ("median", 4, True, 1),
]


@pytest.mark.parametrize("blocks", [False, True])
@pytest.mark.parametrize("method, window, center, min_periods", ROLLS)
def test_rolling_matches_pandas(spark, series_pdf, method, window, min_periods, center, blocks):
    more = {"max_group_rows": 32} if blocks else {}
    got = rows(
        g.rolling(frame(spark, series_pdf).repartition(5), "v", window, method, center, min_periods, **more), "time"
    )
    want = getattr(series_pdf["v"].rolling(window, center=center, min_periods=min_periods), method)()
    np.testing.assert_allclose(got[f"v_rolling_{method}"].astype(float), want, atol=1e-9)


def test_rolling_window_longer_than_the_series(spark):
    pdf = pd.DataFrame({"time": pd.date_range("2020-01-01", periods=3), "v": [1.0, 2.0, 3.0]})
    got = rows(g.rolling(frame(spark, pdf), "v", 10, "sum", output_column="s", max_group_rows=1), "time")
    assert got["s"].tolist() == [1.0, 3.0, 6.0]


@pytest.mark.parametrize("limit", [10_000, 40])
def test_rolling_groups_with_one_hot_group(spark, limit):
    rng = np.random.RandomState(2)
    pdf = pd.DataFrame({"k": rng.choice(["hot"] * 6 + ["a", "b"], 400), "t": range(400), "v": rng.normal(size=400)})
    got = rows(g.rolling(frame(spark, pdf), "v", 5, "mean", order_by="t", partition_by=["k"], max_group_rows=limit), "t")
    want = pdf.groupby("k")["v"].rolling(5, min_periods=1).mean().droplevel(0).sort_index()
    np.testing.assert_allclose(got["v_rolling_mean"], want)


def test_rolling_blocks_with_one_repeated_key(spark):
    pdf = pd.DataFrame({"t": [1] * 200 + [2] * 10, "v": [1.0] * 200 + [3.0] * 10})
    out = g.rolling(frame(spark, pdf), "v", 4, "sum", order_by="t", max_group_rows=16).toPandas()
    assert len(out) == 210 and out["v_rolling_sum"].value_counts()[4.0] == 197


def test_rolling_edges(sample):
    assert g.rolling(sample, "nope") is sample
    with pytest.raises(ValueError):
        g.rolling(sample, "air", 7, "mode")
    with pytest.raises(ValueError):
        g.rolling(sample, "air", 7, order_by="nope")


@pytest.mark.parametrize("limit", [10_000, 4])
@pytest.mark.parametrize("n", [8, 29, 64])
def test_spectrum_matches_numpy(spark, n, limit):
    t = pd.date_range("2020-01-01", periods=n, freq="6h")
    v = np.sin(np.arange(n)) + np.arange(n) % 5
    pdf = pd.DataFrame({"time": list(t) * 2, "v": list(v) * 2})
    if n == 29:
        pdf.loc[[3, 3 + n], "v"] = np.nan
        v = np.delete(v, 3)
    got = rows(g.spectrum(frame(spark, pdf), "v", max_steps=limit), "k")
    power = np.abs(np.fft.rfft(v - v.mean())) ** 2
    freq = np.fft.rfftfreq(len(v))
    np.testing.assert_allclose(got["power"], power[1:], rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(got["period_days"], 0.25 / freq[1:])


@pytest.mark.parametrize("limit", [10_000, 4])
def test_short_series_have_no_spectrum(spark, limit):
    pdf = pd.DataFrame({"time": pd.date_range("2020-01-01", periods=7), "v": range(7)})
    assert g.spectrum(frame(spark, pdf), "v", max_steps=limit).count() == 0


def test_peak_period(spark):
    t = pd.date_range("2020-01-01", periods=100)
    pdf = pd.DataFrame({"time": t, "v": np.sin(2 * np.pi * np.arange(100) / 20)})
    assert g.peak_period(g.spectrum(frame(spark, pdf), "v")).first()[0] == pytest.approx(20.0)


@pytest.mark.parametrize("freq", ["6h", "2D", "5D", "30min", "7h", "ME", "QE", "YE", "W-MON", "W-WED", "W-SUN"])
@pytest.mark.parametrize("method", ["mean", "sum"])
def test_resample_further_frequencies(spark, uneven_pdf, freq, method):
    got = rows(g.resample(frame(spark, uneven_pdf), "time", freq, method), "time")
    want = uneven_pdf.resample(freq, on="time")[["v", "n"]].agg(method).reset_index()
    assert got["time"].tolist() == want["time"].tolist()
    for c in ("v", "n"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float))


def test_grid_resample_counts_from_the_first_day_of_all(spark):
    pdf = pd.DataFrame({"time": pd.to_datetime(["2020-01-02 06:00", "2020-01-05 00:00", "2020-01-09 00:00"]), "lat": [1.0, 2.0, 1.0], "v": [1.0, 2.0, 3.0]})
    got = rows(g.grid_resample(frame(spark, pdf), "v", "5D", "sum", dims=["time", "lat"]), "lat", "time")
    assert got["time"].tolist() == [pd.Timestamp("2020-01-02"), pd.Timestamp("2020-01-07")] * 2
    assert got["v"].fillna(-1).tolist() == [1.0, 3.0, 2.0, -1]


def test_rolling_ties_are_decided_alike(spark):
    pdf = pd.DataFrame({"time": [1, 1, 1, 2, 2, 3] * 5, "v": [float(i * 7 % 30) for i in range(30)]})
    df = spark.createDataFrame(pdf).repartition(5)
    short, long = (rows(g.rolling(df, "v", 4, "sum", max_group_rows=n), "time", "v") for n in (None, 5))
    assert short["v_rolling_sum"].tolist() == long["v_rolling_sum"].tolist()


def test_trend_by_group_of_degree_two(spark):
    t = pd.date_range("2020-01-01", periods=30, freq="D")
    pdf = pd.concat([pd.DataFrame({"time": t, "k": k, "v": a + 0.5 * np.arange(30) + b * np.arange(30) ** 2}) for k, a, b in (("x", 1.0, 0.1), ("y", 9.0, -0.2))])
    pdf = pd.concat([pdf, pd.DataFrame({"time": t[:2], "k": "z", "v": np.nan})])
    got = rows(g.trend(frame(spark, pdf), "v", 2, by=["k"]), "k", "time")
    full = got[got["k"] != "z"]
    np.testing.assert_allclose(full["v_trend"].astype(float), full["v"].astype(float), rtol=1e-6)


@pytest.mark.parametrize("freq, steps", [("h", 24 * 366), ("MS", 12)])
def test_long_gaps_are_never_one_array(spark, freq, steps, monkeypatch):
    """A stray late year: all buckets between appear, made in runs of a bounded length."""
    from graticule.operators import temporal as tp

    pdf = pd.DataFrame({"time": pd.to_datetime(["2020-01-01 00:00", "2020-01-01 05:00", "2120-01-01 00:00"]), "v": [1.0, 2.0, 4.0]})
    got = g.resample(frame(spark, pdf), "time", freq, "sum", values=["v"])
    whole = pd.date_range("2020-01-01", "2120-01-01", freq=freq)
    assert got.count() == len(whole) and got.agg({"v": "sum"}).first()[0] == 7.0
    assert got.select("time").distinct().count() == len(whole)
    monkeypatch.setattr(tp, "GAP_STEPS", 7)
    short = g.resample(frame(spark, pdf[:2].assign(time=pd.to_datetime(["2020-01-01", "2021-01-01"]))), "time", freq, "count", values=["v"])
    assert short.count() == steps + 1
