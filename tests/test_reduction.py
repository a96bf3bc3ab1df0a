import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import graticule as g
from tests.conftest import frame, rows

METHODS = ["mean", "sum", "std", "min", "max", "median", "count"]


@pytest.fixture(scope="module")
def gaps(spark):
    """A full group, a one-row group, an all-missing group and a missing key."""
    return pd.DataFrame(
        {
            "k": ["a", "a", "a", "b", "c", "c", None],
            "v": [1.0, np.nan, 4.0, 2.0, np.nan, np.nan, 9.0],
            "t": range(7),
        }
    )


@pytest.mark.parametrize("method", METHODS)
def test_reduce_matches_pandas(spark, gaps, method):
    got = rows(g.reduce_dims(frame(spark, gaps), ["t"], method, ["v"]), "k")
    want = gaps.groupby("k", as_index=False)[["v"]].agg(method)
    assert got["k"].tolist() == ["a", "b", "c"]
    np.testing.assert_allclose(got["v"].astype(float), want["v"].astype(float))


def test_reduced_row_counts(sample):
    assert g.reduce_dims(sample, ["time"]).count() == 15
    assert g.reduce_dims(sample, ["lat", "lon"]).count() == 100
    assert g.reduce_dims(sample, ["time", "lat", "lon"]).count() == 1
    assert g.reduce_dims(sample, ["nope"]) is sample


def test_reduce_falls_back_to_coordinates_when_no_value_is_left(sample):
    out = g.reduce_dims(sample.select("time", "lat"), ["time"])
    assert out.columns == ["lat"] and out.first()[0] == 30.0


def test_reduce_booleans(spark):
    df = spark.createDataFrame([("a", True, 1.0), ("a", False, 3.0)], "k string, f boolean, v double")
    assert g.reduce_dims(df.withColumn("t", F.lit(1)), ["t"]).first()["f"] == 0.5
    assert g.reduce_dims(df.withColumn("t", F.lit(1)), ["t"], "max").columns == ["k", "v"]


def test_unknown_method(sample):
    with pytest.raises(ValueError, match="mode"):
        g.reduce_dims(sample, ["time"], "mode")
    with pytest.raises(ValueError, match="mode"):
        g.grid_reduce(sample, "air", "time", "mode")


def test_grid_reduce_uses_population_std(sample, sample_pdf):
    got = rows(g.grid_reduce(sample, "air", "time", "std"), "lat", "lon")
    want = sample_pdf.groupby(["lat", "lon"])["air"].std(ddof=0)
    np.testing.assert_allclose(got["air"], want.to_numpy())


@pytest.mark.parametrize("by", [None, ["lat"]])
def test_large_groups_give_the_same_percentiles(sample, sample_pdf, by):
    ps = (0.0, 0.1, 0.333, 0.5, 0.99, 1.0)
    small = rows(g.percentiles(sample, "air", ps, by), *(by or []))
    large = rows(g.percentiles(sample, "air", ps, by, max_group_rows=20), *(by or []))
    pd.testing.assert_frame_equal(small, large, check_exact=False, rtol=1e-12)
    if by is None:
        np.testing.assert_allclose(small.iloc[0, : len(ps)], sample_pdf["air"].quantile(list(ps)))


def test_percentiles_with_repeats_nulls_and_mixed_group_sizes(spark):
    pdf = pd.DataFrame(
        {
            "k": ["hot"] * 300 + ["flat"] * 200 + ["tiny"] * 3 + ["none"] * 150 + [None] * 120,
            "v": list(np.repeat([1.0, 2.0, 1e9], 100)) + [7.0] * 200 + [1.0, 2.0, 4.0] + [np.nan] * 150
            + list(np.arange(120.0)),
        }
    )
    df = frame(spark, pdf)
    small = rows(g.percentiles(df, "v", (0.25, 0.5, 0.9), ["k"]), "k")
    large = rows(g.percentiles(df, "v", (0.25, 0.5, 0.9), ["k"], max_group_rows=50), "k")
    pd.testing.assert_frame_equal(small, large)
    assert len(large) == 5 and large.set_index("k").loc["none"].isna().all()


def test_approximate_percentiles_stay_close(sample, sample_pdf):
    got = g.percentiles(sample, "air", (0.5,), approx=True).first()["air_p50"]
    assert abs(got - sample_pdf["air"].median()) < 0.1


def test_histogram_counts_the_maximum_and_empty_bins(spark):
    df = frame(spark, pd.DataFrame({"v": [0.0, 0.1, 10.0, 10.0, np.nan]}))
    got = rows(g.histogram(df, "v", 5), "bin")
    counts, edges = np.histogram([0.0, 0.1, 10.0, 10.0], 5)
    assert got["count"].tolist() == counts.tolist() == [2, 0, 0, 0, 2]
    np.testing.assert_allclose(got["bin_start"], edges[:-1])
    np.testing.assert_allclose(got["bin_end"], edges[1:])


def test_histogram_of_a_constant_and_of_nothing(spark):
    same = frame(spark, pd.DataFrame({"v": [3.0, 3.0]}))
    assert rows(g.histogram(same, "v", 4), "bin")["count"].tolist() == np.histogram([3.0, 3.0], 4)[0].tolist()
    assert rows(g.histogram(same.filter("v > 9"), "v", 4), "bin")["count"].tolist() == [0] * 4


def test_kde_is_close_to_the_exact_estimate(sample, sample_pdf):
    got = rows(g.kde(sample, "air"), "point")
    v = sample_pdf["air"].to_numpy()
    h = v.std(ddof=1) * len(v) ** -0.2
    exact = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.abs(got["density"] - exact).max() < 1e-3 * exact.max()
    assert g.kde(sample.filter("lat > 900"), "air").count() == 0


def test_region_stats_keep_empty_boxes_and_wrap_longitudes(spark):
    df = frame(spark, pd.DataFrame({"lat": [10.0, 70.0], "lon": [200.0, 20.0], "v": [1.0, 3.0]}))
    plain = g.region_stats(df, "v").toPandas().set_index("region")
    assert plain.loc["Global", "count"] == 1 and plain.loc["Antarctic (<66.5S)", "count"] == 0
    wrapped = g.region_stats(df, "v", normalize_lon=True).toPandas().set_index("region")
    assert wrapped.loc["Global", "count"] == 2 and np.isnan(wrapped.loc["Global":"Global", "std"].isna().mean()) == False  # noqa: E712


def test_coverage_counts_missing_cells(spark):
    df = frame(spark, pd.DataFrame({"lat": [0.0, 0.0], "lon": [0.0, 0.0], "v": [1.0, np.nan]}))
    assert g.coverage(df, "v").first()["coverage_pct"] == 50.0
    assert g.overall_coverage(df, "v").first()[:] == (2, 1, 50.0)


def test_summary_is_one_scan(sample):
    plan = g.summary(sample, ["air", "lat"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1


def test_compare_means_needs_something_shared(sample, synthetic):
    with pytest.raises(ValueError, match="shared"):
        g.compare_means(sample, synthetic)


def test_zone_names(sample):
    zones = {r.zone for r in g.zone_stats(sample, "air").collect()}
    assert zones == {"Tropical (15-20N)", "Subtropical (20-40N)", "Mid-latitude (40-60N)"}


@pytest.mark.parametrize("limit", [None, 5])
def test_percentiles_with_infinite_values(spark, limit):
    values = [float("-inf")] * 3 + [float(i) for i in range(40)] + [1e308, -1e308] + [float("inf")] * 6
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = g.percentiles(df, "v", (0.0, 0.04, 0.5, 0.9, 1.0), max_group_rows=limit).first()
    want = sorted(values)
    assert [got[0], got[2], got[3], got[4]] == [want[0], want[25], want[45], want[-1]]


def test_kde_of_skewed_values(spark):
    x = np.exp(2 * np.random.default_rng(3).standard_normal(3000))
    got = rows(g.kde(spark.createDataFrame(pd.DataFrame({"v": x})), "v", 200), "point")
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got["density"], want, rtol=1e-8, atol=1e-10 * want.max())
