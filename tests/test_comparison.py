import numpy as np
import pandas as pd
import pytest

import graticule as g
from tests.conftest import frame, rows


def test_difference_keeps_cells_with_rows_in_both(spark):
    pdf = pd.DataFrame(
        {
            "time": pd.to_datetime(["2020-01-01", "2020-02-01", "2020-01-01", "2020-02-01", "2020-02-01"]),
            "lat": [0.0, 0.0, 1.0, 1.0, 2.0], "lon": [0.0] * 5, "v": [1.0, 4.0, 2.0, np.nan, 9.0],
        }
    )
    out = rows(g.diff_periods(frame(spark, pdf), "v", ("2020-01-01", "2020-01-31"), ("2020-02-01", "2020-02-28")), "lat")
    assert out["lat"].tolist() == [0.0, 1.0]
    assert out["difference"][0] == 3.0 and np.isnan(out["difference"][1])
    assert g.difference_limit(g.diff_periods(frame(spark, pdf), "v", ("2020-01-01", "2020-01-31"), ("2020-02-01", "2020-02-28"))).first()[0] == 3.0


def test_difference_reads_the_data_once(sample):
    plan = g.diff_periods(sample, "air", ("2020-01-01", "2020-02-01"), ("2020-02-01", "2020-04-01"), target=None)
    assert plan._jdf.queryExecution().executedPlan().toString().count("InMemoryTableScan") == 1


def test_cross_variable_counts_all_pairs_like_a_join(spark):
    rng = np.random.RandomState(5)
    a = pd.DataFrame({"k": rng.choice(["hot", "hot", "x", "y"], 300), "a": rng.normal(1e6, 1, 300)})
    b = pd.DataFrame({"k": rng.choice(["hot", "x", "z"], 200), "b": rng.normal(size=200)})
    b["b"] += b["k"].map({"hot": 1.0, "x": 0.0, "z": 2.0})
    a["a"] += a["k"].map({"hot": 2.0, "x": 0.0, "y": 1.0})
    a.loc[::7, "a"] = np.nan
    b.loc[::5, "b"] = np.nan
    merged = a.merge(b, on="k")
    got = g.cross_variable(frame(spark, a), frame(spark, b), "a", "b").first()
    assert got.points == len(merged) and got.shared_coords == "k"
    assert got.correlation == pytest.approx(merged["a"].corr(merged["b"]), rel=1e-9)


def test_cross_variable_edges(spark, sample):
    same = frame(spark, pd.DataFrame({"k": [1, 2, 3], "a": [5.0] * 3}))
    other = frame(spark, pd.DataFrame({"k": [1, 2, 3], "b": [1.0, 2.0, 3.0]}))
    assert g.cross_variable(same, other).first().correlation is None
    assert g.cross_variable(same, other.filter("k > 9")).first()[:] == ("k", 0, None)
    with pytest.raises(ValueError, match="shared"):
        g.cross_variable(same.select("a"), other.select("b"))


def test_correlation_map_matches_pandas(sample, sample_pdf):
    got = rows(g.correlation_map(sample, "air", 29.0, 111.0), "lat", "lon")
    pivot = sample_pdf.pivot_table(index="time", columns=["lat", "lon"], values="air")
    want = pivot.corrwith(pivot[(30.0, 110.0)])
    np.testing.assert_allclose(got["correlation"], want.to_numpy())


def test_correlation_map_of_constant_and_short_series(spark, sample):
    pdf = pd.DataFrame(
        {"time": list(pd.date_range("2020-01-01", periods=6)) * 2, "lat": [0.0] * 6 + [1.0] * 6, "lon": 0.0,
         "v": list(range(6)) + [3.0] * 6}
    )
    got = rows(g.correlation_map(frame(spark, pdf), "v", 0, 0), "lat")
    assert got["correlation"][0] == pytest.approx(1.0) and np.isnan(got["correlation"][1])
    assert g.correlation_map(frame(spark, pdf[pdf.time < "2020-01-05"]), "v", 0, 0).count() == 0


def test_overlay_keeps_cells_of_either_side(spark):
    a = frame(spark, pd.DataFrame({"lat": [0.0, 1.0], "lon": [0.0, 0.0], "a": [1.0, 2.0]}))
    b = frame(spark, pd.DataFrame({"lat": [1.0, 2.0], "lon": [0.0, 0.0], "b": [3.0, 4.0]}))
    got = rows(g.overlay(a, "a", "b", b), "lat")
    assert got["lat"].tolist() == [0.0, 1.0, 2.0] and got["contour"].isna().tolist() == [True, False, False]


def test_compare_grids_renames_coordinates(spark):
    a = frame(spark, pd.DataFrame({"lat": [0.0, 1.0], "lon": [0.0, 0.0], "v": [1.0, 2.0]}))
    b = frame(spark, pd.DataFrame({"y": [1.0, 2.0], "x": [0.0, 0.0], "v": [5.0, 4.0]}))
    got = g.compare_grids(a, b, "v", b_lat="y", b_lon="x").collect()
    assert len(got) == 1 and got[0].difference == 3.0


def test_cross_variable_beyond_64_bits(spark, monkeypatch):
    """Sums of 4e9 rows per side at one coordinate, fed to the last step."""
    from pyspark.sql import functions as F

    from graticule.operators import comparison

    plain = comparison._pair_sums

    def weighty(var, mean, side):
        return [(c * F.lit(4_000_000_000)).alias(f"{n}_{side}") for c, n in zip(plain(var, mean, side), ("rows", "n", "s", "q"))]

    monkeypatch.setattr(comparison, "_pair_sums", weighty)
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0)], "lat int, a double")
    b = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 8.0)], "lat int, b double")
    got = g.cross_variable(a, b).first()
    assert got["points"] is None and abs(got["correlation"] - 1) < 1e-9
