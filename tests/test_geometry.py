import numpy as np
import pandas as pd
import pytest

import graticule as g
from tests.conftest import frame, rows


@pytest.fixture(scope="module")
def uneven():
    """Unevenly spaced axes, listed in descending latitude."""
    lats, lons = np.array([50.0, 45.0, 30.0, 28.0, 0.0]), np.array([0.0, 1.0, 4.0, 10.0])
    v = np.random.RandomState(3).normal(size=(5, 4))
    pdf = pd.DataFrame([(a, o, v[i, j]) for i, a in enumerate(lats) for j, o in enumerate(lons)], columns=["lat", "lon", "v"])
    return lats, lons, v, pdf


def test_gradient_equals_numpy(spark, uneven):
    lats, lons, v, pdf = uneven
    got = rows(g.gradient(frame(spark, pdf), "v"), "lat", "lon")
    order = np.argsort(lats)
    by_lat, by_lon = np.gradient(v[order], lats[order], lons)
    np.testing.assert_allclose(got["v_grad_lat"], by_lat.ravel())
    np.testing.assert_allclose(got["v_grad_lon"], by_lon.ravel())


def test_gradient_of_one_cell_is_missing(spark):
    got = g.gradient(frame(spark, pd.DataFrame({"lat": [1.0], "lon": [2.0], "v": [3.0]})), "v").first()
    assert got.v_grad_lat is None and got.v_grad_lon is None


def _bilinear(lats, lons, v, y, x):
    """Independent evaluation for one point; None outside."""
    lats, order = np.sort(lats), np.argsort(lats)
    v = v[order]
    if not (lats[0] <= y <= lats[-1] and lons[0] <= x <= lons[-1]):
        return None
    at_lon = np.array([np.interp(x, lons, line) for line in v])
    return np.interp(y, lats, at_lon)


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("line", [((0.0, 0.0), (50.0, 10.0)), ((-10.0, 2.0), (60.0, 3.0)), ((28.0, 4.0), (28.0, 10.0))])
def test_transect_interpolates_and_leaves_outside_missing(spark, uneven, line, limit):
    lats, lons, v, pdf = uneven
    twice = frame(spark, pd.concat([pdf, pdf]))
    got = rows(g.transect(twice, "v", *line, 11, max_axis=limit), "point")
    (y0, x0), (y1, x1) = line
    for k, row in got.iterrows():
        y, x = y0 + k / 10 * (y1 - y0), x0 + k / 10 * (x1 - x0)
        want = _bilinear(lats, lons, v, y, x)
        assert (row["v"] is None or np.isnan(row["v"])) if want is None else row["v"] == pytest.approx(want)
        assert row["distance_deg"] == pytest.approx(np.hypot(y - y0, x - x0))


def test_transect_next_to_a_missing_cell(spark, uneven):
    _, _, _, pdf = uneven
    holed = frame(spark, pdf[~((pdf.lat == 30.0) & (pdf.lon == 4.0))])
    got = rows(g.transect(holed, "v", (29.0, 0.0), (29.0, 10.0), 11), "point")
    assert got["v"].isna().tolist() == [False] + [x >= 1.0 for x in range(1, 11)]


@pytest.mark.parametrize("limit", [1000, 0])
def test_transect_over_an_axis_of_one_label_or_none(spark, uneven, limit):
    df = frame(spark, uneven[3])
    flat = g.transect(df.filter("lat = 30"), "v", (30.0, 0.0), (30.0, 10.0), 10, max_axis=limit)
    assert flat.filter("v IS NOT NULL").count() == 0 and flat.count() == 10
    assert g.transect(df.filter("lat > 900"), "v", (0.0, 0.0), (1.0, 1.0), 10, max_axis=limit).count() == 10


def test_transect_bounds(spark, uneven):
    with pytest.raises(ValueError):
        g.transect(frame(spark, uneven[3]), "v", (0, 0), (1, 1), 1)
