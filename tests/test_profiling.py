import graticule as g
from tests.conftest import rows


def test_schema_profile(synthetic):
    got = rows(g.schema_profile(synthetic)).set_index("column")
    assert got.loc["time", "type"] == "datetime" and got.loc["lat", "max"] == 50.0
    assert set(got["rows"]) == {200}
    assert rows(g.schema_profile(synthetic, limit=7))["rows"].tolist() == [7] * 5
    assert rows(g.schema_profile(synthetic, limit=7, shuffle=True))["rows"].tolist() == [7] * 5


def test_schema_enums_of_numbers_only(synthetic):
    assert g.schema_enums(synthetic).count() == 0


def test_dimension_profile(synthetic):
    got = rows(g.dimension_profile(synthetic)).set_index("dim")
    assert got["size"].to_dict() == {"time": 10, "lat": 5, "lon": 4}
    assert got.loc["lon", "step"] == 10.0 and got.loc["lon", "role"] == "longitude"
    approx = rows(g.dimension_profile(synthetic, approx=True)).set_index("dim")
    assert approx.loc["lat", "size"] == 5


def test_column_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, s string")
    got = {r.column: r[2:] for r in g.column_report(df).collect()}
    assert got == {"k": (3, 3, 2), "s": (3, 2, 1)}


def test_size_flag(spark):
    assert g.estimate_size(spark.range(10_000_001)).first().exceeds_warning
    assert not g.estimate_size(spark.range(10_000_000)).first().exceeds_warning
