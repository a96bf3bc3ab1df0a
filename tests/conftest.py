from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from graticule.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", 4, spark__sql__maxMetadataStringLength="10000")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


def long_table(**axes) -> pd.DataFrame:
    """All combinations of the axes' labels, one row each."""
    return pd.MultiIndex.from_product(axes.values(), names=axes).to_frame(index=False)


@pytest.fixture(scope="session")
def sample_pdf():
    """100 days x 5 latitudes x 3 longitudes: a tide of 27 days, a slope and noise."""
    cells = long_table(time=pd.date_range("2020-01-01", periods=100, freq="D"), lat=np.arange(10.0, 60.0, 10.0), lon=np.arange(100.0, 130.0, 10.0))
    age = (cells["time"] - cells["time"].min()).dt.days
    noise = np.random.default_rng(7).standard_normal(len(cells))
    return cells.assign(air=280 - 0.3 * cells["lat"] + 0.02 * age + 6 * np.cos(age / 27 * 2 * np.pi + cells["lon"]) + noise)


@pytest.fixture(scope="session")
def sample(spark, sample_pdf):
    return frame(spark, sample_pdf).cache()


@pytest.fixture(scope="session")
def synthetic_pdf():
    """10 days x 5 x 4 cells with two variables."""
    cells = long_table(time=pd.date_range("2020-01-01", periods=10, freq="D"), lat=np.arange(10.0, 60.0, 10.0), lon=np.arange(100.0, 140.0, 10.0))
    place = np.arange(len(cells))
    return cells.assign(temperature=255 + place * 37 % 113 / 2, pressure=960 + place * 53 % 89)[["temperature", "pressure", "time", "lat", "lon"]].set_index(["time", "lat", "lon"]).reset_index()


@pytest.fixture(scope="session")
def synthetic(spark, synthetic_pdf):
    df = frame(spark, synthetic_pdf)
    return (
        df.withMetadata("temperature", {"units": "K", "long_name": "Air temperature"})
        .withMetadata("pressure", {"units": "hPa"})
        .withMetadata("lat", {"units": "degrees_north"})
        .withMetadata("lon", {"units": "degrees_east"})
    )


def frame(spark, pdf: pd.DataFrame):
    """A Spark frame whose times carry no zone and whose NaN are NULL."""
    df = spark.createDataFrame(pdf)
    for name, dtype in df.dtypes:
        if dtype == "timestamp":
            df = df.withColumn(name, df[name].cast("timestamp_ntz"))
    from graticule.functions.columns import nan_to_null

    return nan_to_null(df)


def rows(df, *order):
    out = df.toPandas()
    return out.sort_values(list(order), ignore_index=True) if order else out
