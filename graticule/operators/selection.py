"""Projection, filters and selection by label, position or distance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.bins import AxisStats, Binning
from graticule.functions.columns import (
    at_least,
    at_most,
    col,
    equals,
    is_numeric,
    not_null,
    one_of,
    require,
    type_of,
)
from graticule.model import column_roles

KELVIN_UNITS = ("K", "degK", "kelvin")
CELSIUS_OFFSET = 273.15


def select_variables(df: DataFrame, variables: Sequence[str], dims: Sequence[str] | None = None) -> DataFrame:
    """Keep the dimensions and the named variables."""
    require(df, variables, "Variables")
    keep = list(dims) if dims is not None else [c for c in df.columns if c in column_roles(df)]
    return df.select(*[col(c) for c in keep], *[col(v) for v in variables if v not in keep])


def drop_missing(df: DataFrame, var: str) -> DataFrame:
    """Drop rows whose value is missing (NULL or NaN)."""
    return df.dropna(subset=[var])


def get(df: DataFrame, **query: Any) -> DataFrame:
    """Keyword filter: scalar, list or inclusive slice per column, all ANDed."""
    for name, value in query.items():
        if name.startswith("__"):
            continue
        require(df, [name])
        if isinstance(value, slice):
            df = dim_slice(df, name, start=value.start, stop=value.stop)
        elif isinstance(value, (list, tuple, set)):
            df = df.filter(one_of(df, name, value))
        else:
            df = df.filter(equals(df, name, value))
    return df


def dim_slice(
    df: DataFrame,
    dim: str,
    start: Any = None,
    stop: Any = None,
    values: Iterable[Any] | None = None,
    nearest: bool = False,
) -> DataFrame:
    """Slice along a column by inclusive range, by values or by nearest values."""
    if dim not in df.columns:
        return df
    if values is not None:
        values = list(values)
        if nearest and is_numeric(type_of(df, dim)):
            return _nearest_values(df, dim, values)
        return df.filter(one_of(df, dim, values))
    if start is not None:
        df = df.filter(at_least(df, dim, start))
    if stop is not None:
        df = df.filter(at_most(df, dim, stop))
    return df


def _nearest_values(df: DataFrame, dim: str, values: list[Any]) -> DataFrame:
    """All rows at the coordinate nearest to each value; ties go to the smaller.

    One aggregate over the coordinate column finds the neighbours of every value;
    the labels come back as literals, so the file reader can skip other rows.
    """
    if not values:
        return df.filter(F.lit(False))
    c = col(dim)
    below = [F.max(F.when(c <= F.lit(float(v)), c)).alias(f"lo{i}") for i, v in enumerate(values)]
    above = [F.min(F.when(c >= F.lit(float(v)), c)).alias(f"hi{i}") for i, v in enumerate(values)]
    ends = df.agg(*below, *above).first()
    chosen = []
    for i, v in enumerate(values):
        neighbours = [x for x in (ends[f"lo{i}"], ends[f"hi{i}"]) if x is not None]
        if neighbours:
            chosen.append(min(neighbours, key=lambda x: (abs(float(x) - float(v)), x)))
    return df.filter(one_of(df, dim, chosen))


def bbox(
    df: DataFrame,
    lat_min: float | None = None,
    lat_max: float | None = None,
    lon_min: float | None = None,
    lon_max: float | None = None,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Filter to a latitude/longitude box; every bound is optional."""
    if lat not in df.columns or lon not in df.columns:
        return df
    return filter_ranges(df, {lat: (lat_min, lat_max), lon: (lon_min, lon_max)})


def filter_ranges(df: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """Conjunction of inclusive ranges, one per dimension."""
    for dim, (low, high) in ranges.items():
        df = dim_slice(df, dim, start=low, stop=high)
    return df


def time_steps(df: DataFrame, n: int | None = None, time: str = "time") -> DataFrame:
    """The distinct time steps in order, or the first n of them."""
    steps = df.select(col(time)).distinct().orderBy(time)
    return steps if n is None else steps.limit(n)


def frame_at(
    df: DataFrame,
    t: Any,
    var: str,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    time: str = "time",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Binned mean map of a single time step, binned like the map of all steps."""
    bins = Binning(df, lat, lon, target, axes)
    frame = df.filter(equals(df, time, t)).select(bins.key(lat), bins.key(lon), col(var))
    return frame.groupBy(lat, lon).agg(F.avg(col(var)).alias(var))


def nearest_cell(df: DataFrame, lat0: float, lon0: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The grid cell nearest to a point (Manhattan distance; ties to smaller lat, lon)."""
    distance = F.abs(col(lat) - F.lit(float(lat0))) + F.abs(col(lon) - F.lit(float(lon0)))
    best = F.min(F.struct(distance.alias("distance"), col(lat).alias(lat), col(lon).alias(lon)))
    found = df.filter(not_null([lat, lon])).agg(best.alias("_cell"))
    return found.filter(F.col("_cell").isNotNull()).select(
        F.col("_cell")[lat].alias(lat), F.col("_cell")[lon].alias(lon), F.col("_cell")["distance"].alias("distance")
    )


def top_k(df: DataFrame, by: str, k: int, desc: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest (or smallest) values; ties decided by more columns."""
    first = col(by).desc_nulls_last() if desc else col(by).asc_nulls_last()
    return df.orderBy(first, *[col(t).asc() for t in ties]).limit(k)


def sample_n(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """A sample of n rows that does not depend on how the rows are partitioned."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(c).cast("string") for c in key_cols]))
    return df.orderBy(key, *[col(c) for c in key_cols]).limit(n)


def convert_units(df: DataFrame, var: str) -> DataFrame:
    """Kelvin to degrees Celsius when the variable's units say Kelvin."""
    attrs = dict(df.schema[var].metadata or {})
    if attrs.get("units") not in KELVIN_UNITS:
        return df
    attrs["units"] = "degC"
    return df.withColumn(var, col(var) - F.lit(CELSIUS_OFFSET)).withMetadata(var, attrs)
