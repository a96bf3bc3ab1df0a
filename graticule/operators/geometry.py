"""Gradients on a grid and transects through its mean map."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graticule.functions.bins import AxisStats
from graticule.functions.columns import col
from graticule.functions.ordering import global_index
from graticule.functions.sizing import BROADCAST_ROWS
from graticule.model import column_roles
from graticule.operators.maps import map_mean
from graticule.session import cut_lineage



def _slope(var: str, axis: str, line: Sequence[str]) -> Column:
    """Second-order difference along an axis with its own spacing; one-sided at the ends."""
    w = Window.partitionBy(*[col(c) for c in line]).orderBy(col(axis))
    v, x = col(var), col(axis)
    v0, v1 = F.lag(v).over(w), F.lead(v).over(w)
    x0, x1 = F.lag(x).over(w), F.lead(x).over(w)
    hm, hp = x - x0, x1 - x
    inside = F.try_divide(hm * hm * v1 + (hp * hp - hm * hm) * v - hp * hp * v0, hm * hp * (hm + hp))
    return (
        F.when(x0.isNull(), F.try_divide(v1 - v, hp))
        .when(x1.isNull(), F.try_divide(v - v0, hm))
        .otherwise(inside)
    )


def gradient(
    df: DataFrame,
    var: str,
    lat: str = "lat",
    lon: str = "lon",
    dims: Sequence[str] | None = None,
) -> DataFrame:
    """Finite differences along latitude and longitude, per degree.

    Expects one row per cell (and step, level ...): average duplicates first. A
    window then holds one grid line, which is no longer than its axis.
    """
    dims = [c for c in df.columns if c in column_roles(df)] if dims is None else list(dims)
    others = [d for d in dims if d not in (lat, lon, var)]
    return df.withColumn(f"{var}_grad_lat", _slope(var, lat, [*others, lon])).withColumn(
        f"{var}_grad_lon", _slope(var, lon, [*others, lat])
    )


def transect(
    df: DataFrame,
    var: str,
    start: tuple[float, float] | None = None,
    end: tuple[float, float] | None = None,
    n: int = 50,
    lines: DataFrame | None = None,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    axes: dict[str, AxisStats] | None = None,
    max_axis: int = BROADCAST_ROWS,
) -> DataFrame:
    """Bilinear values of the mean map along one line, or along every line of a frame.

    ``lines`` has columns line, lat0, lon0, lat1, lon1. Points outside the grid,
    or next to a missing cell, give NULL.
    """
    if n < 2:
        raise ValueError("a line has at least 2 points")
    single = lines is None
    if single:
        (lat0, lon0), (lat1, lon1) = start, end
        lines = df.sparkSession.range(1).select(
            F.col("id").alias("line"),
            F.lit(float(lat0)).alias("lat0"), F.lit(float(lon0)).alias("lon0"),
            F.lit(float(lat1)).alias("lat1"), F.lit(float(lon1)).alias("lon1"),
        )
    share = F.col("point") / F.lit(float(n - 1))
    points = (
        lines.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
        .withColumn("_lat", F.col("lat0") + share * (F.col("lat1") - F.col("lat0")))
        .withColumn("_lon", F.col("lon0") + share * (F.col("lon1") - F.col("lon0")))
        .withColumn(
            "distance_deg",
            F.sqrt(F.pow(F.col("_lat") - F.col("lat0"), 2) + F.pow(F.col("_lon") - F.col("lon0"), 2)),
        )
        .select("line", "point", "distance_deg", "_lat", "_lon")
    )
    # the map is read again for its axes, their ends and the corners: scan the data once
    cells = cut_lineage(
        map_mean(df, var, target, lon, lat, axes).select(
            col(lat).cast("double").alias("_y"), col(lon).cast("double").alias("_x"), col(var).alias("_v")
        )
    )
    labels = _short_axes(cells, max_axis)
    if labels is not None:
        points = _look_up(points, *labels)
    else:
        points = _bracket(points, cells, "_lat", "_y")
        points = _bracket(points, cells, "_lon", "_x")
    wy = F.try_divide(F.col("_lat") - F.col("_y_lo"), F.col("_y_hi") - F.col("_y_lo"))
    wx = F.try_divide(F.col("_lon") - F.col("_x_lo"), F.col("_x_hi") - F.col("_x_lo"))
    corners = F.array(
        *[
            F.struct(
                F.col(f"_y_{a}").alias("_y"),
                F.col(f"_x_{b}").alias("_x"),
                ((wy if a == "hi" else 1 - wy) * (wx if b == "hi" else 1 - wx)).alias("_w"),
            )
            for a in ("lo", "hi")
            for b in ("lo", "hi")
        ]
    )
    weighted = points.select("line", "point", "distance_deg", F.inline(corners)).join(cells, ["_y", "_x"], "left")
    out = weighted.groupBy("line", "point", "distance_deg").agg(
        F.when(F.count("_v") == 4, F.sum(F.col("_w") * F.col("_v"))).alias(var)
    )
    return out.drop("line") if single else out


def _short_axes(cells: DataFrame, max_axis: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted labels of both axes, or None if one has more than max_axis; one job."""

    def labels(axis: str) -> DataFrame:
        found = cells.select(F.lit(axis).alias("axis"), F.col(axis).alias("label"))
        return found.filter(F.col("label").isNotNull()).distinct().limit(max_axis + 1)

    fetched = labels("_y").union(labels("_x")).toPandas()
    y, x = (np.sort(fetched.loc[fetched["axis"] == a, "label"].to_numpy(dtype=float)) for a in ("_y", "_x"))
    return (y, x) if max(len(y), len(x)) <= max_axis else None


def _look_up(points: DataFrame, y_labels: np.ndarray, x_labels: np.ndarray) -> DataFrame:
    """Add the neighbouring axis values of each point by binary search in the (short) axes.

    Points stay where they are: the axes travel with the function.
    """

    def ends_of(labels: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(labels) < 2:
            return np.full(len(p), np.nan), np.full(len(p), np.nan)
        inside = (p >= labels[0]) & (p <= labels[-1])
        i = np.clip(np.searchsorted(labels, p, side="right") - 1, 0, len(labels) - 2)
        return np.where(inside, labels[i], np.nan), np.where(inside, labels[i + 1], np.nan)

    def neighbours(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        y, x = ends_of(y_labels, lat.to_numpy()), ends_of(x_labels, lon.to_numpy())
        return pd.DataFrame({"_y_lo": y[0], "_y_hi": y[1], "_x_lo": x[0], "_x_hi": x[1]})

    found = F.pandas_udf(neighbours, "_y_lo double, _y_hi double, _x_lo double, _x_hi double")
    return points.withColumn("_n", found("_lat", "_lon")).select("*", "_n.*").drop("_n")


def _intervals(cells: DataFrame, axis: str) -> DataFrame:
    """Neighbouring labels of a long axis, by position in its order."""
    labels = global_index(cells.select(axis).filter(F.col(axis).isNotNull()).distinct(), [axis])
    upper = labels.select((F.col("_row") - 1).alias("_row"), F.col(axis).alias(f"{axis}_hi"))
    return labels.join(upper, "_row").select(F.col(axis).alias(f"{axis}_lo"), f"{axis}_hi")


def _bracket(points: DataFrame, cells: DataFrame, p: str, axis: str) -> DataFrame:
    """Add the two neighbouring axis values of each point (NULL outside the axis).

    For axes too long to travel: an equi-join on equal-width slots instead of a
    range join; each interval is listed under the slots it touches, about two per
    interval on a regular axis.
    """
    size, low, high = cells.agg(F.count_distinct(axis), F.min(axis), F.max(axis)).first()
    width = (high - low) / (size - 1) if size > 1 else 1.0

    def slot(c: Column) -> Column:
        return F.floor((c - F.lit(low)) / F.lit(width)).cast("bigint")

    slots = _intervals(cells, axis).withColumn(
        "_slot", F.explode(F.sequence(slot(F.col(f"{axis}_lo")), slot(F.col(f"{axis}_hi"))))
    )
    here = points.withColumn("_slot", slot(F.col(p)))
    inside = (
        (here["_slot"] == slots["_slot"])
        & (here[p] >= slots[f"{axis}_lo"])
        & (
            (here[p] < slots[f"{axis}_hi"])
            | ((here[p] == slots[f"{axis}_hi"]) & (slots[f"{axis}_hi"] == F.lit(high)))
        )
    )
    return here.join(slots, inside, "left").drop(here["_slot"], slots["_slot"])
