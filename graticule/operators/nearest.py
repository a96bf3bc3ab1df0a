"""The nearest labels of very many targets at once, by one sort of labels and targets together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col, is_numeric, is_time, require, type_of
from graticule.functions.ordering import carried_max
from graticule.functions.sizing import settled_side
from graticule.session import cut_lineage


def nearest_labels(labels: DataFrame, targets: DataFrame, dim: str) -> DataFrame:
    """(target, label): for each distinct value of ``dim`` in ``targets`` the nearest of the labels; ties go to the smaller.

    Labels and targets are sorted together once. The label before a target is the largest one
    carried along, the one behind it the same from the other end, so no target meets more
    than two labels, however they are spread. NULL targets and labels are left out; without
    labels there are no rows.
    """
    require(labels, [dim])
    require(targets, [dim])
    dtype = type_of(labels, dim)
    if not (is_numeric(dtype) or is_time(dtype)):
        raise ValueError(f"{dim} is neither a number nor a time")

    def place(df: DataFrame):
        c = col(dim)
        return (F.unix_micros(c.cast("timestamp")) if is_time(dtype) else c.cast("double")).alias("place")

    known = labels.select(place(labels), col(dim).alias("label")).filter("place IS NOT NULL").distinct()
    known = cut_lineage(known)
    asked = targets.select(place(targets), col(dim).alias("target")).filter("place IS NOT NULL").distinct()
    both = known.select("place", F.col("place").alias("at"), F.lit(0).alias("asks")).unionByName(
        asked.select("place", F.lit(None).cast(known.schema["place"].dataType).alias("at"), F.lit(1).alias("asks"))
    )
    # a label at the target's own place comes before it
    below = carried_max(both, ["place", "asks"], "at", "below").filter("asks = 1").select("place", "below")
    turned = both.select((-F.col("place")).alias("back"), "asks", (-F.col("at")).alias("at"))
    above = carried_max(turned, ["back", "asks"], "at", "above").filter("asks = 1").select((-F.col("back")).alias("place"), (-F.col("above")).alias("above"))
    near = below.join(above, "place")
    closer = F.col("below").isNull() | (F.abs(F.col("above") - F.col("place")) < F.abs(F.col("place") - F.col("below")))
    near = near.select("place", F.when(closer & F.col("above").isNotNull(), F.col("above")).otherwise(F.col("below")).alias("at"))
    named = near.filter("at IS NOT NULL").join(known.withColumnRenamed("place", "at"), "at")
    return asked.join(named, "place").select("target", "label")


def nearest_frame(
    df: DataFrame, targets: DataFrame, dims: Mapping[str, str] | list[str], label_prefix: str = "nearest_", summary: Sequence[Column] | None = None
) -> DataFrame:
    """For every target row all rows of the data at the nearest label of each dimension.

    ``dims`` names the dimensions (or maps the targets' columns to them). Each is matched on its own,
    as labels of a grid are. Returns the columns of ``targets``, the labels under
    ``nearest_{dim}``, and the other columns of the data. A target with a NULL has no rows.

    Every target at a label meets every row there, so the rows grow with both frames. Where only
    aggregates of them are wanted, ``summary`` names these: each label is aggregated once, and a
    target gets one row with its labels' aggregates instead of the rows.

    The labels are read from the dimensions' columns alone. Of the data, rows at no wanted label
    do not move: the wanted labels are broadcast where they are few.
    """
    pairs = dict(dims) if isinstance(dims, Mapping) else {d: d for d in dims}
    require(targets, pairs)
    require(df, pairs.values())
    found = targets
    for name, dim in pairs.items():
        near = nearest_labels(df.select(col(dim)), targets.select(col(name).alias(dim)), dim)
        found = found.join(near.select(F.col("target").alias(name), F.col("label").alias(f"{label_prefix}{dim}")), name)
    found = settled_side(found)
    rest = [c for c in df.columns if c not in pairs.values()]
    labels = [f"{label_prefix}{d}" for d in pairs.values()]
    data = df.select(*[col(d).alias(label) for d, label in zip(pairs.values(), labels)], *[col(c) for c in rest])
    if summary is not None:
        data = settled_side(data.groupBy(*[col(c) for c in labels]).agg(*summary))
        rest = [c for c in data.columns if c not in labels]
    taken = set(found.columns) & set(rest)
    if taken:
        raise ValueError(f"Columns {sorted(taken)} are in both frames")
    joined = data.join(found, labels)
    return joined.select(*[col(c) for c in found.columns], *[col(c) for c in rest])


def nearest_cells(df: DataFrame, targets: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """For every target (its own columns, among them lat and lon) the nearest cell: nearest_lat, nearest_lon and distance.

    The distance is the sum of both differences (ties to the smaller labels). All pairs of labels
    must have rows, as on a full grid, for the nearest labels to be those of the
    nearest cell; pairs without rows are never returned.
    """
    cells = df.select(col(lat), col(lon)).distinct()
    found = nearest_frame(cells, targets, [lat, lon])
    distance = F.abs(col(f"nearest_{lat}") - col(lat)) + F.abs(col(f"nearest_{lon}") - col(lon))
    return found.withColumn("distance", distance)
