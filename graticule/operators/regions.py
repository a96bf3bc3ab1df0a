"""Summaries of very many boxes at once, by covers of cells instead of a condition per box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col, not_null, require
from graticule.session import materialize

SPLIT = 8  # cells along the longer side of a box, about: at most (SPLIT + 2) squared per box
BOUNDS = ("lat_min", "lat_max", "lon_min", "lon_max")


def _cell(c: Column, level: Column) -> Column:
    """Index of the cell of width 2**level, exact in binary numbers."""
    return F.floor(c / F.pow(F.lit(2.0), level))


def _moments(df: DataFrame, *keys: str) -> DataFrame:
    """Counts, means and squared deviations of groups, merged around the common shift that the means were taken from."""
    n, s1 = F.sum("n"), F.sum(F.col("n") * F.col("d"))
    return df.groupBy(*keys).agg(
        n.alias("n"), (s1 / n).alias("d"), (F.sum(F.col("m2") + F.col("n") * F.col("d") * F.col("d")) - s1 * s1 / n).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def region_stats_many(
    df: DataFrame,
    var: str,
    boxes: DataFrame,
    region: str = "region",
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Count, mean, std, min and max of a variable in each of many boxes; empty boxes stay.

    ``boxes`` has one row per box: its name and lat_min, lat_max, lon_min, lon_max (ends included).
    Boxes may overlap, repeat and differ in size.

    1. The data shrink to one row of moments per coordinate pair, map-side, in one read.
    2. A box is covered by up to about a hundred cells of a width that fits it (a power of 2);
       these are inside, or cut by its edge.
    3. The moments are added up per cell and join the covers by cell: whole cells where a box
       holds them, coordinate by coordinate only in cells that an edge cuts.

    The plan is the same for any number of boxes, and no point meets a box by a condition
    alone. A cell that very many boxes cover is pre-aggregated, so its rows are those
    of the cover. Boxes without a bound, or with the lower one above the upper, are empty.
    """
    require(df, [var, lat, lon])
    require(boxes, [region, *BOUNDS])
    rows = df.filter(not_null([lat, lon])).select(col(lat).cast("double").alias("y"), col(lon).cast("double").alias("x"), col(var).cast("double").alias("v"))
    points = rows.groupBy("y", "x").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    points = materialize(points.filter("n > 0"), "points")
    # deviations from one common value: sums of squares of large numbers would cancel
    shift = points.agg(F.sum(F.col("mean") * F.col("n")) / F.sum("n")).scalar()
    points = points.withColumn("d", F.col("mean") - shift).drop("mean")
    extent = points.agg(F.struct(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))).scalar()

    named = boxes.select(col(region).alias("_region"), *[col(b).cast("double").alias(b) for b in BOUNDS]).withColumn("_box", F.monotonically_increasing_id())
    named = materialize(named, "boxes")
    # only the part of a box that holds points needs a cover
    clipped = named.withColumn("_e", extent).select(
        "_box", *BOUNDS,
        F.greatest("lat_min", "_e.y0").alias("y0"), F.least("lat_max", "_e.y1").alias("y1"), F.greatest("lon_min", "_e.x0").alias("x0"), F.least("lon_max", "_e.x1").alias("x1"),
    )
    clipped = clipped.filter(not_null(BOUNDS) & (F.col("y0") <= F.col("y1")) & (F.col("x0") <= F.col("x1")))
    side = F.greatest(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"), F.lit(1e-9))
    covers = clipped.withColumn("level", F.ceil(F.log2(side / SPLIT)).cast("int"))
    for axis in "yx":
        ends = [_cell(F.col(f"{axis}{i}"), F.col("level")) for i in (0, 1)]
        covers = covers.withColumn(f"c{axis}", F.explode(F.sequence(*ends)))
    width = F.pow(F.lit(2.0), F.col("level"))
    whole = [F.col(f"c{a}") * width >= F.col(lo) for a, lo in (("y", "lat_min"), ("x", "lon_min"))]
    whole += [(F.col(f"c{a}") + 1) * width <= F.col(hi) for a, hi in (("y", "lat_max"), ("x", "lon_max"))]
    covers = materialize(covers.withColumn("whole", whole[0] & whole[1] & whole[2] & whole[3]).drop("y0", "y1", "x0", "x1"), "covers")

    cell = ["level", "cy", "cx"]
    # levels are the sizes of boxes by powers of 2: a few dozen numbers
    levels = covers.agg(F.array_sort(F.collect_set("level")).alias("levels")).scalar()
    placed = points.withColumn("level", F.explode(levels)).withColumns({"cy": _cell(F.col("y"), F.col("level")), "cx": _cell(F.col("x"), F.col("level"))})
    sums = _moments(placed, *cell).join(covers.filter("whole").select("_box", *cell), cell).select("_box", "n", "d", "m2", "lo", "hi")
    edges = placed.join(covers.filter(~F.col("whole")), cell)
    edges = edges.filter(F.col("y").between(F.col("lat_min"), F.col("lat_max")) & F.col("x").between(F.col("lon_min"), F.col("lon_max")))
    found = _moments(sums.unionByName(edges.select("_box", "n", "d", "m2", "lo", "hi")), "_box")
    out = named.join(found, "_box", "left").withColumn("_shift", shift)
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))
    return out.select(
        F.col("_region").alias(region), F.coalesce("n", F.lit(0)).alias("count"), (F.col("d") + F.col("_shift")).alias("mean"), std.alias("std"), F.col("lo").alias("min"), F.col("hi").alias("max")
    )
