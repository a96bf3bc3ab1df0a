"""N-dimensional array chunks as a long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col
from graticule.functions.sizing import BROADCAST_ROWS, fits
from graticule.session import cut_lineage


# Axis labels sent to every executor at most, over all distinct chunk ranges.
SLICE_LABELS = 2_000_000


def axis_of(axes: DataFrame, dim: str, kind: str = "coord_num") -> DataFrame:
    """(idx, label) rows of one dimension of a long axes table."""
    return axes.filter(F.col("dim") == dim).select("idx", col(kind).alias("label"))


def flatten_chunks(
    chunks: DataFrame,
    axes: Mapping[str, DataFrame],
    dims: Sequence[str],
    var: str = "value",
    max_axis_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per cell with coordinate columns from chunk rows.

    ``chunks`` has origin and shape (arrays of integers) and values array in
    row-major order; ``axes`` maps a dimension to (idx, label) rows. A dimension
    without an axis keeps its position; a position the axis has no label for
    gives NULL and keeps its cell.

    Labels of short axes are looked up by a broadcast join. A long axis is joined
    to the chunks before they are flattened: each chunk receives only the labels
    of its own range, so the shuffle carries axis slices, never cells.
    """
    short = {d: a for d, a in axes.items() if d in dims and fits(a, max_axis_rows)}
    long = {d: a for d, a in axes.items() if d in dims and d not in short}
    for i, dim in enumerate(dims):
        if dim in long:
            chunks = _with_slice(chunks, long[dim], i, f"_labels_{i}")

    flat = chunks.select(
        "origin", "shape", *[f"_labels_{i}" for i, d in enumerate(dims) if d in long],
        F.posexplode("values").alias("_pos", "_value"),
    )
    for i, dim in enumerate(dims):
        local = _offset(i, len(dims))
        if dim in long:
            flat = flat.withColumn(f"_c{i}", F.get(f"_labels_{i}", local.cast("int")))
        else:
            flat = flat.withColumn(f"_c{i}", local + F.col("origin")[i].cast("bigint"))
    for i, dim in enumerate(dims):
        if dim in short:
            labels = short[dim].select(F.col("idx").cast("bigint").alias(f"_c{i}"), F.col("label").alias(f"_l{i}"))
            flat = flat.join(F.broadcast(labels), f"_c{i}", "left")
    value = F.col("_value").cast("double")
    return flat.select(
        *[F.col(f"_l{i}" if d in short else f"_c{i}").alias(d) for i, d in enumerate(dims)],
        F.when(~F.isnan(value), value).alias(var),
    )


def _offset(i: int, n: int) -> Column:
    """Position along dimension i inside its chunk."""
    stride = F.lit(1).cast("bigint")
    for j in range(i + 1, n):
        stride = stride * F.col("shape")[j]
    return (F.floor(F.col("_pos") / stride) % F.col("shape")[i]).cast("bigint")


def _with_slice(chunks: DataFrame, axis: DataFrame, i: int, name: str) -> DataFrame:
    """Attach the labels of a chunk's range along dimension i as an array.

    Distinct ranges are looked up, not chunks: many chunks share a range.
    """
    lo, size = F.col("origin")[i].cast("bigint"), F.col("shape")[i].cast("bigint")
    ranges = chunks.select(lo.alias("_lo"), size.alias("_size")).distinct()
    labelled = (
        ranges.withColumn("_idx", F.explode(F.sequence(F.col("_lo"), F.col("_lo") + F.col("_size") - 1)))
        .join(axis.select(F.col("idx").cast("bigint").alias("_idx"), "label"), "_idx", "left")
        .groupBy("_lo", "_size")
        # no longer than the chunk's own extent along this dimension
        .agg(F.sort_array(F.collect_list(F.struct("_idx", "label"))).alias("_s"))
        .select("_lo", "_size", F.transform("_s", lambda e: e["label"]).alias(name))
    )
    labelled = cut_lineage(labelled)
    total = labelled.agg(F.sum("_size")).first()[0] or 0
    # labels, not rows, decide whether the slices may travel to every executor
    side = F.broadcast(labelled) if total <= SLICE_LABELS else labelled
    return chunks.withColumn("_lo", lo).withColumn("_size", size).join(side, ["_lo", "_size"]).drop("_lo", "_size")
