"""What files hold: ranges of their dimensions, gaps and overlaps in time, and which of them a filter needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.columns import at_least, at_most, col, is_time, require, type_of
from graticule.functions.ordering import carried_max
from graticule.sources.tables import FORMATS, extension, read_many

FILE = ("file", "modified", "bytes")


def file_states(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, modified, bytes of all files; nothing of them is read."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(listed)
    return files.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def index_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    dims: Sequence[str],
    fmt: str | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row per file: file, modified, bytes, rows and, per dimension, {dim}_min, {dim}_max and {dim}_nulls.

    One pass over the dimensions' columns alone, aggregated map-side; keep the result as a
    table. With a ``known`` index only files that are new or have changed since are read;
    rows of files that are gone are left out.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    states = file_states(spark, listed)
    if known is not None:
        require(known, [*FILE, "rows", *[f"{d}_min" for d in dims]])
        same = [_path(F.col("file")) == _path(F.col("_file")), F.col("modified") == F.col("_modified"), F.col("bytes") == F.col("_bytes")]
        old = known.withColumnsRenamed({c: f"_{c}" for c in FILE})
        kept = old.join(states, reduce(Column.__and__, same), "left_semi").withColumnsRenamed({f"_{c}": c for c in FILE})
        fresh = states.join(known.select(*[F.col(c).alias(f"_{c}") for c in FILE]), reduce(Column.__and__, same), "left_anti")
        # names of files to read, as any reader holds them
        listed = [r["file"] for r in fresh.select("file").toLocalIterator()]
        if not listed:
            return kept
        kind = fmt or extension(paths if isinstance(paths, str) else paths[0]) or extension(listed[0])
        return kept.unionByName(_ranges(spark, listed, dims, kind), allowMissingColumns=True)
    return _ranges(spark, listed, dims, fmt or extension(listed[0]))


def _path(file: Column) -> Column:
    """A file's place without the ways to write an empty host."""
    return F.regexp_replace(file, r"^(\w+):/+", "$1:/")


def _ranges(spark: SparkSession, listed: list[str], dims: Sequence[str], fmt: str) -> DataFrame:
    df = read_many(spark, listed, fmt)
    require(df, dims)
    place = df.metadataColumn("_metadata")
    keys = [place["file_path"].alias("file"), place["file_modification_time"].alias("modified"), place["file_size"].alias("bytes")]
    found = []
    for d in dims:
        found += [F.min(col(d)).alias(f"{d}_min"), F.max(col(d)).alias(f"{d}_max"), F.count(F.when(col(d).isNull(), 1)).alias(f"{d}_nulls")]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *found)


def time_continuity(index: DataFrame, time: str = "time", step_seconds: float = 0.0) -> DataFrame:
    """How files follow each other in time: file, start, end, covered_until, gap_seconds, overlap_seconds.

    A sweep over the files by start: ``covered_until`` is the latest end of any file before
    (NULL for the first). ``gap_seconds`` is the time from there to the start, if that
    is more than ``step_seconds`` (the distance of two steps of the data), else 0;
    ``overlap_seconds`` is how much of the file lies before it, so a file inside another
    one overlaps whole. Files without a time are left out. Files of equal start go by end, then by name.
    """
    start, end = f"{time}_min", f"{time}_max"
    require(index, ["file", start, end])
    seconds = (lambda c: c.cast("double")) if not is_time(type_of(index, start)) else (lambda c: F.unix_micros(c.cast("timestamp")) / F.lit(1e6))
    files = index.filter(col(start).isNotNull()).select("file", col(start).alias("start"), col(end).alias("end"))
    swept = carried_max(files, ["start", "end", "file"], "end", "covered_until")
    ahead = seconds(F.col("start")) - seconds(F.col("covered_until"))
    gap = F.when(ahead > F.lit(float(step_seconds)), ahead).otherwise(F.lit(0.0))
    until = F.least("end", "covered_until")
    overlap = F.greatest(seconds(until) - seconds(F.col("start")), F.lit(0.0))
    return swept.select("file", "start", "end", "covered_until", F.coalesce(gap, F.lit(0.0)).alias("gap_seconds"), F.when(F.col("covered_until").isNotNull(), overlap).otherwise(F.lit(0.0)).alias("overlap_seconds"))


def _holds(index: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> Column:
    """Whether a file can have rows in all the ranges (ends included; None is open)."""
    out = F.lit(True)
    for dim, (low, high) in ranges.items():
        require(index, [f"{dim}_min", f"{dim}_max"])
        if low is not None:
            out = out & at_least(index, f"{dim}_max", low)
        if high is not None:
            out = out & at_most(index, f"{dim}_min", high)
    return out


def files_for(index: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The index rows of files that can hold rows in all the ranges."""
    return index.filter(_holds(index, ranges))


def read_ranges(
    spark: SparkSession,
    index: DataFrame,
    ranges: Mapping[str, tuple[Any, Any]],
    fmt: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows in all the ranges (ends included; None is open) from the files that can hold some; others are not opened.

    Names of these files come to the driver, as for any scan. If there are none, the first
    file of the index gives the columns and no row (or give a ``schema``).
    """
    files = [r["file"] for r in files_for(index, ranges).select("file").orderBy("file").toLocalIterator()]
    if not files:
        if schema is not None:
            return spark.createDataFrame([], schema)
        some = index.select("file").orderBy("file").first()
        if some is None:
            raise ValueError("The index is empty")
        return read_many(spark, [some["file"]], fmt or extension(some["file"])).limit(0)
    kind = fmt or extension(files[0])
    if FORMATS.get(kind) == "parquet" and schema is not None:
        df = spark.read.schema(schema).parquet(*files)
    else:
        df = read_many(spark, files, kind)
    for dim, (low, high) in ranges.items():
        if low is not None:
            df = df.filter(at_least(df, dim, low))
        if high is not None:
            df = df.filter(at_most(df, dim, high))
    return df
