"""Flat tables: readers chosen by extension, and the matching writers."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.columns import col, nan_to_null, numeric_columns
from graticule.model import column_roles

# File extensions and the reader they select.
FORMATS = {
    "csv": "csv",
    "tsv": "csv",
    "parquet": "parquet",
    "json": "json",
    "jsonl": "json",
}
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def extension(path: str) -> str:
    name = os.path.basename(path.rstrip("/"))
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read files of one format; missing values of variables become NULL.

    Give a schema for large text files: inferring one reads them an extra time.
    """
    paths = [path] if isinstance(path, str) else list(path)
    ext = fmt or extension(paths[0])
    if not ext:
        raise ValueError(f"Name the format of {paths[0]}, which has no extension. Known: {sorted(FORMATS)}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    kind = FORMATS.get(ext, "csv")
    if kind == "parquet":
        df = reader.parquet(*paths)
    elif kind == "json":
        whole = ext == "json" and not _one_record_per_line(spark, paths)
        df = reader.option("multiLine", whole).option("inferTimestamp", True).json(paths)
    else:
        reader = reader.option("header", True).option("sep", "\t" if ext == "tsv" else ",")
        reader = reader.option("preferDate", False).option("inferSchema", schema is None)
        df = reader.csv(paths)
    if kind != "parquet" and schema is None:
        df = _inferred(df)
    if not numeric_columns(df):
        raise ValueError(f"No numeric column in {paths}")
    roles = column_roles(df)
    return nan_to_null(df, [c for c in df.columns if c not in roles])


def _one_record_per_line(spark: SparkSession, paths: list[str]) -> bool:
    """Whether .json files hold records line by line (splittable) or one array per file."""
    lines = spark.read.text(paths).filter(F.trim("value") != "").limit(1).collect()
    first = lines[0][0].strip() if lines else "{}"
    return first.startswith("{") and first.endswith("}")


def _inferred(df: DataFrame) -> DataFrame:
    """Types inferred from text, in the data model's terms: no zone, no narrow integers."""
    wider = {T.TimestampType: "timestamp_ntz", T.IntegerType: "bigint"}
    changed = {f.name: col(f.name).cast(wider[type(f.dataType)]) for f in df.schema.fields if type(f.dataType) in wider}
    return df.withColumns(changed) if changed else df


def read_many(spark: SparkSession, paths: str | Sequence[str], fmt: str | None = None) -> DataFrame:
    """Several files, or a glob, as one dataset; columns are matched by name.

    Parquet and JSON match by name within one scan; delimited files take one scan
    per distinct header, so the plan does not grow with the number of files.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    ext = fmt or extension(listed[0])
    kind = FORMATS.get(ext, "csv")
    if kind == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(*listed)
        roles = column_roles(df)
        return nan_to_null(df, [c for c in df.columns if c not in roles])
    if kind == "json":
        return read_table(spark, listed, ext)
    parts = [read_table(spark, files, ext) for files in _by_header(spark, listed)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Files of equal first lines, so that each scan has one order and set of columns."""
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.withColumn("_at", F.monotonically_increasing_id()).filter("file_block_start = 0")
    heads = lines.groupBy("file_path").agg(F.min_by("value", "_at").alias("header"))
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).orderBy("files").collect()
    if not groups:
        raise ValueError(f"No lines in {paths}")
    return [list(r["files"]) for r in groups]


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write all rows as CSV, TSV, Parquet or JSON records with ISO times."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
        return
    writer = writer.option("timestampFormat", ISO_TIME).option("timestampNTZFormat", ISO_TIME)
    if fmt in ("csv", "tsv"):
        writer.option("header", True).option("sep", "\t" if fmt == "tsv" else ",").csv(path)
    elif fmt in ("json", "jsonl"):
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"Unknown format: {fmt}. Known: {sorted(FORMATS)}")
