"""Profiles of schema, dimensions, columns and size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.calendar import NTZ
from graticule.functions.columns import col, is_numeric, is_time, type_of
from graticule.functions.ordering import global_index
from graticule.model import column_roles, coordinate_kind

MAX_ROWS_WARNING = 10_000_000

# Names of the schema types by Spark type.
_TYPE_NAMES = (
    (T.BooleanType, "boolean"),
    (T.IntegralType, "integer"),
    (T.NumericType, "number"),
    (T.StringType, "string"),
    (T.TimestampType, "datetime"),
    (T.TimestampNTZType, "datetime"),
    (T.DateType, "datetime"),
)


def type_name(dtype: T.DataType) -> str:
    for kind, name in _TYPE_NAMES:
        if isinstance(dtype, kind):
            return name
    return dtype.simpleString()


def _sampled(df: DataFrame, limit: int | None, shuffle: bool) -> DataFrame:
    if limit is None:
        return df
    return df.orderBy(F.rand(42)).limit(limit) if shuffle else df.limit(limit)


def schema_profile(df: DataFrame, limit: int | None = None, shuffle: bool = False) -> DataFrame:
    """One row per column: type, row count, min and max (numbers, times), all from one pass.

    With a limit the profile covers that many rows only.
    """
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        if is_numeric(f.dataType) or is_time(f.dataType):
            aggregates += [F.min(col(f.name)).alias(f"_min{i}"), F.max(col(f.name)).alias(f"_max{i}")]
    one = _sampled(df, limit, shuffle).agg(*aggregates)
    missing_number, missing_time = F.lit(None).cast("double"), F.lit(None).cast(NTZ)
    rows = []
    for i, f in enumerate(fields):
        number, moment = is_numeric(f.dataType), is_time(f.dataType)
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(type_name(f.dataType)).alias("type"),
                F.col("_rows").alias("rows"),
                (F.col(f"_min{i}").cast("double") if number else missing_number).alias("min"),
                (F.col(f"_max{i}").cast("double") if number else missing_number).alias("max"),
                (F.col(f"_min{i}").cast(NTZ) if moment else missing_time).alias("min_time"),
                (F.col(f"_max{i}").cast(NTZ) if moment else missing_time).alias("max_time"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def schema_enums(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All distinct values of the categorical columns as (column, value) rows.

    A frame, not a list: nothing is cut however many values there are, and
    duplicates disappear map-side.
    """
    names = list(columns) if columns is not None else categorical_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string")
    entries = [F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in names]
    listed = df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    return listed.distinct().orderBy("column", "value")


def axes_table(df: DataFrame, dims: Sequence[str] | None = None) -> DataFrame:
    """Long table (dim, idx, coord_num, coord_ts, coord_str) of the sorted labels of each dimension.

    Labels are deduplicated map-side first; the window that numbers them holds
    one axis, not the data.
    """
    roles = column_roles(df)
    dims = [c for c in df.columns if c in roles] if dims is None else list(dims)
    kinds = {"numeric": ("coord_num", "double"), "datetime": ("coord_ts", "timestamp_ntz"), "categorical": ("coord_str", "string")}

    def one(dim: str) -> DataFrame:
        labels = df.select(col(dim).alias("label")).filter(F.col("label").isNotNull()).distinct()
        name, _ = kinds[coordinate_kind(type_of(df, dim))]
        return global_index(labels, ["label"]).select(
            F.lit(dim).alias("dim"),
            F.col("_row").cast("int").alias("idx"),
            *[(F.col("label") if n == name else F.lit(None)).cast(t).alias(n) for n, t in kinds.values()],
        )

    return reduce(DataFrame.unionByName, [one(d) for d in dims])


def dimension_profile(df: DataFrame, dims: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per dimension: size, dtype, min, max, step, kind and role.

    Each dimension is profiled from its own column, so a distinct count is a plain
    two-step aggregate and no row is copied per dimension. The step is the second
    smallest value minus the smallest.
    """
    roles = column_roles(df)
    dims = [c for c in df.columns if c in roles] if dims is None else list(dims)
    return reduce(DataFrame.unionByName, [_one_dimension(df, d, roles.get(d, "dimension"), approx) for d in dims])


def _one_dimension(df: DataFrame, dim: str, role: str, approx: bool) -> DataFrame:
    c, dtype = col(dim), type_of(df, dim)
    kind = coordinate_kind(dtype)
    size = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    number, moment = kind == "numeric", kind == "datetime"
    missing_number, missing_time = F.lit(None).cast("double"), F.lit(None).cast(NTZ)
    step = missing_number
    if number:
        smallest = df.agg(F.min(c)).scalar()
        step = F.min(F.when(c > smallest, c)).cast("double") - F.min(c).cast("double")
    return df.agg(
        F.lit(dim).alias("dim"),
        F.lit(kind).alias("kind"),
        F.lit(role).alias("role"),
        F.lit(dtype.simpleString()).alias("dtype"),
        size.alias("size"),
        (F.min(c).cast("double") if number else missing_number).alias("min"),
        (F.max(c).cast("double") if number else missing_number).alias("max"),
        (F.min(c).cast(NTZ) if moment else missing_time).alias("min_time"),
        (F.max(c).cast(NTZ) if moment else missing_time).alias("max_time"),
        step.alias("step"),
    )


def table_metadata(df: DataFrame, dims: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, role, units, description, and the range and size of dimensions."""
    roles = column_roles(df)
    dims = [c for c in df.columns if c in roles] if dims is None else list(dims)
    attrs = {f.name: f.metadata or {} for f in df.schema.fields}
    columns = df.sparkSession.createDataFrame(
        [
            (i, f.name, f.dataType.simpleString(), f.name in dims, attrs[f.name].get("units"),
             attrs[f.name].get("long_name"))
            for i, f in enumerate(df.schema.fields)
        ],
        "position int, column string, data_type string, is_coordinate boolean, units string, description string",
    )
    if not dims:
        return columns
    ranges = dimension_profile(df, dims).select(
        F.col("dim").alias("column"),
        "role",
        "size",
        F.coalesce(F.col("min").cast("string"), F.col("min_time").cast("string")).alias("min"),
        F.coalesce(F.col("max").cast("string"), F.col("max_time").cast("string")).alias("max"),
    )
    return columns.join(ranges, "column", "left")


def column_report(df: DataFrame) -> DataFrame:
    """Total, non-null and distinct values per column.

    One narrow scan per column: together they read each column once, and none of
    them copies rows as several distinct counts in one aggregate would.
    """
    parts = [
        df.agg(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count(F.lit(1)).alias("total"),
            F.count(col(f.name)).alias("non_null"),
            F.count_distinct(col(f.name)).alias("unique_values"),
        )
        for f in df.schema.fields
    ]
    return reduce(DataFrame.unionByName, parts)


def estimate_size(df: DataFrame, columns: int | None = None) -> DataFrame:
    """Rows, columns and size at 8 bytes a value, with a flag for large tables."""
    n = columns if columns is not None else len(df.columns)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    size = F.col("rows") * F.lit(n) * F.lit(8)
    return rows.select(
        "rows",
        F.lit(n).cast("bigint").alias("columns"),
        size.cast("bigint").alias("estimated_bytes"),
        F.round(size / F.lit(1024.0**2), 1).alias("estimated_mb"),
        (F.col("rows") > MAX_ROWS_WARNING).alias("exceeds_warning"),
    )


# Accuracy of distinct counts by sketches: 2**this registers.
SKETCH_BITS = 14


def distinct_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a distinct count from sketches of this size."""
    return 1.04 / 2 ** (bits / 2)


def _sketched(df: DataFrame, name: str) -> Column:
    """A column as the sketches take it: other types as text, which tells their values apart."""
    c, dtype = col(name), type_of(df, name)
    return c if isinstance(dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else c.cast("string")


def column_sketches(df: DataFrame, by: Sequence[str] = (), bits: int = SKETCH_BITS, file: str | None = None) -> DataFrame:
    """Per group (and file, under that name) and column: column, dtype, total, non_null and a sketch of the distinct values.

    One scan for all columns, aggregated map-side: the shuffle carries sketches. Kept as a table,
    new files or groups add rows; :func:`merged_report` unites any of them.
    """
    keys = [col(b) for b in by]
    if file:
        keys.append(df.metadataColumn("_metadata")["file_path"].alias(file))
    names = [f.name for f in df.schema.fields if f.name not in by and not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    per_column = [
        F.struct(F.count(col(n)).alias("non_null"), F.hll_sketch_agg(_sketched(df, n), F.lit(bits)).alias("sketch")).alias(f"_{i}") for i, n in enumerate(names)
    ]
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *per_column)
    parts = F.array(
        *[F.struct(F.lit(n).alias("column"), F.lit(type_of(df, n).simpleString()).alias("dtype"), col(f"_{i}")["non_null"].alias("non_null"), col(f"_{i}")["sketch"].alias("sketch")) for i, n in enumerate(names)]
    )
    kept = [*by, *([file] if file else [])]
    return found.select(*[col(k) for k in kept], "total", F.inline(parts)).select(*[col(k) for k in kept], "column", "dtype", "total", "non_null", "sketch")


def merged_report(sketches: DataFrame, by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """Total, non-null and distinct values per column from kept sketches, united over all else; with the relative error."""
    united = sketches.groupBy(*[col(b) for b in by], "column", "dtype").agg(
        F.sum("total").alias("total"), F.sum("non_null").alias("non_null"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_values")
    )
    return united.withColumn("relative_error", F.lit(distinct_error(bits)))


def column_report_approx(df: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """:func:`column_report` in one scan: distinct values estimated, with their relative standard error."""
    return merged_report(column_sketches(df, bits=bits), bits=bits)
