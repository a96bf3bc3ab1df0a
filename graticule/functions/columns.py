"""Column lookup, type tests and literals that keep predicates pushable."""

from __future__ import annotations

import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)
INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, TIME_TYPES)


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if is_numeric(f.dataType) or (booleans and isinstance(f.dataType, T.BooleanType))
    ]


def require(df: DataFrame, names: Iterable[str], what: str = "Columns") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} {missing} not found. Available: {df.columns}")


def not_null(names: Iterable[str]) -> Column:
    """True where every named column has a value."""
    condition = F.lit(True)
    for name in names:
        condition = condition & col(name).isNotNull()
    return condition


def nan_to_null(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Missing values are NULL from here on; field metadata is kept.

    Leave coordinates out: wrapping them would hide filters on them from the
    file reader.
    """
    wanted = set(df.columns if names is None else names)
    projected = []
    for field in df.schema.fields:
        c = col(field.name)
        if field.name in wanted and isinstance(field.dataType, FLOAT_TYPES):
            c = F.when(~F.isnan(c), c).alias(field.name, metadata=field.metadata or {})
        projected.append(c)
    return df.select(*projected)


def typed(dtype: T.DataType, value: Any) -> Column:
    """A literal in the column's own type where that loses nothing."""
    if is_time(dtype):
        text = value if isinstance(value, str) else str(getattr(value, "isoformat", lambda: value)())
        return F.lit(text).cast(dtype)
    if isinstance(value, bool) or value is None:
        return F.lit(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(dtype, INTEGER_TYPES) and isinstance(value, float) and value.is_integer():
        value = int(value)
    if isinstance(dtype, T.FloatType) and isinstance(value, (int, float)):
        return F.lit(value).cast(dtype)  # 0.1 as a 32-bit label is not 0.1 as a double
    return F.lit(value)


def equals(df: DataFrame, name: str, value: Any) -> Column:
    c = col(name)
    return c.isNull() if value is None else c == typed(type_of(df, name), value)


def one_of(df: DataFrame, name: str, values: Iterable[Any]) -> Column:
    literals = [typed(type_of(df, name), v) for v in values]
    return col(name).isin(*literals) if literals else F.lit(False)


def at_least(df: DataFrame, name: str, value: Any) -> Column:
    dtype = type_of(df, name)
    if isinstance(dtype, INTEGER_TYPES) and isinstance(value, float):
        value = math.ceil(value)
    return col(name) >= typed(dtype, value)


def at_most(df: DataFrame, name: str, value: Any) -> Column:
    dtype = type_of(df, name)
    if isinstance(dtype, INTEGER_TYPES) and isinstance(value, float):
        value = math.floor(value)
    return col(name) <= typed(dtype, value)
