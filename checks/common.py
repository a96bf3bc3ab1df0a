"""Shared inputs of the checks: the gridded view of lineitem and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graticule.session import configure

Query = Callable[[SparkSession, str], DataFrame]

# The same view in both engines: dims time, level, lat, lon; variables v (with gaps) and w.
GRID = """
grid AS (
  SELECT l_shipdate AS time,
         CAST(l_linenumber AS DOUBLE) AS level,
         CAST(l_suppkey % 36 AS DOUBLE) * 5.0 - 87.5 AS lat,
         CAST(l_partkey % 72 AS DOUBLE) * 5.0 - 177.5 AS lon,
         CASE WHEN l_tax = 0.0 THEN NULL ELSE l_extendedprice END AS v,
         l_discount AS w
  FROM lineitem)
"""
OTHER = """
other AS (
  SELECT o_orderdate AS time,
         CAST(o_custkey % 36 AS DOUBLE) * 5.0 - 87.5 AS latitude,
         CAST(o_orderkey % 72 AS DOUBLE) * 5.0 - 177.5 AS longitude,
         o_totalprice AS v
  FROM orders)
"""
SERIES = "series AS (SELECT time, AVG(v) AS v FROM grid GROUP BY time)"
DIMS = ["time", "level", "lat", "lon"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def grid(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("time"),
        F.col("l_linenumber").cast("double").alias("level"),
        ((F.col("l_suppkey") % 36).cast("double") * 5.0 - 87.5).alias("lat"),
        ((F.col("l_partkey") % 72).cast("double") * 5.0 - 177.5).alias("lon"),
        F.when(F.col("l_tax") == 0.0, None).otherwise(F.col("l_extendedprice")).alias("v"),
        F.col("l_discount").alias("w"),
    )


def other(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderdate").alias("time"),
        ((F.col("o_custkey") % 36).cast("double") * 5.0 - 87.5).alias("latitude"),
        ((F.col("o_orderkey") % 72).cast("double") * 5.0 - 177.5).alias("longitude"),
        F.col("o_totalprice").alias("v"),
    )


def with_grid(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([GRID, *more]) + body


# Both engines add numbers up in their own order, so results are compared rounded.
# The small shift keeps averages of 2-decimal prices off the rounding boundary.
def _shift(d: int) -> str:
    return f"17e-{d + 3}"


def r(c: Column | str, d: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(float(_shift(d))), d)


def rs(text: str, d: int = 4) -> str:
    return f"ROUND(({text}) + {_shift(d)}, {d})"


def rounded(df: DataFrame, *names: str, d: int = 4) -> DataFrame:
    return df.withColumns({n: r(n, d) for n in names})
