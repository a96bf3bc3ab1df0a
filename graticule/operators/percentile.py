"""Percentiles, exact at any group size.

Spark's exact ``percentile`` keeps one counter per distinct value of a group in
the memory of one task. That is fine for groups of known modest size. For larger
ones a quantile sketch per group brackets each wanted rank; one more read counts
what lies outside the brackets and keeps the values inside, and what is still too
much there is narrowed by histograms (pre-aggregated map-side) of the kept values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graticule.functions.columns import col
from graticule.functions.sizing import BROADCAST_ROWS, GROUP_ROWS, settled_side
from graticule.operators.sketches import SKETCH_K, merge_sketches, quantile_sketches, quantiles, rank_error
from graticule.session import cut_lineage, materialize

REFINE_BINS = 4096
BRACKET = 2.0  # rank errors to each side of a wanted rank


def percentile_name(var: str, p: float) -> str:
    return f"{var}_p{p * 100:g}".replace(".", "_")


def percentiles(
    df: DataFrame,
    var: str,
    ps: Sequence[float] = (0.1, 0.5, 0.9),
    by: Sequence[str] | None = None,
    approx: bool = False,
    accuracy: int = 10_000,
    max_group_rows: int | None = GROUP_ROWS,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Percentiles of a variable, over everything or per group, one column each.

    Also returns ``{var}_spread``: the last percentile minus the first. Kept ``sketches``
    (see :func:`quantile_sketches`) of the same rows, by ``by`` or finer, spare the
    exact search all its reads but one; see :func:`sketch_percentiles` for results from them alone.
    """
    keys = list(by or [])
    ps = [float(p) for p in ps]
    if approx:
        # a data value, not an interpolation
        values = F.percentile_approx(col(var).cast("double"), ps, accuracy)
        out = df.groupBy(*[col(k) for k in keys]).agg(values.alias(var))
    else:
        out = grouped_percentiles(df, keys, [var], ps, max_group_rows, sketches)
    named = [col(var)[i].alias(percentile_name(var, p)) for i, p in enumerate(ps)]
    spread = (col(var)[len(ps) - 1] - col(var)[0]).alias(f"{var}_spread")
    return out.select(*[col(k) for k in keys], *named, spread)


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ps: Sequence[float],
    max_group_rows: int | None = GROUP_ROWS,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """keys + one array of percentiles per value column.

    ``max_group_rows=None`` skips measuring groups known to be small. With large groups
    the data are read three times at most: for the sizes, for the sketches of large groups,
    and for the values around the wanted ranks (the last two per value column). A bracket
    that misses its rank, by a chance far below 1 %, costs reads, never the result.
    """
    keys, values, ps = list(keys), list(values), [float(p) for p in ps]
    if max_group_rows is None:
        return _in_memory(df, keys, values, ps)
    key = (F.struct(*[col(k).alias(k) for k in keys]) if keys else F.struct(F.lit(1).alias("_all"))).alias("_key")
    if sketches is None:
        sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    else:
        sketches = merge_sketches(sketches, keys).select(key, "sketch", "n")
        sizes = sketches
    hot = cut_lineage(sizes.filter(F.col("n") > max_group_rows))
    if hot.isEmpty():
        return _in_memory(df, keys, values, ps)
    keyed = df.select(key, *[col(v) for v in values])
    out = None
    for v in values:
        found = _bracketed(keyed, hot, v, ps, max_group_rows)
        out = found if out is None else out.join(found, "_key")
    return out.select(*[F.col("_key")[k].alias(k) for k in keys], *[col(v) for v in values])


def _in_memory(df: DataFrame, keys: list[str], values: list[str], ps: list[float]) -> DataFrame:
    ps_array = F.array(*[F.lit(p) for p in ps])
    return df.groupBy(*[col(k) for k in keys]).agg(
        *[F.percentile(col(v).cast("double"), ps_array).alias(v) for v in values]
    )


def _bracketed(keyed: DataFrame, hot: DataFrame, var: str, ps: list[float], max_rows: int) -> DataFrame:
    """Percentiles of all groups from one table of values near the wanted ranks and counts of all others."""
    x = F.col("x")
    every = keyed.select("_key", col(var).cast("double").alias("x"))
    if "sketch" not in hot.columns:
        own = every.join(settled_side(hot.select("_key")), "_key", "left_semi")
        hot = quantile_sketches(own, "x", ["_key"])
    error = BRACKET * rank_error(SKETCH_K)

    def ends(by: float) -> Column:
        return quantiles([min(1.0, max(0.0, p + by)) for p in ps])

    brackets = settled_side(hot.select("_key", "n", ends(-error).alias("los"), ends(error).alias("his")))
    # a value lies in a bracket, or between two of them: told by the brackets that end before it
    endless = (F.abs(x) == F.lit(float("inf"))) | F.isnan(x)
    inside = F.exists(F.arrays_zip("los", "his"), lambda b: x.between(b["los"], b["his"]))
    inside = F.col("n").isNull() | x.isNull() | endless | F.coalesce(inside, F.lit(False))
    placed = every.join(brackets, "_key", "left").select("_key", "x", F.col("n").isNotNull().alias("hot"), inside.alias("inside"), F.coalesce(F.size(F.filter("his", lambda h: h < x)), F.lit(0)).alias("after"))
    counted = placed.groupBy("_key", "hot", "inside", "after", F.when(F.col("inside"), x).alias("value"))
    entries = materialize(counted.agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")), "percentiles")
    small = entries.filter(~F.col("hot")).groupBy("_key").agg(F.percentile(F.col("value"), F.array(*[F.lit(p) for p in ps]), F.col("c")).alias(var))
    return small.unionByName(_large(every, entries.filter("hot"), var, ps, max_rows))


def _large(every: DataFrame, entries: DataFrame, var: str, ps: list[float], max_rows: int) -> DataFrame:
    """Percentiles of large groups, each wanted rank narrowed to one value."""
    valued = entries.filter(F.col("lo").isNotNull())
    # infinite values are segments of their own; a group has few segments
    endless = F.when((F.abs("lo") == F.lit(float("inf"))) | F.isnan("lo"), F.col("lo"))
    segments = valued.groupBy("_key", "inside", "after", endless.alias("endless")).agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    upto = Window.partitionBy("_key").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
    segments = cut_lineage(segments.withColumn("start", F.sum("c").over(upto) - F.col("c")))
    totals = segments.groupBy("_key").agg(F.sum("c").alias("n"))
    wanted = totals.select("_key", "n", F.posexplode(F.array(*[F.lit(p) for p in ps])).alias("i", "p")).withColumn("at", F.col("p") * (F.col("n") - 1))
    ranks = wanted.select("_key", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    ranks = ranks.join(segments, "_key").filter((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("c")))
    ranks = cut_lineage(ranks.select("_key", "rank", "lo", "hi", F.col("start").alias("below"), F.col("c").alias("inside"), F.col("inside").alias("kept")))
    near = valued.filter(F.col("inside") & endless.isNull()).select("_key", F.col("value").alias("x"), "c")
    found = _narrowed(near, ranks.filter("kept").drop("kept"), max_rows)
    missed = ranks.filter(~F.col("kept")).drop("kept")
    if not missed.isEmpty():
        rows = every.filter(F.col("x").isNotNull()).withColumn("c", F.lit(1))
        found = found.unionByName(_narrowed(rows, missed, max_rows))
    low = found.select("_key", F.col("rank").alias("r0"), F.col("value").alias("v0"))
    high = found.select("_key", F.col("rank").alias("r1"), F.col("value").alias("v1"))
    part: Column = F.col("at") - F.floor("at")
    settled = (
        wanted.withColumn("r0", F.floor("at"))
        .withColumn("r1", F.ceil("at"))
        .join(low, ["_key", "r0"])
        .join(high, ["_key", "r1"])
        .withColumn("value", F.when(part == 0, F.col("v0")).otherwise(F.col("v0") * (1 - part) + F.col("v1") * part))
        .groupBy("_key")
        # one entry per wanted percentile
        .agg(F.sort_array(F.collect_list(F.struct("i", "value"))).alias("_list"))
        .select("_key", F.transform("_list", lambda e: e["value"]).alias(var))
    )
    # groups without any value
    empty = entries.select("_key").distinct().join(totals, "_key", "left_anti").withColumn(var, F.lit(None).cast("array<double>"))
    return settled.unionByName(empty)


def _narrowed(x: DataFrame, ranks: DataFrame, max_rows: int) -> DataFrame:
    """The value at each rank, from rows (_key, x, how often) of which those between lo and hi are in play."""
    unsettled = (F.col("lo") < F.col("hi")) & (F.col("inside") > max_rows)
    while not ranks.filter(unsettled).isEmpty():
        ranks = cut_lineage(_narrow(x, ranks.filter(unsettled)).unionByName(ranks.filter(~unsettled)))
    settled = ranks.filter(~(F.col("lo") < F.col("hi"))).select("_key", "rank", F.col("lo").alias("value"))
    open_ranks = ranks.filter(F.col("lo") < F.col("hi"))
    # each interval holds at most max_rows rows here
    upto = Window.partitionBy("_key", "lo", "hi").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _rows_inside(x, open_ranks).groupBy("_key", "lo", "hi", "x").agg(F.sum("c").alias("c")).withColumn("_through", F.sum("c").over(upto))
    picked = (
        open_ranks.join(ranked, ["_key", "lo", "hi"])
        .filter((F.col("below") + F.col("_through") - F.col("c") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("_through")))
        .select("_key", "rank", F.col("x").alias("value"))
    )
    return settled.unionByName(picked)


def _rows_inside(x: DataFrame, ranks: DataFrame) -> DataFrame:
    """Rows of the open intervals; several ranks may share one interval."""
    intervals = ranks.select("_key", "lo", "hi").distinct()
    # ranks is checkpointed, counting it is cheap
    intervals = F.broadcast(intervals) if ranks.count() <= BROADCAST_ROWS else intervals
    return x.join(intervals, "_key").filter(F.col("x").between(F.col("lo"), F.col("hi")))


def _narrow(x: DataFrame, ranks: DataFrame) -> DataFrame:
    """Replace each rank's interval by the ends of the bin that holds the rank."""
    # halves, so that the width of the widest interval is finite, too
    position = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * REFINE_BINS
    bins = (
        _rows_inside(x, ranks)
        .withColumn("bin", F.least(F.floor(position), F.lit(REFINE_BINS - 1)))
        .groupBy("_key", "lo", "hi", "bin")
        .agg(F.sum("c").alias("c"), F.min("x").alias("new_lo"), F.max("x").alias("new_hi"))
    )
    # at most REFINE_BINS rows per interval reach this window
    upto = Window.partitionBy("_key", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("through", F.sum("c").over(upto))
    return (
        ranks.join(bins, ["_key", "lo", "hi"])
        .withColumn("start", F.col("below") + F.col("through") - F.col("c"))
        .filter((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("c")))
        .select(
            "_key", "rank", F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"),
            F.col("start").alias("below"), F.col("c").alias("inside"),
        )
    )
