"""Rolling row-count windows, also over series too long for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graticule.functions.aggregates import check_method, reducer
from graticule.functions.columns import col, require
from graticule.functions.ordering import global_index, sortable
from graticule.functions.sizing import GROUP_ROWS, largest_group, settled_side
from graticule.session import cut_lineage, materialize

ROLLING_METHODS = ("mean", "sum", "std", "min", "max", "median")


def rolling(
    df: DataFrame,
    column: str,
    window: int = 7,
    method: str = "mean",
    center: bool = False,
    min_periods: int = 1,
    order_by: str | Sequence[str] = "time",
    partition_by: Sequence[str] | None = None,
    output_column: str | None = None,
    max_group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Statistic over the last (or centred) ``window`` rows in the given order.

    A plain window is used when the largest series is known to fit one task.
    Longer series, grouped or not, are cut into equal blocks whose edge rows are
    copied to the neighbour block, so no task ever sees a whole long series. Windows
    longer than that are put together from parts of blocks and sums of whole ones (a
    median still takes a window's rows into one task).
    ``max_group_rows=None`` skips the measurement for series known to be short,
    such as one row per step of a calendar.
    """
    if column not in df.columns:
        return df
    check_method(method, ROLLING_METHODS)
    if window < 1:
        raise ValueError("window must be at least 1")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    groups = list(partition_by or [])
    require(df, order + groups)
    ahead = (window - 1) // 2 if center else 0
    behind = window - 1 - ahead
    out = output_column or f"{column}_rolling_{method}"

    def statistic(frame) -> Column:
        c = col(column)
        value = reducer(method, c).over(frame) if method != "sum" else F.sum(c).over(frame)
        filled = F.count(c).over(frame)
        return F.when(filled >= min_periods, F.coalesce(value, F.lit(0)) if method == "sum" else value)

    if max_group_rows is None or largest_group(df, groups) <= max_group_rows:
        # rows of equal order go by their other columns, as in the blocks below
        rest = [c for c in df.columns if c not in (*groups, *order) and sortable(df, c)]
        frame = (
            Window.partitionBy(*[col(g) for g in groups])
            .orderBy(*[col(o) for o in [*order, *rest]])
            .rowsBetween(-behind, ahead)
        )
        return df.withColumn(out, statistic(frame))

    if window > max_group_rows and method != "median":
        return _wide(df, column, out, method, behind, ahead, min_periods, order, groups, max_group_rows)
    block_rows = max(max_group_rows, window)
    indexed = global_index(df, groups + order)
    place = F.col("_row") % block_rows
    block = F.floor(F.col("_row") / block_rows)
    homes = [block]
    if behind:
        homes.append(F.when(place >= block_rows - behind, block + 1))
    if ahead:
        homes.append(F.when(place < ahead, block - 1))
    copies = indexed.withColumn("_home", block).withColumn(
        "_block", F.explode(F.filter(F.array(*homes), lambda b: b.isNotNull()))
    )
    frame = (
        Window.partitionBy("_block", *[col(g) for g in groups]).orderBy("_row").rowsBetween(-behind, ahead)
    )
    return (
        copies.withColumn(out, statistic(frame))
        .filter(F.col("_block") == F.col("_home"))
        .select(*[col(c) for c in df.columns], col(out))
    )


# What is carried along a block per method: number, deviations and their squares, ends.
_CARRIED = {"mean": "ns", "sum": "ns", "std": "nsq", "min": "nl", "max": "nh"}


def _wide(
    df: DataFrame, column: str, out: str, method: str, behind: int, ahead: int, min_periods: int, order: list[str], groups: list[str], block_rows: int
) -> DataFrame:
    """Windows longer than a block: the end of one block, whole blocks, and the start of another.

    Running values are kept from each row back to its block's start and on to its end, within its
    series. A window reads the second at its first row, the first at its last row (equal
    joins on the position), and the whole blocks between from running sums over the blocks
    or, for ends, from a table of runs of 1, 2, 4, ... blocks. Sums are of deviations from the mean.
    """
    indexed = global_index(df, groups + order)
    x = col(column).cast("double")
    centre = indexed.agg(F.avg(x)).scalar()
    series = F.struct(F.lit(0).alias("_"), *[col(g).alias(f"g{i}") for i, g in enumerate(groups)]).alias("_series")
    rows = indexed.select("_row", series, x.alias("x"), (x - F.coalesce(centre, F.lit(0.0))).alias("d")).withColumn("_block", F.floor(F.col("_row") / block_rows))
    ends = settled_side(rows.groupBy("_series").agg(F.min("_row").alias("_from"), F.max("_row").alias("_to")))

    kept = _CARRIED[method]
    parts = {"n": F.count("x"), "s": F.sum("d"), "q": F.sum(F.col("d") * F.col("d")), "l": F.min("x"), "h": F.max("x")}
    rows_of = {p: F.coalesce(F.col(p), F.lit(0.0)) if p in "sq" else F.col(p) for p in parts}

    def merged(a: Column, b: Column, part: str) -> Column:
        return F.least(a, b) if part == "l" else F.greatest(a, b) if part == "h" else a + b

    within = Window.partitionBy("_block", "_series").orderBy("_row")
    back, on = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(0, Window.unboundedFollowing)
    carried = rows.withColumns({f"{p}_back": parts[p].over(back) for p in kept} | {f"{p}_on": parts[p].over(on) for p in kept}).drop("x", "d")
    carried = carried.withColumns({f"{p}_{e}": F.coalesce(F.col(f"{p}_{e}"), F.lit(0.0)) for p in kept if p in "sq" for e in ("back", "on")})
    carried = carried.join(ends, "_series").drop("_series")
    first = F.greatest(F.col("_row") - behind, F.col("_from"))
    last = F.least(F.col("_row") + ahead, F.col("_to"))
    carried = materialize(carried.withColumns({"_first": first, "_last": last}), "carried")

    wanted = carried.select("_row", "_first", "_last", "_from", "_to")
    at_first = carried.select(F.col("_row").alias("_first"), *[f"{p}_on" for p in kept])
    at_last = carried.select(F.col("_row").alias("_last"), *[f"{p}_back" for p in kept])
    both = wanted.join(at_first, "_first").join(at_last, "_last")
    b0, b1 = F.floor(F.col("_first") / block_rows), F.floor(F.col("_last") / block_rows)
    both = both.withColumns({"_b0": b0 + 1, "_b1": b1})
    # a window inside one block starts or ends with its series
    inside = F.col("_b0") > F.col("_b1")
    alone = {p: F.when(F.col("_first") == F.col("_from"), F.col(f"{p}_back")).otherwise(F.col(f"{p}_on")) for p in kept}

    # one row per block of rows, so few that one task may order them
    blocks = rows.groupBy("_block").agg(*[parts[p].alias(p) for p in kept]).select("_block", *[rows_of[p].alias(p) for p in kept])
    if method in ("min", "max"):
        p = kept[1]
        runs, count, size, k = [cut_lineage(blocks.select("_block", "n", p))], rows.agg(F.max("_block")).first()[0] or 0, 1, 0
        while 2 * size <= count:
            other = runs[-1].select((F.col("_block") - size).alias("_block"), F.col("n").alias("n2"), F.col(p).alias("p2"))
            joined = runs[-1].join(other, "_block")
            runs.append(cut_lineage(joined.select("_block", (F.col("n") + F.col("n2")).alias("n"), merged(F.col(p), F.col("p2"), p).alias(p))))
            size, k = 2 * size, k + 1
        table = runs[0].withColumn("_k", F.lit(0))
        for i, run in enumerate(runs[1:], 1):
            table = table.unionByName(run.withColumn("_k", F.lit(i)))
        table = settled_side(table)
        many = F.col("_b1") - F.col("_b0")
        level = F.when(many > 0, F.least(F.length(F.bin(many)) - 1, F.lit(k)))
        both = both.withColumns({"_k": level, "_z": F.col("_b1") - F.pow(F.lit(2.0), level).cast("long")})
        for name, place in (("a", "_b0"), ("z", "_z")):
            side = table.select("_k", F.col("_block").alias(place), F.col(p).alias(f"{p}_{name}"))
            both = both.join(side, ["_k", place], "left")
        counts = _running(blocks.select("_block", "n"), ["n"])
        both = _between(both, counts, ["n"])
        value = {p: F.when(inside, alone[p]).otherwise(merged(merged(F.col(f"{p}_on"), F.col(f"{p}_back"), p), merged(F.col(f"{p}_a"), F.col(f"{p}_z"), p), p))}
    else:
        both = _between(both, _running(blocks, list(kept)), list(kept))
        value = {}
    for p in kept:
        if p in "nsq":
            value[p] = F.when(inside, alone[p]).otherwise(F.col(f"{p}_on") + F.col(f"{p}_back") + F.col(f"{p}_mid"))
    n = value["n"]
    if method in ("min", "max"):
        result = value[kept[1]]
    else:
        mean = F.when(n > 0, value["s"] / n)
        result = {"mean": mean + centre, "sum": F.coalesce(value["s"] + n * centre, F.lit(0.0))}.get(method)
        if method == "std":
            result = F.when(n > 1, F.sqrt(F.greatest(value["q"] - value["s"] * value["s"] / n, F.lit(0.0)) / (n - 1)))
    found = both.select("_row", F.when(n >= min_periods, result).alias(out))
    return indexed.join(found, "_row").select(*[col(c) for c in df.columns], col(out))


def _running(blocks: DataFrame, parts: list[str]) -> DataFrame:
    """Sums of all blocks before each one, and one more row behind the last."""
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = blocks.select((F.max("_block") + 1).alias("_block"), *[F.lit(0).alias(p) for p in parts]).filter("_block IS NOT NULL")
    return settled_side(blocks.unionByName(last).select("_block", *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(p) for p in parts]))


def _between(rows: DataFrame, running: DataFrame, parts: list[str]) -> DataFrame:
    """Sums of the blocks from ``_b0`` until before ``_b1``."""
    for name, place in (("lo", "_b0"), ("hi", "_b1")):
        rows = rows.join(running.select(F.col("_block").alias(place), *[F.col(p).alias(f"{p}_{name}") for p in parts]), place, "left")
    return rows.withColumns({f"{p}_mid": F.col(f"{p}_hi") - F.col(f"{p}_lo") for p in parts})
