"""Named reductions with the missing-value rules of the data model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("mean", "sum", "std", "min", "max", "median", "count")
ARRAY_METHODS = METHODS + ("var",)
GRID_METHODS = ARRAY_METHODS + ("prod", "first", "last", "any", "all")


# Reductions that need the order of the rows or look at truth only.
ORDERED_METHODS = ("first", "last")
LOGICAL_METHODS = ("any", "all")


def array_reducer(method: str, c: Column, order: Sequence[Column]) -> Column:
    """Further reductions the way arrays do them.

    ``prod`` skips missing values and is 1 without any; ``first`` and ``last`` are the first
    and last values that are not missing in the given order (rows of equal order: the
    smaller, or larger, value); ``any`` and ``all`` ask for values other than 0, and a missing
    one counts as such, as NaN does.
    """
    if method == "prod":
        return F.coalesce(F.product(c), F.lit(1.0))
    if method in ORDERED_METHODS:
        place = F.when(c.isNotNull(), F.struct(*[o.alias(f"_{i}") for i, o in enumerate([*order, c])]))
        return F.min_by(c, place) if method == "first" else F.max_by(c, place)
    if method in LOGICAL_METHODS:
        true = F.coalesce(c.cast("double") != 0, F.lit(True))
        return F.bool_or(true) if method == "any" else F.bool_and(true)
    raise ValueError(f"Unknown aggregation method: {method}")


def check_method(method: str, known: tuple[str, ...] = METHODS) -> None:
    if method not in known:
        raise ValueError(f"Unknown aggregation method: {method}. Known: {list(known)}")


def reducer(method: str, c: Column, ddof: int = 1) -> Column:
    """Aggregate over the non-missing values; a sum over none of them is 0."""
    if method == "mean":
        return F.avg(c)
    if method == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if method == "std":
        return F.stddev_samp(c) if ddof else F.stddev_pop(c)
    if method == "var":
        return F.var_samp(c) if ddof else F.var_pop(c)
    if method == "min":
        return F.min(c)
    if method == "max":
        return F.max(c)
    if method == "median":
        return F.percentile(c, F.lit(0.5))
    if method == "count":
        return F.count(c)
    raise ValueError(f"Unknown aggregation method: {method}")


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson r over pairs with both values; NULL for constant or short input."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
