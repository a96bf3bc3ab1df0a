"""Calendar keys and resampling buckets over zone-less timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.columns import col, type_of

NTZ = T.TimestampNTZType()

# Resampling frequencies. Units that may be multiplied, in seconds; calendar
# units with the date_trunc unit and their months; week ends.
SECONDS = {"min": 60, "h": 3_600, "D": 86_400}
MONTHS = {"M": ("MONTH", 1), "Q": ("QUARTER", 3), "Y": ("YEAR", 12)}
WEEK_ENDS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
DAY = SECONDS["D"]

# Calendar groupings and the most distinct keys each can have.
CALENDAR_KEYS = {"month": 12, "dayofyear": 366, "season": 4, "hour": 24}

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def as_time(df: DataFrame, name: str) -> Column:
    """The time column as TIMESTAMP_NTZ; text and dates are converted."""
    c = col(name)
    return c if isinstance(type_of(df, name), T.TimestampNTZType) else c.cast(NTZ)


def _parsed(freq: str) -> tuple[str, int | str]:
    """(unit, how many) of a clock frequency, ("W", last day) or ("M", "S" or "E") and so on."""
    if clock := re.fullmatch(r"([1-9]\d*)?(min|h|D)", freq):
        return clock[2], int(clock[1] or 1)
    if week := re.fullmatch(r"W(?:-([A-Z]{3}))?", freq):
        if (week[1] or "SUN") in WEEK_ENDS:
            return "W", week[1] or "SUN"
    if months := re.fullmatch(r"([MQY])([SE])", freq):
        return months[1], months[2]
    raise ValueError(
        f"Unknown frequency: {freq}. Known: min, h, D (also multiplied, as in 6h), W, W-MON to W-SUN, MS, ME, QS, QE, YS, YE"
    )


def check_frequency(freq: str) -> None:
    _parsed(freq)


def needs_origin(freq: str) -> bool:
    """Whether buckets are counted from the first day of the data, as those that do not divide a day are."""
    unit, n = _parsed(freq)
    return unit in SECONDS and DAY % (SECONDS[unit] * n) != 0


def bucket(t: Column, freq: str, origin: Column | None = None) -> Column:
    """Start of the bucket a time falls into; weeks are named by their last day.

    ``origin`` is the first day of the data, from which buckets that do not divide a day count.
    Month, quarter and year ends give the start here, see :func:`label`.
    """
    unit, n = _parsed(freq)
    if unit == "W":
        return F.next_day(F.date_sub(F.to_date(t), 1), n).cast(NTZ)
    if unit in MONTHS:
        return F.date_trunc(MONTHS[unit][0], t).cast(NTZ)
    if n == 1:
        return F.date_trunc({"min": "MINUTE", "h": "HOUR", "D": "DAY"}[unit], t).cast(NTZ)
    width = SECONDS[unit] * n
    start = F.date_trunc("DAY", t if origin is None else origin).cast(NTZ)
    passed = F.unix_seconds(t.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
    # plain seconds on the zone-less clock
    return start + F.make_dt_interval(secs=F.floor(passed / width) * width)


def label(start: Column, freq: str) -> Column:
    """The bucket's name: its start, or its last day for month, quarter and year ends."""
    unit, kind = _parsed(freq)
    if unit not in MONTHS or kind == "S":
        return start
    return F.last_day(F.add_months(F.to_date(start), MONTHS[unit][1] - 1)).cast(NTZ)


def bucket_end(start: Column, freq: str) -> Column:
    """The first instant after the bucket that :func:`bucket` names so."""
    if _parsed(freq)[0] == "W":
        return start + F.expr("INTERVAL '1' DAY")
    return start + step(freq)


def step(freq: str, times: int = 1) -> Column:
    """Distance between two neighbouring buckets, or so many of them."""
    unit, n = _parsed(freq)
    if unit in MONTHS:
        return F.expr(f"INTERVAL '{MONTHS[unit][1] * times}' MONTH")
    return F.expr(f"INTERVAL '{(7 * DAY if unit == 'W' else SECONDS[unit] * n) * times}' SECOND")


def calendar_key(t: Column, unit: str) -> Column:
    """Integer key of a calendar grouping; seasons are DJF=1 .. SON=4."""
    if unit == "month":
        key = F.month(t)
    elif unit == "dayofyear":
        key = F.dayofyear(t)
    elif unit == "hour":
        key = F.hour(t)
    elif unit == "season":
        key = F.floor((F.month(t) % 12 + 3) / 3)
    elif unit == "year":
        key = F.year(t)
    elif unit == "quarter":
        key = F.quarter(t)
    elif unit == "day":
        key = F.dayofmonth(t)
    else:
        raise ValueError(f"Unknown calendar unit: {unit}")
    return key.cast("bigint")


def days(df: DataFrame, name: str) -> Column:
    """A time column as fractional days, a numeric one as it is."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.NumericType):
        return col(name).cast("double")
    return F.unix_micros(col(name).cast("timestamp")) / F.lit(86_400_000_000.0)
