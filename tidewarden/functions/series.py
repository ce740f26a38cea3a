"""Expressions over one time series: windows ordered by time, ties broken by row id.

Times are microseconds (long) in column ``t``, so that time frames are exact ranges of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from .durations import to_micros


def ordered(*keys: str, t: str = "t", row: str = "iot_id") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(t, row)


def running(*keys: str, t: str = "t", row: str = "iot_id") -> WindowSpec:
    return ordered(*keys, t=t, row=row).rowsBetween(Window.unboundedPreceding, 0)


def trailing(width: str | int, *keys: str, t: str = "t") -> WindowSpec:
    """The rows of (now - width, now]."""
    return Window.partitionBy(*keys).orderBy(t).rangeBetween(1 - to_micros(width), 0)


def centred(width: str | int, *keys: str, t: str = "t") -> WindowSpec:
    """The rows within half a width on either side, ends included."""
    half = to_micros(width) // 2
    return Window.partitionBy(*keys).orderBy(t).rangeBetween(-half, half)


def seconds(micros: Column) -> Column:
    return micros / F.lit(1_000_000.0)


def gradient(value: Column, w: WindowSpec, t: str = "t") -> Column:
    """Second-order differences for uneven spacing, one-sided at the ends; null for single rows and equal times."""
    now = F.col(t)
    hs, hd = seconds(now - F.lag(t).over(w)), seconds(F.lead(t).over(w) - now)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    inner = F.try_divide(hs * hs * after + (hd * hd - hs * hs) * value - hd * hd * before, hs * hd * (hd + hs))
    return F.when(hs.isNull(), F.try_divide(after - value, hd)).when(hd.isNull(), F.try_divide(value - before, hs)).otherwise(inner)


def filled(value: Column, w: WindowSpec) -> Column:
    """The last value that isn't null, up to the row."""
    return F.last(value, ignorenulls=True).over(w)


def changes(flag: Column, w: WindowSpec, run: WindowSpec) -> Column:
    """Number of the block of equal values; the first row begins block 1."""
    before = F.lag(flag).over(w)
    return F.sum(F.when(before.isNull() | (before != flag), 1).otherwise(0)).over(run)


def round_second(micros: Column) -> Column:
    """Microseconds rounded to whole seconds, halves to even."""
    second, rest = F.floor(micros / 1_000_000), F.pmod(micros, F.lit(1_000_000))
    up = (rest > 500_000) | ((rest == 500_000) & (F.pmod(second, F.lit(2)) == 1))
    return ((second + up.cast("long")) * 1_000_000).cast("long")
