"""Dates as schedules name them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def ds_nodash(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def ts_nodash(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def ds_add(day: Column, days: int) -> Column:
    """A date text moved by days."""
    return F.date_format(F.date_add(F.to_date(day), days), "yyyy-MM-dd")


def ds_format(day: Column, pattern: str, out: str) -> Column:
    """A date text from one pattern to another; null if it doesn't parse."""
    return F.date_format(F.try_to_timestamp(day, F.lit(pattern)), out)


def for_humans(seconds: Column) -> Column:
    """The largest whole unit of a difference in seconds."""
    units = (("year", 31_536_000), ("month", 2_592_000), ("week", 604_800), ("day", 86_400), ("hour", 3600), ("minute", 60), ("second", 1))
    text = F.lit("now")
    for name, size in reversed(units):
        n = F.floor(F.abs(seconds) / size)
        text = F.when(n >= 1, F.concat(n.cast("string"), F.lit(f" {name}"), F.when(n > 1, "s").otherwise(""))).otherwise(text)
    return text


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Whether an interval, open ended where end is null, lies within bounds."""
    return (start >= low) & (F.coalesce(end, F.current_timestamp()) <= high)
