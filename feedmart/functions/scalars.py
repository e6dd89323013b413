"""Scalar column functions shared by the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals, rounding the scaled double half away from zero.

    `round(x, 2)` rounds the decimal text of x, so 1.005 becomes 1.01; rounding
    the scaled value gives 1.0, as the SQL warehouse does.
    """
    return F.round(value * 100, 0) / 100


def mean(column: str) -> Column:
    """Average of an integer column from exact integer sums.

    `avg` adds doubles, whose result depends on the order of the partial sums
    once they pass 2^53; a bigint sum does not.
    """
    return F.sum(column) / F.count(column)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a UTC wall-clock timestamp, whatever the session time zone.

    Days and the rest are added apart: an interval's seconds end at 10^12.
    """
    day = F.floor(seconds / 86400).cast("int")
    rest = F.pmod(seconds, F.lit(86400))
    return F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(days=day, secs=rest)


def iso_to_timestamp(text: Column) -> Column:
    """ISO text as a UTC wall-clock timestamp; text that is no timestamp raises under ANSI."""
    return text.cast("timestamp").cast("timestamp_ntz")
