"""Time labels: zone-free arithmetic on TIMESTAMP_NTZ, parsing, truncation, day-of-year."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per unit of a frequency such as "3h", "D" or "2D" (fixed values).
UNIT_SECONDS = {"s": 1, "min": 60, "h": 3600, "d": 86400}


def freq_seconds(freq: str) -> int:
    """``"3h"`` -> 10800, ``"D"`` -> 86400, ``"2D"`` -> 172800."""
    match = re.fullmatch(r"(\d*)\s*([A-Za-z]+)", freq.strip())
    if match is None or match.group(2).lower() not in UNIT_SECONDS:
        raise ValueError(f"unknown frequency: {freq!r}")
    return int(match.group(1) or 1) * UNIT_SECONDS[match.group(2).lower()]


def window_rows(window: str, step: str) -> int:
    """Rows of a trailing window: the window length over the step, truncated."""
    return freq_seconds(window) // freq_seconds(step)


def window_rows_col(window_seconds: Column, step_seconds: Column) -> Column:
    """The same division on integer-second columns."""
    return F.floor(window_seconds / step_seconds).cast("bigint")


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-free timestamp, whatever the session zone."""
    days = F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("bigint")
    clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return days * 86400 + clock


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from one zone-free timestamp to another, with the fraction, as DOUBLE."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def exact_seconds(time: Column) -> Column:
    """Seconds since 1970-01-01 with the fraction, as DOUBLE."""
    return elapsed_seconds(F.lit("1970-01-01").cast("timestamp_ntz"), time)


def truncate_hour(time: Column) -> Column:
    return F.date_trunc("hour", time).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    return F.to_timestamp_ntz(text)


def frame_label(time: Column) -> Column:
    """Label such as ``20010103T0000``."""
    return F.date_format(time, "yyyyMMdd'T'HHmm")


def doy_key(time: Column) -> Column:
    """Day of year 1..366; 29 February is 60 and moves later days on by one in leap years."""
    return F.dayofyear(time)


def year_block(time: Column) -> Column:
    """Calendar year: the default block that bounds how much of one series a task holds."""
    return F.year(time)
