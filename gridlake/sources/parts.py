"""Stored fields cut by time: a folder for each period, and within it cells and times that lie together.

The column ``part`` names a row's period (``y2001``, ``m2001-03``, ``d2001-03-05``); labels sort as time does.
A slice of time reads the folders of its periods. Within a period rows follow the interleaved bits of time and
nested pixel, in ``files`` files, so a file covers a patch of the sphere for a stretch of time, and a range of
cells skips the files (and row groups) whose least and largest pixel say that they hold none of it. Parts can be
replaced one by one, which is what an incremental build does.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.cluster import scratch_path, stage_table
from gridlake.functions import healpix
from gridlake.functions.timeaxis import epoch_seconds

# Of each period: letter and pattern of its label (for Spark and for Python), and its longest length in seconds.
PERIODS = {"year": ("y", "yyyy", "%Y", 366 * 86400), "month": ("m", "yyyy-MM", "%Y-%m", 31 * 86400),
           "day": ("d", "yyyy-MM-dd", "%Y-%m-%d", 86400)}
CURVE_BITS = 16


def part_of(time: Column, period: str = "year") -> Column:
    letter, pattern, _, _ = PERIODS[period]
    return F.concat(F.lit(letter), F.date_format(time, pattern))


def part_label(time: datetime, period: str = "year") -> str:
    letter, _, pattern, _ = PERIODS[period]
    return letter + time.strftime(pattern)


def part_span(part: str) -> tuple[datetime, datetime]:
    """First moment of a part and of the next one."""
    _, _, pattern, seconds = next(p for p in PERIODS.values() if p[0] == part[0])
    start = datetime.strptime(part[1:], pattern)
    past = start + timedelta(seconds=seconds)
    return start, past if part[0] == "d" else past.replace(month=1, day=1) if part[0] == "y" else past.replace(day=1)


def parts_between(start: datetime, end: datetime, period: str = "year") -> list[str]:
    """Labels of the periods that meet the span, both ends included."""
    out = []
    while start <= end:
        out.append(part_label(start, period))
        start = part_span(out[-1])[1]
    return out


def curve(time: Column, pix: Column, nside: int, period: str = "year") -> Column:
    """Interleaved bits of the place in the period and of the nested pixel, 2 * CURVE_BITS of them."""
    seconds = PERIODS[period][3]
    first = F.date_trunc(period, time).cast("timestamp_ntz")
    at = F.floor((epoch_seconds(time) - epoch_seconds(first)) * (1 << CURVE_BITS) / F.lit(seconds)).cast("bigint")
    cell = F.floor(pix * F.lit(1 << CURVE_BITS) / F.lit(healpix.npix(nside))).cast("bigint")
    return healpix.interleave(cell, at, 1 << CURVE_BITS)


def write_parts(df: DataFrame, path: str, period: str = "year", time: str = "time", nside: int | None = None,
                cell: Sequence[str] = (), files: int = 4, by: Sequence[str] = (), only: Iterable[str] | None = None) -> None:
    """Write ``df`` with a folder for each period and at most ``files`` files in each.

    With ``nside`` the field has a column ``pix`` and is laid out along ``curve``; otherwise ``cell`` names the columns
    that order it, time after them, and files are cut by their hash. ``by`` names columns whose values get folders
    above the periods. Rows without a time go to the part ``none``.

    Without ``only`` the folder is written anew. With it, these parts are replaced and no other is touched; one
    for which ``df`` has no rows stays as it is. The new rows may be computed from the old: they are written to the
    shared folder before any part goes.
    """
    part = F.coalesce(part_of(F.col(time), period), F.lit("none"))
    if only is not None:
        df = stage_table(df.drop("part").withColumn("part", part).filter(F.col("part").isin(sorted(only))), "parts")
    if nside is None:
        placed = df.withColumns({"part": part, "_chunk": F.pmod(F.xxhash64(*(cell or [time])), F.lit(files))})
        order = [*by, "part", *cell, time]
    else:
        along = F.coalesce(curve(F.col(time), F.col("pix").cast("bigint"), nside, period), F.lit(0).cast("bigint"))
        placed = df.withColumns({"part": part, "_along": along})
        placed = placed.withColumn("_chunk", F.shiftright(F.col("_along") * files, 2 * CURVE_BITS))
        order = [*by, "part", "_along", "pix"]
    placed.repartition(*by, "part", "_chunk").sortWithinPartitions(*order).drop("_chunk", "_along").write \
        .partitionBy(*by, "part").mode("overwrite") \
        .option("partitionOverwriteMode", "static" if only is None else "dynamic").parquet(path)


def read_parts(spark: SparkSession, path: str, parts: Iterable[str] | None = None) -> DataFrame:
    """A stored field, or the named parts of it; other folders are not read."""
    df = spark.read.parquet(path)
    return df if parts is None else df.filter(F.col("part").isin(sorted(parts)))


def read_slice(spark: SparkSession, path: str, start: datetime, end: datetime, period: str = "year", time: str = "time") -> DataFrame:
    """The rows from ``start`` to ``end``, both included, without the column ``part``."""
    some = read_parts(spark, path, parts_between(start, end, period))
    return some.filter(F.col(time).between(F.lit(start.isoformat()).cast("timestamp_ntz"), F.lit(end.isoformat()).cast("timestamp_ntz"))).drop("part")


def stage_parts(df: DataFrame, name: str, period: str = "year", **layout) -> DataFrame:
    """Write ``df`` once to the shared folder, cut by time, and read it back without the column ``part``.

    Filters on the part reach the folders, those on pixels the files; ``layout`` as of ``write_parts``.
    """
    path = scratch_path(df.sparkSession, name)
    write_parts(df, path, period, **layout)
    return df.sparkSession.read.parquet(path).drop("part")
