"""Generated tables: time spines, day chunks, request manifests, grids, cells; densifying."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import healpix
from gridlake.functions.timeaxis import freq_seconds


def ntz(label) -> Column:
    """A literal (ISO text or datetime) or a column as a zone-free timestamp."""
    c = label if isinstance(label, Column) else F.lit(str(label))
    return c.cast("timestamp_ntz")


def regular_times(start, end, freq: str) -> Column:
    """Array of the timestamps from start to end, both included."""
    step = F.make_dt_interval(secs=F.lit(freq_seconds(freq)))
    return F.sequence(ntz(start), ntz(end), step)


def time_spine(source: SparkSession | DataFrame, start, end, freq: str, time: str = "time") -> DataFrame:
    """Regular timestamps. ``source`` is a session, or a one-row table whose columns give the ends."""
    one = source.range(1) if isinstance(source, SparkSession) else source
    return one.select(F.explode(regular_times(start, end, freq)).alias(time))


def day_chunks(source: SparkSession | DataFrame, start, end, days: int) -> DataFrame:
    """Consecutive ranges of ``days`` days, both ends included; the last one is clipped."""
    one = source.range(1) if isinstance(source, SparkSession) else source
    first = (start if isinstance(start, Column) else F.lit(str(start))).cast("date")
    last = (end if isinstance(end, Column) else F.lit(str(end))).cast("date")
    starts = F.sequence(first, last, F.make_dt_interval(days=F.lit(days)))
    return one.select(F.posexplode(starts).alias("chunk", "chunk_start"), last.alias("_last")).select(
        F.col("chunk").cast("bigint").alias("chunk"),
        "chunk_start",
        F.least(F.date_add("chunk_start", days - 1), "_last").alias("chunk_end"),
    )


def request_manifest(source: SparkSession | DataFrame, start_year, end_year, step_hours: int) -> DataFrame:
    """One row per (year, month, day, hour) to request. Only dates that exist are listed."""
    one = source.range(1) if isinstance(source, SparkSession) else source
    first = start_year if isinstance(start_year, Column) else F.lit(start_year)
    last = end_year if isinstance(end_year, Column) else F.lit(end_year)
    day = F.explode(F.sequence(
        F.make_date(first, F.lit(1), F.lit(1)), F.make_date(last, F.lit(12), F.lit(31))
    ))
    hour = F.explode(F.sequence(F.lit(0), F.lit(23), F.lit(step_hours)))
    return one.select(day.alias("_day")).select("_day", hour.alias("hour")).select(
        F.year("_day").alias("year"), F.month("_day").alias("month"),
        F.dayofmonth("_day").alias("day"), "hour",
    )


def grid_spine(spark: SparkSession, nlat: int, nlon: int, resolution: float | None = None) -> DataFrame:
    """Reference axes: latitudes from 90 down, longitudes from 0 up, both with one resolution."""
    res = 360.0 / nlon if resolution is None else float(resolution)
    i = F.col("id")
    return spark.range(nlat * nlon).select(
        F.floor(i / nlon).cast("bigint").alias("lat_idx"), (i % nlon).alias("lon_idx"),
    ).withColumns({
        "lat": F.lit(90.0) - F.col("lat_idx") * res,
        "lon": F.col("lon_idx") * res,
    })


def hpx_cells(spark: SparkSession, nside: int) -> DataFrame:
    """Static table of all cells: index, face layout, centre, and place on its ring."""
    cells = spark.range(healpix.npix(nside)).withColumnRenamed("id", "pix")
    cells = healpix.with_face_height_width(cells, nside)
    return healpix.with_centre(cells, nside).select(
        "pix", "face", "height", "width", "lat", "lon", "ring", "ring_pos"
    )


def densify(df: DataFrame, cells: DataFrame, keys: Sequence[str], times: Column, time: str = "time") -> DataFrame:
    """Give every cell a row at every time; where ``df`` has none, its values are NULL.

    Each cell row generates its own times, so no table is paired with another.
    """
    slots = cells.select(*keys, F.explode(times).alias(time))
    return slots.join(df, [*keys, time], "left")
