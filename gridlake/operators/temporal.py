"""Operators along the time axis: rolling statistics, gap filling, alignment to another axis."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.cluster import broadcast_within, stage_table
from gridlake.functions.timeaxis import (
    elapsed_seconds, epoch_seconds, freq_seconds, truncate_hour, window_rows, year_block,
)
from gridlake.operators.axis import axis_map, axis_maps, axis_positions, with_valid_neighbours

# Steps of the time axis per block of a rolling window.
ROLLING_BLOCK = 4096


def _over_trailing_rows(df: DataFrame, keys: Sequence[str], time: str, n: int, step: str | None, make,
                        axis: DataFrame | None = None) -> DataFrame:
    """Evaluate ``make(window)`` over the trailing ``n`` places of the time axis, per series.

    Places are counted on the axis, so a row that is absent counts as a missing value. A regular
    axis needs only its ``step``. Otherwise its times are numbered first: those of ``axis``, if the caller has
    them (a row at another time is an error), else the field's own, which reads the time column once more. A series is cut into blocks; the last n-1 rows of a block are also handed to
    the next block, where they only serve as history.
    """
    if n < 1:
        raise ValueError(f"window of {n} rows")
    if step is not None:        # the caller's word that the axis is regular
        placed = df.withColumn("_i", F.floor(epoch_seconds(F.col(time)) / F.lit(freq_seconds(step))).cast("bigint"))
    elif axis is not None:
        places = axis_positions(axis, time, "_place")
        lost = F.raise_error(F.concat(F.lit("not on the axis: "), F.col(time).cast("string"))).cast("bigint")
        placed = df.join(places, time, "left").withColumn("_i", F.coalesce(F.col("_place"), lost)).drop("_place")
    else:
        placed = df.join(stage_table(axis_positions(df, time, "_i"), "axis"), time)
    size = max(n, ROLLING_BLOCK)
    own = F.floor(F.col("_i") / F.lit(size)).cast("bigint")
    tail = F.pmod(F.col("_i"), F.lit(size)) > size - n
    blocks = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = placed.withColumn("_own", own).withColumn("_block", F.explode_outer(blocks))
    w = Window.partitionBy(*keys, "_block").orderBy("_i").rangeBetween(-(n - 1), 0)
    return make(spread, w).filter(F.col("_block") == F.col("_own")).drop("_i", "_own", "_block")


def rolling_sum(df: DataFrame, n: int, keys: Sequence[str] = ("cell",), time: str = "time",
                value: str = "value", step: str | None = None) -> DataFrame:
    """Sum of the valid values in the trailing n steps; missing only when none is valid.

    Accumulation runs on the native steps: select times after this, not before.
    """
    return _over_trailing_rows(
        df, keys, time, n, step, lambda d, w: d.withColumn(value, F.sum(value).over(w))
    )


def trailing_mean(df: DataFrame, n: int, keys: Sequence[str] = ("cell",), time: str = "time",
                  value: str = "value", out: str | None = None, step: str | None = None,
                  axis: DataFrame | None = None) -> DataFrame:
    """Mean of the trailing n steps; missing unless all n values are there.

    Slice times before this: the first n-1 steps of the slice are missing.
    """
    out = out or value
    mean = lambda d, w: d.withColumn(
        out, F.when(F.count(value).over(w) == n, F.sum(value).over(w) / n)
    )
    done = _over_trailing_rows(df, keys, time, n, step, mean, axis)
    return done if out == value else done.drop(value)


def trailing_mean_over(df: DataFrame, window: str, dt: str, **kwargs) -> DataFrame:
    """``trailing_mean`` with the window given as a length: ``"2D"`` at ``"3h"`` is 16 places of the axis.

    The places are the field's distinct times, whatever lies between them; ``axis`` gives them as a table, and
    ``step`` promises that they are regular and saves numbering them.
    """
    return trailing_mean(df, window_rows(window, dt), **kwargs)


def interpolate_time(df: DataFrame, keys: Sequence[str] = ("cell",), time: str = "time",
                     value: str = "value", block: Column | None = None) -> DataFrame:
    """Fill gaps linearly in time between the nearest valid neighbours; ends stay missing.

    ``block`` cuts each series where a task should end (a calendar year by default; a month or a day of
    the time for series at steps of minutes or seconds). It changes no value.
    """
    known = df.withColumn("_at", F.when(F.col(value).isNotNull(), F.col(time)))
    near = with_valid_neighbours(
        known, keys, time, ["_at", value], year_block(F.col(time)) if block is None else block)
    t0, t1 = F.col("prev__at"), F.col("next__at")
    v0, v1 = F.col(f"prev_{value}"), F.col(f"next_{value}")
    line = v0 + (v1 - v0) * (elapsed_seconds(t0, F.col(time)) / elapsed_seconds(t0, t1))
    return near.withColumn(value, F.coalesce(F.col(value), F.when(t1 > t0, line))).select(*df.columns)


def fill_constant(df: DataFrame, constant: float, value: str = "value") -> DataFrame:
    """Every value still missing becomes the constant."""
    return df.withColumn(value, F.coalesce(F.col(value), F.lit(constant)))


def impute(df: DataFrame, constant: float, keys: Sequence[str] = ("cell",), time: str = "time",
           value: str = "value", block: Column | None = None) -> DataFrame:
    """Interpolate in time, then fill what is left with a constant."""
    return fill_constant(interpolate_time(df, keys, time, value, block), constant, value)


def _take_from(df: DataFrame, mapping: DataFrame, time: str, value: str, rows: int | None) -> DataFrame:
    near = broadcast_within(mapping.withColumnRenamed(time, "_target"), rows)
    return df.join(near, F.col(time) == F.col("src")).select(*[
        F.col("_target").alias(time) if c == time
        else F.when(F.col("inside"), F.col(value)).alias(value) if c == value
        else F.col(c)
        for c in df.columns
    ])


def _along_time(df, spine, how, time, value, source_times, rows):
    times = df.select(time) if source_times is None else source_times
    return _take_from(df, axis_map(times, spine, time, how), time, value, rows)


def reindex_ffill(df: DataFrame, spine: DataFrame, time: str = "time", value: str = "value",
                  source_times: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Move a field to the spine's times: each takes the row at the last source time not after it.

    The row is taken as it is: a missing value stays missing. Targets before the first source time
    are missing. Only the time labels are searched; the field itself meets the result by equality.
    ``source_times`` saves reading them from the field, ``rows`` bounds the spine's length.
    """
    return _along_time(df, spine, "ffill", time, value, source_times, rows)


def nearest_time(df: DataFrame, spine: DataFrame, time: str = "time", value: str = "value",
                 source_times: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Move a field to the spine's times: each takes the row at the nearest source time.

    A tie goes to the earlier source; targets outside the source times are missing.
    """
    return _along_time(df, spine, "nearest", time, value, source_times, rows)


def sort_time(df: DataFrame, time: str = "time", keys: Sequence[str] = ()) -> DataFrame:
    """Chronological order, as a range-partitioned sort."""
    return df.orderBy(time, *keys)


def compare_time_axes(df: DataFrame, spine: DataFrame, time: str = "time") -> DataFrame:
    """One row: hours only in the field, hours only in the spine, and whether the axes are the same.

    They are the same if they have the same hours and each hour stands for one label on either side.
    """
    hours = lambda d, name: d.select(F.col(time).alias("_t")).distinct().groupBy(
        truncate_hour(F.col("_t")).alias("_h")).agg(F.count(F.lit(1)).alias(name))
    return hours(df, "_l").join(hours(spine, "_r"), "_h", "full_outer").agg(
        F.count_if(F.col("_r").isNull()).alias("n_only_field"),
        F.count_if(F.col("_l").isNull()).alias("n_only_spine"),
        F.coalesce(F.bool_and(F.coalesce((F.col("_l") == 1) & (F.col("_r") == 1), F.lit(False))), F.lit(True)).alias("same"),
    )


def same_time_axis(df: DataFrame, spine: DataFrame, time: str = "time") -> bool:
    """Whether the two axes agree to the hour."""
    return bool(compare_time_axes(df, spine, time).first()["same"])


def align_to_axis(df: DataFrame, spine: DataFrame, time: str = "time", value: str = "value") -> DataFrame:
    """Put a field on the spine's times: relabel when the axes agree to the hour, else fill forward."""
    return align_to_axes({"": df}, spine, time, value)[""]


def align_to_axes(fields: Mapping[str, DataFrame], spine: DataFrame, time: str = "time", value: str = "value") -> dict[str, DataFrame]:
    """``align_to_axis`` for many fields with one job on their labels.

    The labels of all fields are searched in one pass (``axis_maps``), which also tells the fields that agree with
    the spine to the hour; the result is written once and each field meets its own rows of it by equality.
    """
    names = list(fields)
    labels = functools.reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("source"), time) for name, df in fields.items()])
    maps = stage_table(axis_maps(labels, spine, time, "ffill", names, same_hours=True), "axis")
    return {name: _take_from(df, maps.filter(F.col("source") == name).drop("source"), time, value, None) for name, df in fields.items()}
