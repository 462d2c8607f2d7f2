"""Label selection and projection."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.cluster import broadcast_within
from gridlake.operators.spine import ntz

# Columns that older stores carry beside the variable (fixed values).
LEGACY_COLUMNS = ("varlev", "mean", "std")
# The time requested for fields that do not change in time (fixed value).
CONSTANT_TIME = "1980-01-01T00:00:00"


class MissingLabel(KeyError):
    """A requested label is not in the field."""


def time_slice(df: DataFrame, start=None, end=None, time: str = "time") -> DataFrame:
    """Rows from ``start`` to ``end``, both included; an end left out is open."""
    t = F.col(time)
    if start is not None:
        df = df.filter(t >= ntz(start))
    if end is not None:
        df = df.filter(t <= ntz(end))
    return df


def time_labels(spark: SparkSession, times: Sequence[str], time: str = "time") -> DataFrame:
    """A list of times as a table."""
    return spark.createDataFrame([(str(t),) for t in times], f"`{time}` string").select(F.col(time).cast("timestamp_ntz").alias(time))


def select_times(df: DataFrame, times: Sequence[str], time: str = "time", strict: bool = True) -> DataFrame:
    """Rows at exactly the given times. With ``strict``, a time without any row is an error."""
    labels = time_labels(df.sparkSession, times, time)
    between = time_slice(df, min(map(str, times)), max(map(str, times)), time) if times else df
    return select_times_from(between, labels, time, strict, rows=len(times))


def select_times_from(df: DataFrame, times: DataFrame, time: str = "time", strict: bool = True,
                      rows: int | None = None) -> DataFrame:
    """The same with the times in a table; ``rows`` bounds its length.

    The plan is the same for any number of times. The check is one join of the times with the field's.
    """
    labels = times.select(time)
    if strict:
        absent = [str(r[0]) for r in labels.join(df.select(time).distinct(), time, "left_anti").orderBy(time).take(20)]
        if absent:
            raise MissingLabel(f"{time} not in field: {absent}")
    return df.join(broadcast_within(labels, rows), time, "left_semi").select(*df.columns)


def _require(df: DataFrame, column: str, labels: Sequence[Column], names: Sequence) -> None:
    flags = df.agg(*[
        F.coalesce(F.bool_or(F.col(column) == label), F.lit(False)).alias(str(i))
        for i, label in enumerate(labels)
    ]).first()
    absent = [str(name) for name, seen in zip(names, flags) if not seen]
    if absent:
        raise MissingLabel(f"{column} not in field: {absent}")


def require_labels(parts: Sequence[tuple[DataFrame, Sequence[str], DataFrame | None]], channel: str = "channel", time: str = "time") -> None:
    """Fail unless each part (field, channels, times or None) holds all its channels and all its times; one job for all.

    A time must be there in some row of the chosen channels. Each field is read once, for the distinct labels of both.
    """
    wanted, seen = [], []
    for i, (df, channels, times) in enumerate(parts):
        of = F.lit(i).alias("part")
        names = df.sparkSession.createDataFrame([(c,) for c in channels], "label string")
        wanted.append(names.select(of, F.lit(channel).alias("what"), "label"))
        labels = [F.struct(F.lit(channel).alias("what"), F.col(channel).cast("string").alias("label"))]
        if times is not None:
            wanted.append(times.select(of, F.lit(time).alias("what"), F.col(time).cast("string").alias("label")))
            labels.append(F.struct(F.lit(time).alias("what"), F.col(time).cast("string").alias("label")))
        chosen = df.filter(F.col(channel).isin(list(channels)))
        seen.append(chosen.select(of, F.explode(F.array(*labels)).alias("_l")).select("part", "_l.what", "_l.label").distinct())
    if not wanted:
        return
    union = lambda dfs: functools.reduce(DataFrame.unionByName, dfs)
    absent = union(wanted).join(union(seen), ["part", "what", "label"], "left_anti").orderBy("part", "what", "label").take(20)
    if absent:
        raise MissingLabel("not in field: " + ", ".join(f"{r['what']} {r['label']} (part {r['part']})" for r in absent))


def select_level(df: DataFrame, level: float, column: str = "level") -> DataFrame:
    """Keep one level and drop the level column."""
    return df.filter(F.col(column) == F.lit(level)).drop(column)


def drop_constant_time(df: DataFrame, times: Sequence[str] | DataFrame | None = None, time: str = "time",
                       strict: bool = True) -> DataFrame:
    """Select the requested times; a single one means a field that does not change in time.

    Without times that one is ``CONSTANT_TIME``; a table of times keeps its time.
    """
    if isinstance(times, DataFrame):
        return select_times_from(df, times, time, strict)
    times = [CONSTANT_TIME] if times is None else times
    chosen = select_times(df, times, time, strict)
    return chosen.drop(time) if len(times) == 1 else chosen


def select_channels(df: DataFrame, channels: Sequence[str], column: str = "channel", strict: bool = True) -> DataFrame:
    """Keep the named channels; with ``strict``, one that is absent is an error."""
    chosen = df.filter(F.col(column).isin(list(channels)))
    if strict:
        _require(chosen, column, [F.lit(c) for c in channels], channels)
    return chosen


def first_varlev(df: DataFrame, column: str = "varlev") -> DataFrame:
    """Old stores hold one variable per file behind a dimension of its own: keep index 0."""
    return df.filter(F.col(column) == 0).drop(column)


def drop_columns(df: DataFrame, names: Sequence[str] = LEGACY_COLUMNS) -> DataFrame:
    """Drop what is there of the named columns."""
    return df.drop(*names)


def cast_value(df: DataFrame, to: str = "float", value: str = "value") -> DataFrame:
    return df.withColumn(value, F.col(value).cast(to))
