"""Aggregates: day-of-year climatology and its range, missing counts, mean series."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.physics import difference
from gridlake.functions.timeaxis import doy_key

METAS = ("min", "max", "annual_range")


def doy_climatology(df: DataFrame, keys: Sequence[str] = ("cell",), time: str = "time", value: str = "value") -> DataFrame:
    """Mean over all years and hours per cell and day of year; missing values are left out."""
    return df.groupBy(*keys, doy_key(F.col(time)).alias("doy")).agg(F.avg(value).alias(value))


def climatology_state(df: DataFrame, keys: Sequence[str] = ("cell",), time: str = "time", value: str = "value") -> DataFrame:
    """What the climatology needs of a field: valid values and their sum for each cell and day of year.

    States of different times add up (``merge_states``), so a further year costs one pass over that year.
    """
    return df.groupBy(*keys, doy_key(F.col(time)).alias("doy")).agg(F.sum(value).alias("sum"), F.count(value).alias("n"))


def merge_states(states: Sequence[DataFrame] | DataFrame, keys: Sequence[str] = ("cell",)) -> DataFrame:
    """The state of all the times that the states stand for, each of them once."""
    every = [states] if isinstance(states, DataFrame) else list(states)
    return functools.reduce(DataFrame.unionByName, every).groupBy(*keys, "doy").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))


def climatology_of_state(state: DataFrame, keys: Sequence[str] = ("cell",), value: str = "value") -> DataFrame:
    """Mean for each cell and day of year, as ``doy_climatology`` has it."""
    return state.select(*keys, "doy", (F.col("sum") / F.nullif(F.col("n"), F.lit(0))).alias(value))


def metas_of_state(state: DataFrame, variable: str, metas: Sequence[str] = METAS, keys: Sequence[str] = ("cell",)) -> DataFrame:
    """``clim_metas`` from a state: no field is read."""
    return _metas_of_climatology(climatology_of_state(state, keys), variable, metas, keys, "value")


def clim_metas(df: DataFrame, variable: str, metas: Sequence[str] = METAS, keys: Sequence[str] = ("cell",),
               time: str = "time", value: str = "value") -> DataFrame:
    """Per cell: lowest and highest day-of-year mean and their difference, all from one climatology."""
    return _metas_of_climatology(doy_climatology(df, keys, time, value), variable, metas, keys, value)


def _metas_of_climatology(means: DataFrame, variable: str, metas: Sequence[str], keys: Sequence[str], value: str) -> DataFrame:
    unknown = set(metas) - set(METAS)
    if unknown:
        raise ValueError(f"unknown metas: {sorted(unknown)}")
    low, high = F.min(value), F.max(value)
    columns = {"min": low, "max": high, "annual_range": difference(high, low)}
    return means.groupBy(*keys).agg(*[columns[m].alias(f"{variable}_{m}") for m in metas])


def clim_min(df: DataFrame, variable: str, **kwargs) -> DataFrame:
    return clim_metas(df, variable, ["min"], **kwargs)


def clim_max(df: DataFrame, variable: str, **kwargs) -> DataFrame:
    return clim_metas(df, variable, ["max"], **kwargs)


def clim_annual_range(df: DataFrame, variable: str, **kwargs) -> DataFrame:
    return clim_metas(df, variable, ["annual_range"], **kwargs)


def missing_count(df: DataFrame, value: str = "value") -> DataFrame:
    return df.agg(F.count_if(F.col(value).isNull()).alias("n_missing"))


def field_check(df: DataFrame, time: str = "time", value: str = "value") -> DataFrame:
    """Mean over all cells and missing values per time, and as a row without a time for the whole field.

    One pass and one aggregate: what ``missing_count`` and ``global_mean_series`` tell together.
    """
    return df.rollup(time).agg(F.avg(value).alias(value), F.count_if(F.col(value).isNull()).alias("n_missing"))


def global_mean_series(df: DataFrame, time: str = "time", value: str = "value") -> DataFrame:
    """Mean over all cells per time, each cell counting the same; missing values are left out."""
    return df.groupBy(time).agg(F.avg(value).alias(value))
