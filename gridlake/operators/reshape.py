"""Stacking variables into channels and back; comparing stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators.regrid import remap_hpx_to_ll
from gridlake.operators.select import (
    require_labels, select_channels, select_times, select_times_from, time_labels, time_slice,
)

# The coordinates that order the cells of a training store (fixed values).
COORDS = ("time", "channel_idx", "face", "height", "width")


def stack_channels(fields: Mapping[str, DataFrame], role: str) -> DataFrame:
    """Fields as one long table with ``role``, ``channel`` and ``channel_idx``, in the given order."""
    out = None
    for i, (name, df) in enumerate(fields.items()):
        one = df.withColumns({"role": F.lit(role), "channel": F.lit(name), "channel_idx": F.lit(i)})
        out = one if out is None else out.unionByName(one)
    return out


def stack_columns(df: DataFrame, keys: Sequence[str], variables: Sequence[str], role: str) -> DataFrame:
    """The same from a wide table with one column per variable, in one pass."""
    order = F.array(*[F.lit(v) for v in variables])
    return df.unpivot(list(keys), list(variables), "channel", "value").withColumns({
        "role": F.lit(role),
        "channel_idx": (F.array_position(order, F.col("channel")) - 1).cast("int"),
    })


def append_channels(stores: Sequence[tuple[DataFrame, Sequence[str]]], times=None, strict: bool = True) -> DataFrame:
    """Take channels from several stores and append them; ``times`` is (start, end), a list, a table of times, or None.

    With ``strict``, a channel or time that a store lacks is an error; one job checks all stores.
    """
    return append_roles({None: stores}, {None: times}, strict)


def append_roles(stores: Mapping[str | None, Sequence[tuple[DataFrame, Sequence[str]]]], times: Mapping, strict: bool = True) -> DataFrame:
    """``append_channels`` for each role, one below the other, with one check for all of them.

    Channels are numbered anew in each role; ``times`` has the times of each.
    """
    parts = []
    for role, taken in stores.items():
        at, offset = times.get(role), 0
        for df, channels in taken:
            labels = None
            if "time" in df.columns and at is not None and not isinstance(at, tuple):
                labels = at.select("time") if isinstance(at, DataFrame) else time_labels(df.sparkSession, at)
            parts.append((df, list(channels), labels, at if isinstance(at, tuple) and "time" in df.columns else None, offset))
            offset += len(channels)
    if strict:
        require_labels([(df, channels, labels) for df, channels, labels, _, _ in parts])
    out = None
    for df, channels, labels, span, offset in parts:
        part = select_channels(df, channels, strict=False)
        if labels is not None:
            part = select_times_from(part, labels, strict=False)
        elif span is not None:
            part = time_slice(part, *span)
        order = F.array(*[F.lit(c) for c in channels])
        part = part.withColumn("channel_idx", (F.array_position(order, F.col("channel")) - 1 + offset).cast("int"))
        out = part if out is None else out.unionByName(part)
    return out


def pivot_channels(df: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """One column per channel; a label without a value for a channel is missing there."""
    return df.groupBy(*keys).pivot("channel", list(channels)).agg(F.first("value", ignorenulls=True))


def variable_union(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Variables of a compile job and the file each is read from: ``(variable, path)``.

    A variable named on both sides is read from the output's file.
    """
    only_inputs = inputs.join(outputs, "variable", "left_anti")
    return outputs.select("variable", "path").unionByName(only_inputs.select("variable", "path")).distinct()


def variable_files(inputs: Mapping[str, str], outputs: Mapping[str, str] | None = None) -> dict[str, str]:
    """The same for job parameters, sorted by name; without outputs, the inputs are the outputs."""
    merged = {**inputs, **(outputs or {})}
    return {name: merged[name] for name in sorted(set(inputs) | set(outputs or inputs))}


def order_by_coords(df: DataFrame, coords: Sequence[str] = COORDS) -> DataFrame:
    return df.orderBy(*coords)


def frame_at(df: DataFrame, times: Sequence[str], nside: int, nlat: int, nlon: int,
             channel: Sequence[str] = ("channel",), strict: bool = True) -> DataFrame:
    """Chosen times of a HEALPix store as lat/lon frames, one per channel."""
    chosen = select_times(df, times, strict=strict)
    return remap_hpx_to_ll(chosen, nside, nlat, nlon, group=("time", *channel))


def before_after(before: DataFrame, after: DataFrame, times: Sequence[str], keys: Sequence[str],
                 value: str = "value", strict: bool = True) -> DataFrame:
    """Values of two stages of a field at chosen times, side by side, and whether they differ."""
    labels = [*keys, "time"]
    old = select_times(before, times, strict=strict).select(*labels, F.col(value).alias("before"))
    new = select_times(after, times, strict=strict).select(*labels, F.col(value).alias("after"))
    return old.join(new, labels).withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))
