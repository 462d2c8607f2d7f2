"""Finding neighbours along an axis without holding a whole series in one task.

A series is cut into blocks (calendar years of a time axis, stretches of a spatial one). Windows run
within (series, block), so no window group grows with the length of a series. What a block needs
from the blocks around it - the last valid row before it and the first one after it - comes from a
table with one row per (series, block), built by an aggregate that combines before it shuffles.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import exact_seconds, truncate_hour, year_block


def _beside(which: str, column: str, keys: Sequence[str], order: str) -> Column:
    """``lag`` or ``lead`` by one row, passing over NULLs."""
    by = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    return F.expr(f"{which}(`{column}`, 1) IGNORE NULLS OVER ({by}ORDER BY `{order}`)")


def with_valid_neighbours(
    df: DataFrame, keys: Sequence[str], order: str, carry: Sequence[str], block: Column,
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` for each column c in ``carry``.

    The columns in ``carry`` are all NULL in rows that are not valid. The new columns come from the
    nearest valid row of the same series at or before, and at or after, this row; NULL where there
    is none. ``block`` must not decrease along ``order``.

    The rows are exchanged once, by series and block; the table of block ends is taken from the same
    exchange, so that what comes before is computed once (if ``df`` has no columns but those used here).
    Ahead and back share one sort: the next value is ``lead`` without NULLs. (A frame that reaches to
    the end of its group would be evaluated anew for every row.)
    """
    group = [*keys, "_block"]
    seen = df.withColumn("_block", block).repartition(*group)
    rows = seen.withColumns({
        n: F.coalesce(F.col(c), _beside(which, c, group, order))
        for c in carry for n, which in ((f"prev_{c}", "lag"), (f"next_{c}", "lead"))
    })

    at = F.when(F.col(carry[0]).isNotNull(), F.col(order))
    ends = seen.groupBy(*group).agg(*[
        e for c in carry for e in (F.max_by(c, at).alias(f"_last_{c}"), F.min_by(c, at).alias(f"_first_{c}"))
    ])
    around = ends.select(*group, *[
        e for c in carry for e in (
            _beside("lag", f"_last_{c}", keys, "_block").alias(f"_before_{c}"),
            _beside("lead", f"_first_{c}", keys, "_block").alias(f"_after_{c}"),
        )
    ])
    filled = {}
    for c in carry:
        filled[f"prev_{c}"] = F.coalesce(f"prev_{c}", f"_before_{c}")
        filled[f"next_{c}"] = F.coalesce(f"next_{c}", f"_after_{c}")
    # Null-safe, so that no filter is derived for one branch alone, which would keep it from the shared exchange.
    beside = around.withColumnsRenamed({g: f"_of_{g}" for g in group})
    same = functools.reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group])
    return rows.join(beside, same, "left").withColumns(filled).select(*df.columns, *filled)


def nearest_choice(prev_at: Column, at: Column, next_at: Column, prev, next_) -> Column:
    """The nearer of two neighbours; a tie goes to the earlier one; NULL unless both are there."""
    both = prev_at.isNotNull() & next_at.isNotNull()
    return F.when(both, F.when(at - prev_at <= next_at - at, prev).otherwise(next_))


def axis_map(source: DataFrame, target: DataFrame, axis: str, how: str, block_width: float = 15.0) -> DataFrame:
    """Which source label each target label takes its values from.

    Returns one row per target label: the label, ``src`` and ``inside``. ``how="ffill"`` takes the
    last source at or before the target, ``how="nearest"`` the nearest one between two sources. A
    target with no such source gets ``inside = false`` and the closest source end as ``src``, so
    that joining a field to the map still yields a row (with a missing value) for it.
    """
    labels = source.select(F.lit("").alias("source"), axis)
    return axis_maps(labels, target, axis, how, [""], block_width).drop("source")


def axis_maps(labels: DataFrame, target: DataFrame, axis: str, how: str, names: Sequence[str], block_width: float = 15.0,
              same_hours: bool = False) -> DataFrame:
    """The maps of many sources onto one axis in one pass: ``source``, the label, ``src`` and ``inside``.

    ``labels(source, <axis>)`` holds the labels of all the sources ``names``, repeated or not. They and the target's
    labels, once for each source, become one table with one row for a source and label, and each source keeps
    its own last and next label along it. With ``same_hours``, a source whose labels are the target's to the hour,
    one for one, is relabelled: each target takes the source label of its hour. The test is made from the same table.
    """
    if how not in ("ffill", "nearest"):
        raise ValueError(f"unknown axis mapping: {how}")
    is_time = dict(target.dtypes)[axis].startswith("timestamp")
    at = exact_seconds(F.col(axis)) if is_time else F.col(axis)
    have = labels.select("source", axis, F.lit(False).alias("_want"))
    want = target.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("source"), axis, F.lit(True).alias("_want"))
    both = have.unionByName(want).filter(F.col(axis).isNotNull()).groupBy("source", axis).agg(
        F.bool_or("_want").alias("_want"), F.bool_or(~F.col("_want")).alias("_have"))
    both = both.withColumn("_src", F.when(F.col("_have"), F.col(axis))).withColumn("_pos", at) \
        .withColumn("_at", F.when(F.col("_have"), F.col("_pos")))
    block = year_block(F.col(axis)) if is_time else F.floor(F.col(axis) / F.lit(block_width))
    near = with_valid_neighbours(both, ["source"], axis, ["_src", "_at"], block).filter("_want")
    prev, next_ = F.col("prev__src"), F.col("next__src")
    if how == "ffill":
        src = prev
    else:
        src = nearest_choice(F.col("prev__at"), F.col("_pos"), F.col("next__at"), prev, next_)
    found = near.select("source", axis, F.coalesce(src, prev, next_).alias("src"), src.isNotNull().alias("inside"))
    if not same_hours:
        return found
    hours = both.groupBy("source", truncate_hour(F.col(axis)).alias("_h")).agg(
        F.count_if("_have").alias("_l"), F.count_if("_want").alias("_r"), F.max("_src").alias("_own"))
    alike = hours.groupBy("source").agg(F.bool_and((F.col("_l") == 1) & (F.col("_r") == 1)).alias("_same"))
    own = hours.join(alike, "source").filter("_same").select(F.col("source").alias("_s"), "_h", "_own")
    relabelled = found.join(own, (F.col("source") == F.col("_s")) & (truncate_hour(F.col(axis)) == F.col("_h")), "left")
    return relabelled.select("source", axis, F.coalesce("_own", "src").alias("src"), (F.col("inside") | F.col("_own").isNotNull()).alias("inside"))


def axis_positions(df: DataFrame, time: str = "time", out: str = "t_idx") -> DataFrame:
    """The distinct times of a field with their place 0, 1, 2, ... on the axis.

    Numbering runs per calendar year; the number of times in earlier years is added.
    """
    times = df.select(time).distinct().withColumn("_block", year_block(F.col(time)))
    sizes = times.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_block", F.coalesce(
        F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0),
    ).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(time)) - 1
    return times.withColumn("_place", place).join(offsets, "_block").select(
        time, (F.col("_place") + F.col("_offset")).cast("bigint").alias(out)
    )
