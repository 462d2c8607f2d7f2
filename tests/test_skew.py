"""One series, time or pixel may hold a third of all rows: results stay whole, groups stay bounded."""

import random

import pytest
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import year_block
from gridlake.operators import regrid as rg
from gridlake.operators import stats as st
from gridlake.operators import temporal as tm

HOT, COLD, STEPS = 7, 40, 6000


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot cell with 6000 steps of 12 h (more than 8 years), and 40 cells with 300 steps."""
    rng = random.Random(3)
    rows = [(HOT, i, None if rng.random() < 0.3 else rng.random()) for i in range(STEPS)]
    rows += [(100 + c, i, None if rng.random() < 0.3 else rng.random()) for c in range(COLD) for i in range(300)]
    df = spark.createDataFrame(rows, "cell bigint, i int, value double")
    return df.withColumn("time", F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("i") * 12)), rows


def naive_interpolation(series):
    known = [i for i, v in enumerate(series) if v is not None]
    out = []
    for i, v in enumerate(series):
        before = [k for k in known if k <= i][-1:] if v is None else [i]
        after = next((k for k in known if k >= i), None)
        if v is not None or not before or after is None:
            out.append(v)
        else:
            a, b = before[0], after
            out.append(series[a] + (series[b] - series[a]) * (i - a) / (b - a))
    return out


def test_hot_series_interpolates_whole(skewed):
    df, rows = skewed
    got = {(r.cell, r.i): r.value for r in tm.interpolate_time(df).collect()}
    assert len(got) == len(rows)
    hot = [v for c, _, v in rows if c == HOT]
    for i, v in enumerate(naive_interpolation(hot)):
        assert got[(HOT, i)] == (None if v is None else pytest.approx(v))


def test_window_groups_are_blocks(skewed):
    """A window group is one series within one year, whatever the series' length."""
    df, _ = skewed
    largest = df.groupBy("cell", year_block(F.col("time"))).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 366
    plan = tm.interpolate_time(df)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "lead(value" in line]
    assert windows and all("_block" in line for line in windows)


def test_hot_series_rolls_whole(skewed):
    df, rows = skewed
    got = {(r.cell, r.i): r.value for r in tm.rolling_sum(df, 5, step="12h").collect()}
    assert len(got) == len(rows)
    hot = [v for c, _, v in rows if c == HOT]
    for i in range(STEPS):
        valid = [v for v in hot[max(0, i - 4): i + 1] if v is not None]
        assert got[(HOT, i)] == (pytest.approx(sum(valid)) if valid else None)


def combines_before_shuffle(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "partial_" in plan


def test_aggregates_combine_before_the_shuffle(skewed):
    df, _ = skewed
    assert combines_before_shuffle(st.doy_climatology(df))
    assert combines_before_shuffle(st.global_mean_series(df))
    points = df.select(F.lit(10.0).alias("lon"), F.lit(20.0).alias("lat"), "value")
    binned = rg.bin_mean_to_hpx(points, 4)
    assert combines_before_shuffle(binned)
    n = df.filter("value IS NOT NULL").count()
    total = df.agg(F.sum("value")).first()[0]
    full = binned.filter("value > 0").collect()
    assert len(full) == 1 and full[0].value == pytest.approx(total / (n + 1e-7))


def test_no_whole_table_window_or_cross_join(skewed):
    """Only block summaries and axis tables may use a window without partitions; nothing crosses."""
    df, _ = skewed
    for out in (tm.interpolate_time(df), tm.rolling_sum(df, 4, step="12h"), tm.trailing_mean(df, 4, step="12h")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "SinglePartition" not in plan
