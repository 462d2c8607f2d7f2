import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import epoch_seconds, exact_seconds, freq_seconds, window_rows
from gridlake.operators import temporal as tm
from gridlake.operators.axis import axis_map, axis_positions
from gridlake.operators.spine import time_spine


def day(i):
    return f"2024-01-{i:02d}T00:00:00"


def test_interpolation_edges(field):
    df = field([
        # leading and trailing gaps stay; the inner gap is filled by time, not by row number
        (1, day(1), None), (1, day(2), 10.0), (1, day(3), None), (1, day(6), 50.0), (1, day(7), None),
        # one valid value fills nothing; no valid value fills nothing
        (2, day(1), None), (2, day(2), 4.0), (2, day(3), None),
        (3, day(1), None), (3, day(2), None),
    ])
    got = values(tm.interpolate_time(df), "cell", "time")
    assert got[(1, day(1))] is None and got[(1, day(7))] is None
    assert got[(1, day(3))] == pytest.approx(20.0)
    assert got[(1, day(2))] == 10.0 and got[(1, day(6))] == 50.0
    assert [got[(2, day(i))] for i in (1, 2, 3)] == [None, 4.0, None]
    assert [got[(3, day(i))] for i in (1, 2)] == [None, None]


def test_interpolation_over_empty_blocks(field):
    """The neighbours may be several blocks away."""
    df = field([(1, "1999-12-31", 0.0), (1, "2001-06-01", None), (1, "2004-01-01", None), (1, "2007-01-02", None), (1, "2010-01-01", 100.0)])
    got = values(tm.interpolate_time(df), "time")
    total = (tm_days("2010-01-01") - tm_days("1999-12-31"))
    for t in ("2001-06-01", "2004-01-01", "2007-01-02"):
        assert got[f"{t}T00:00:00"] == pytest.approx(100.0 * (tm_days(t) - tm_days("1999-12-31")) / total)


def tm_days(text):
    import datetime
    return datetime.date.fromisoformat(text).toordinal()


def test_impute_fills_the_rest(field):
    df = field([(1, day(1), None), (1, day(2), 2.0), (1, day(3), None), (1, day(4), 4.0)])
    assert values(tm.impute(df, -1.0), "time") == {day(1): -1.0, day(2): 2.0, day(3): 3.0, day(4): 4.0}


@pytest.mark.parametrize("step", ["D", None])
def test_rolling_sum_counts_partial_windows(field, step):
    df = field([(1, day(1), 1.0), (1, day(2), None), (1, day(3), 4.0), (1, day(4), None), (1, day(5), None)])
    got = values(tm.rolling_sum(df, 2, step=step), "time")
    assert got == {day(1): 1.0, day(2): 1.0, day(3): 4.0, day(4): 4.0, day(5): None}


def test_trailing_mean_needs_all_rows(field):
    df = field([(1, day(1), 1.0), (1, day(2), 3.0), (1, day(3), None), (1, day(4), 5.0), (1, day(5), 7.0)])
    got = values(tm.trailing_mean_over(df, "2D", "D"), "time")
    assert got == {day(1): None, day(2): 2.0, day(3): None, day(4): None, day(5): 6.0}


def test_absent_row_is_a_missing_value(field):
    df = field([(1, day(1), 1.0), (1, day(3), 3.0), (2, day(1), 1.0), (2, day(2), 2.0), (2, day(3), 3.0)])
    got = values(tm.trailing_mean(df, 2, step="D"), "cell", "time")
    assert got[(1, day(3))] is None and got[(2, day(3))] == 2.5
    # without a step the axis is the distinct times of the field, here the same three days
    assert values(tm.trailing_mean(df, 2), "cell", "time") == got


def test_rolling_across_blocks(spark, monkeypatch):
    """Blocks shorter than the series give the result of one window over the whole series."""
    monkeypatch.setattr(tm, "ROLLING_BLOCK", 7)
    rng = random.Random(1)
    series = [None if rng.random() < 0.2 else rng.random() for _ in range(200)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(series)], "cell bigint, i int, value double") \
        .withColumn("time", (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours="i")))
    for n in (1, 3, 7, 20):
        sums = {r.i: r.value for r in tm.rolling_sum(df, n, step="h").collect()}
        means = {r.i: r.value for r in tm.trailing_mean(df, n, step="h").collect()}
        assert len(sums) == len(means) == 200
        for i in range(200):
            win = series[max(0, i - n + 1): i + 1]
            valid = [v for v in win if v is not None]
            assert sums[i] == (pytest.approx(sum(valid)) if valid else None)
            assert means[i] == (pytest.approx(sum(valid) / n) if len(valid) == n else None)


def test_ffill_takes_rows_not_values(spark, field):
    df = field([(1, day(2), 1.0), (1, day(4), None), (2, day(2), 5.0)])
    spine = time_spine(spark, day(1), day(5), "D")
    got = values(tm.reindex_ffill(df, spine), "cell", "time")
    assert [got[(1, day(i))] for i in range(1, 6)] == [None, 1.0, 1.0, None, None]
    # cell 2 has no row at day 4, the last source time for days 4 and 5
    assert [got.get((2, day(i)), "absent") for i in range(1, 6)] == [None, 5.0, 5.0, "absent", "absent"]


def test_nearest_time_tie_and_range(spark, field):
    df = field([(1, day(1), 1.0), (1, day(3), 3.0)])
    spine = time_spine(spark, "2023-12-31T12:00:00", "2024-01-03T12:00:00", "12h")
    got = values(tm.nearest_time(df, spine), "time")
    assert got["2023-12-31T12:00:00"] is None and got["2024-01-03T12:00:00"] is None
    assert got["2024-01-02T00:00:00"] == 1.0          # tie goes to the earlier source
    assert got["2024-01-02T12:00:00"] == 3.0
    assert got[day(1)] == 1.0 and got[day(3)] == 3.0


def test_axis_map_of_numbers(spark):
    src = spark.createDataFrame([(0.0,), (10.0,), (200.0,)], "lat double")
    want = spark.createDataFrame([(-1.0,), (4.0,), (5.0,), (6.0,), (105.0,), (106.0,), (200.0,), (201.0,)], "lat double")
    got = {r.lat: (r.src, r.inside) for r in axis_map(src, want, "lat", "nearest").collect()}
    assert got == {-1.0: (0.0, False), 4.0: (0.0, True), 5.0: (0.0, True), 6.0: (10.0, True), 105.0: (10.0, True),
                   106.0: (200.0, True), 200.0: (200.0, True), 201.0: (200.0, False)}


def test_axis_positions_count_over_years(spark, field):
    df = field([(c, t, 0.0) for c in (1, 2) for t in ("1999-12-30", "1999-12-31", "2000-01-01", "2003-05-05")])
    got = {r.time.isoformat()[:10]: r.t_idx for r in axis_positions(df).collect()}
    assert got == {"1999-12-30": 0, "1999-12-31": 1, "2000-01-01": 2, "2003-05-05": 3}


def test_align_relabels_equal_axes(spark, field):
    """Axes that agree to the hour are the same; sub-hour offsets take the target's label."""
    spine = time_spine(spark, day(1), "2024-01-01T06:00:00", "3h")
    df = field([(1, "2024-01-01T00:30:00", 1.0), (1, "2024-01-01T03:30:00", 2.0), (1, "2024-01-01T06:30:00", 3.0)])
    assert tm.same_time_axis(df, spine)
    got = values(tm.align_to_axis(df, spine), "time")
    assert got == {"2024-01-01T00:00:00": 1.0, "2024-01-01T03:00:00": 2.0, "2024-01-01T06:00:00": 3.0}
    later = df.filter("value > 1")
    assert not tm.same_time_axis(later, spine)
    assert values(tm.align_to_axis(later, spine), "time")["2024-01-01T03:00:00"] is None


def test_seconds_do_not_depend_on_the_session_zone(spark, field):
    df = field([(1, "2024-03-10T02:30:00.250", 0.0), (2, "1969-12-31T23:59:59", 0.0)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = set()
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            rows = df.select(epoch_seconds(F.col("time")).alias("a"), exact_seconds(F.col("time")).alias("b")).collect()
            seen.add(tuple((r.a, r.b) for r in rows))
        assert seen == {((1710037800, 1710037800.25), (-1, -1.0))}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_frequencies():
    assert freq_seconds("3h") == 10800 and freq_seconds("D") == 86400 and freq_seconds("3H") == 10800
    assert window_rows("2D", "3h") == 16 and window_rows("7h", "2h") == 3
    with pytest.raises(ValueError):
        freq_seconds("3 fortnights")


def test_the_field_is_read_once(spark, tmp_path):
    """Both branches of the gap filling take their rows from one exchange of the field."""
    spark.range(2000).selectExpr(
        "id % 7 as cell", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id div 7 as int)) as time",
        "if(id % 3 = 0, null, double(id)) as value").write.parquet(f"{tmp_path}/f")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = tm.interpolate_time(spark.read.parquet(f"{tmp_path}/f"))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1


def test_trailing_mean_counts_places_not_days(spark, field):
    df = field([(1, f"2024-01-0{d}", float(d)) for d in (1, 2, 3, 5, 6)])
    got = values(tm.trailing_mean_over(df, "3D", "D"), "time")
    assert got["2024-01-02T00:00:00"] is None
    assert got["2024-01-05T00:00:00"] == pytest.approx(10 / 3) and got["2024-01-06T00:00:00"] == pytest.approx(14 / 3)


def test_half_hours_are_not_an_hourly_axis(spark, field):
    df = field([(1, f"2024-01-01T0{h}:{m}", h + (m == "30") / 2) for h in (0, 1, 2) for m in ("00", "30")])
    spine = spark.sql("select explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-01 02:00', interval 1 hour)) as time")
    assert not tm.same_time_axis(df, spine)
    got = tm.align_to_axis(df, spine)
    assert got.count() == 3 and list(values(got, "time").values()) == [0.0, 1.0, 2.0]
