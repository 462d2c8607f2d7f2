import pytest
from pyspark.sql import functions as F

from gridlake.operators import reshape as rs
from gridlake.operators import stats as st
from gridlake.operators.spine import time_spine
from gridlake.plans import jobs



def test_climatology_keeps_leap_days_apart(field):
    df = field([(1, "1999-03-01", 1.0), (1, "2000-02-29", 3.0), (1, "2000-03-01", 10.0), (1, "2001-03-01", None)])
    got = {r.doy: r.value for r in st.doy_climatology(df).collect()}
    # 1 March is day 60 in 1999, as 29 February is in 2000; it is day 61 in 2000.
    assert got == {60: 2.0, 61: 10.0}
    assert st.clim_metas(df, "v").first().asDict() == {"cell": 1, "v_min": 2.0, "v_max": 10.0, "v_annual_range": 8.0}
    assert st.clim_metas(df, "v", ["max"]).columns == ["cell", "v_max"]
    with pytest.raises(ValueError):
        st.clim_metas(df, "v", ["median"])


def store_field(field, rows):
    return field(rows, "pix bigint")


def test_compile_roles_order_and_precedence(spark, field):
    a = store_field(field, [(p, "2024-01-01", 1.0 + p) for p in range(12)])
    b = store_field(field, [(p, "2024-01-01", 100.0) for p in range(12)])
    b_out = b.withColumn("value", F.lit(7.0))
    const = b.select("pix", "value")
    spine = time_spine(spark, "2024-01-01", "2024-01-02", "D")
    store = jobs.compile_training({"b": b, "a": a}, {"b": b_out}, {"lsm": const}, spine, "2024-01-01", "2024-01-31")
    seen = {(r.role, r.channel, r.channel_idx) for r in store.collect()}
    assert seen == {("inputs", "b", 0), ("inputs", "a", 1), ("targets", "b", 0), ("constants", "lsm", 0)}
    # a name on both sides is read from the output's field
    assert {r.value for r in store.filter("channel = 'b'").collect()} == {7.0}
    # the second day is filled forward from the first
    assert store.filter("channel = 'a' AND role = 'inputs'").groupBy("time").count().count() == 2
    assert store.filter("role = 'constants' AND time IS NOT NULL").count() == 0
    packed = jobs.pack_training(store, 1)
    assert packed.filter("role = 'inputs' AND channel = 'a' AND face = 5").first()["values"] == [6.0]
    assert packed.count() == 12 * (2 + 2 + 2 + 1)


def test_targets_default_to_inputs(spark, field):
    a = store_field(field, [(0, "2024-01-01", 1.0)])
    store = jobs.compile_training({"a": a}, {}, {}, time_spine(spark, "2024-01-01", "2024-01-01", "D"))
    assert {(r.role, r.channel) for r in store.collect()} == {("inputs", "a"), ("targets", "a")}


def test_variable_files():
    assert rs.variable_files({"b": "x", "a": "y"}, {"b": "z"}) == {"a": "y", "b": "z"}
    assert rs.variable_files({"b": "x"}) == {"b": "x"}


def test_merge_keeps_all_roles(spark):
    rows = [(role, ch, 0, "2024-01-01", 0, 1.0) for role in ("inputs", "targets") for ch in ("a", "b")] + [("constants", "lsm", 0, None, 0, 1.0)]
    store = spark.createDataFrame(rows, "role string, channel string, channel_idx int, time string, pix bigint, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    merged = jobs.merge_training({"inputs": [(store, ["b"]), (store, ["a"])], "targets": [(store, ["a"])], "constants": [(store, ["lsm"])]}, ["2024-01-01"])
    assert {(r.role, r.channel, r.channel_idx) for r in merged.collect()} == {
        ("inputs", "b", 0), ("inputs", "a", 1), ("targets", "a", 0), ("constants", "lsm", 0)}


def test_accumulation_comes_before_selection(field):
    df = field([(1, f"2024-01-01T{h:02d}:00:00", 1.0) for h in range(12)])
    out = jobs.accumulate_and_select(df, ["2024-01-01T02:00:00", "2024-01-01T11:00:00"], accumulation_period=6, step="h", keys=["cell"])
    assert sorted(r.value for r in out.collect()) == [3.0, 6.0]
    assert out.schema["value"].metadata == {"accumulation_period": 6}


def test_trailing_average_starts_at_the_slice(field):
    df = field([(1, f"2024-01-0{d}", float(d)) for d in range(1, 6)], "pix bigint")
    out = jobs.trailing_average_job(df, "2D", "D", "2024-01-02", "2024-01-05")
    assert [r.value for r in out.orderBy("time").collect()] == [None, 2.5, 3.5, 4.5]


def test_pivot_restores_columns(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 4.0)], "cell int, a double, b double")
    long = rs.stack_columns(wide, ["cell"], ["b", "a"], "inputs")
    assert {(r.channel, r.channel_idx) for r in long.collect()} == {("b", 0), ("a", 1)}
    back = rs.pivot_channels(long, ["cell"], ["a", "b"])
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in wide.collect()}


def test_before_after_flags_changes(field):
    before = field([(1, "2024-01-01", None), (2, "2024-01-01", 2.0)])
    after = field([(1, "2024-01-01", -1.0), (2, "2024-01-01", 2.0)])
    got = {r.cell: (r.before, r.after, r.changed) for r in rs.before_after(before, after, ["2024-01-01"], ["cell"]).collect()}
    assert got == {1: (None, -1.0, True), 2: (2.0, 2.0, False)}


def test_granule_names_outside_the_spine_are_not_used(spark):
    cells = spark.createDataFrame([
        ("r/X.A2024001.1.hdf", 0, 0, 1.0), ("r/X.A2024002.1.hdf", 0, 0, 2.0), ("r/X.A2024003.1.hdf", 0, 0, 3.0), ("r/X.A2024003.1.xml", 0, 0, 9.0),
    ], "path string, y bigint, x bigint, value double")
    spine = time_spine(spark, "2024-01-01", "2024-01-03", "2D")
    lats, lons = spark.createDataFrame([(90.0,)], "lat double"), spark.createDataFrame([(180.0,)], "lon double")
    out = jobs.process_satellite(cells, cells.select("path").distinct(), spine, lats, lons, jobs.IndexGrid(2, 2, dlat=-90.0, dlon=180.0))
    assert sorted(r.value for r in out.collect()) == [1.0, 3.0]
