"""Scans, sinks, selection, spines, granules, gates."""

import datetime
import math

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridlake.functions import physics
from gridlake.operators import checks, select
from gridlake.operators import spine as sp
from gridlake.operators.select import MissingLabel
from gridlake.operators.spine import time_spine
from gridlake.plans import jobs
from gridlake.sources import fields as src
from gridlake.sources import granules as gr


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_scan_prunes_and_turns_nan_to_null(spark, folder):
    spark.createDataFrame([(1, 2.0, 9), (2, float("nan"), 9), (3, None, 9)], "cell int, v double, other int").write.parquet(f"{folder}/f")
    df = src.scan_field(spark, f"{folder}/f", "v", ["cell"])
    assert {r.cell: r.value for r in df.collect()} == {1: 2.0, 2: None, 3: None}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan


def test_time_slice_reaches_the_scan(spark, field, folder):
    field([(1, f"2024-01-{i:02d}", float(i)) for i in range(1, 11)]).write.parquet(f"{folder}/f")
    df = select.time_slice(spark.read.parquet(f"{folder}/f"), "2024-01-03", "2024-01-05")
    assert sorted(r.value for r in df.collect()) == [3.0, 4.0, 5.0]
    pushed = df._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(time" in pushed and "LessThanOrEqual(time" in pushed


def test_union_of_files_finds_duplicates(spark, field, folder):
    field([(1, "2024-01-01", 1.0)]).write.parquet(f"{folder}/a")
    field([(1, "2024-01-01", 2.0)]).select("value", "time", "cell").write.parquet(f"{folder}/b")
    paths = [f"{folder}/a", f"{folder}/b"]
    assert src.scan_union(spark, paths, ["cell", "time"]).count() == 2
    with pytest.raises(ValueError):
        src.scan_union(spark, paths, ["cell", "time"], check=True)


def test_rename_leaves_standard_names(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "sample int, time int, predictors double")
    assert src.rename_conventions(df, "t2m").columns == ["sample", "time", "t2m"]
    df = spark.createDataFrame([(1, 2.0, 3.0)], "valid_time int, lat double, lon double")
    assert src.rename_conventions(df).columns == ["time", "latitude", "longitude"]


def test_write_skips_finished_and_replaces_unfinished(spark, field, folder):
    path = f"{folder}/out"
    a, b = field([(1, "2024-01-01", 1.0)]), field([(1, "2024-01-01", 2.0)])
    assert src.write_field(a, path) is True
    assert src.write_field(b, path) is False
    assert spark.read.parquet(path).first().value == 1.0
    assert src.write_field(b, path, overwrite=True) is True
    assert spark.read.parquet(path).first().value == 2.0
    import os
    os.remove(f"{path}/_SUCCESS")
    assert src.write_field(a, path) is True
    assert spark.read.parquet(path).first().value == 1.0


def test_skipped_write_does_no_work(spark, field, folder):
    path = f"{folder}/out"
    src.write_field(field([(1, "2024-01-01", 1.0)]), path)
    failing = spark.range(1).select(F.raise_error(F.lit("computed")).cast("double").alias("value"))
    assert src.write_field(failing, path) is False


def test_scan_union_keeps_columns_of_some_files(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "id long, a long").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(3, 4, 5)], "id long, a long, b long").write.parquet(f"{tmp_path}/b")
    got = src.scan_union(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], ["id"])
    assert sorted((r["id"], r["a"], r["b"]) for r in got.collect()) == [(1, 2, None), (3, 4, 5)]
    both = src.concat_fields([spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")])
    assert sorted((r["id"], r["b"]) for r in both.collect()) == [(1, None), (3, 5)]


def test_jobs_that_are_done_are_not_built(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    jobs = [{"path": f"{tmp_path}/x", "make": make}, {"path": f"{tmp_path}/y", "make": make}]
    assert src.run_jobs(spark, jobs) == [True, True]
    assert src.run_jobs(spark, [*jobs, {"path": f"{tmp_path}/x", "make": make, "overwrite": True}]) == [False, False, True]
    assert len(calls) == 3


def test_pack_frames_checks_unique(spark):
    df = spark.createDataFrame([("f", 0, 1.0), ("f", 0, 2.0), ("f", 1, 3.0)], "frame string, position int, value double")
    with pytest.raises(Exception, match="not dense"):
        src.pack_frames(df, ["frame"], "position", unique=True).collect()


def test_pack_frames_order_and_density(spark):
    df = spark.createDataFrame([("a", 2, 3.0), ("a", 0, 1.0), ("a", 1, None)], "frame string, position int, value double")
    assert src.pack_frames(df, ["frame"], "position", size=3).first()["values"] == [1.0, None, 3.0]
    with pytest.raises(PySparkException):
        src.pack_frames(df, ["frame"], "position", size=4).collect()
    with pytest.raises(PySparkException):
        src.pack_frames(df.unionByName(df.limit(1)), ["frame"], "position").collect()
    assert src.pack_frames(df, ["frame"], "position", unique=True).first()["values"] == [1.0, None, 3.0]


def test_file_name_dates(spark):
    names = ["X.A2000060.061.hdf", "X.A2001060.061.hdf", "A.A123.A2000366.hdf", "X.2000060.hdf"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.time for r in gr.time_from_filename(df, strict=False).collect()}
    assert got[names[0]] == datetime.datetime(2000, 2, 29)
    assert got[names[1]] == datetime.datetime(2001, 3, 1)
    assert got[names[2]] == datetime.datetime(2000, 12, 31)
    assert got[names[3]] is None
    with pytest.raises(PySparkException):
        gr.time_from_filename(df).collect()


def test_completeness_is_not_fooled_by_duplicates(spark):
    expected = sp.time_spine(spark, "2024-01-01", "2024-01-03", "D")
    found = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-03",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("time"))
    assert gr.completeness(expected, found).first().asDict() == {"n_found": 3, "n_expected": 3, "n_difference": 0, "n_missing_days": 1}


def test_spines(spark):
    assert sp.time_spine(spark, "2024-01-01", "2024-01-01T07:00", "3h").count() == 3
    chunks = [(r.chunk_start.isoformat(), r.chunk_end.isoformat()) for r in sp.day_chunks(spark, "2024-01-01", "2024-01-08", 3).orderBy("chunk").collect()]
    assert chunks == [("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-06"), ("2024-01-07", "2024-01-08")]
    manifest = sp.request_manifest(spark, 2000, 2001, 6)
    assert manifest.count() == (366 + 365) * 4
    assert manifest.filter("month = 2 AND day > 28").count() == 4
    corner = {(r.lat_idx, r.lon_idx): (r.lat, r.lon) for r in sp.grid_spine(spark, 721, 1440).filter("lat_idx in (0, 720) and lon_idx in (0, 1439)").collect()}
    assert corner == {(0, 0): (90.0, 0.0), (0, 1439): (90.0, 359.75), (720, 0): (-90.0, 0.0), (720, 1439): (-90.0, 359.75)}


def test_strict_selection(spark, field):
    df = field([(1, "2024-01-01", 1.0), (1, "2024-01-02", 2.0)])
    assert select.select_times(df, ["2024-01-02"]).count() == 1
    with pytest.raises(select.MissingLabel):
        select.select_times(df, ["2024-01-02", "2024-01-03"])
    assert select.select_times(df, ["2024-01-02", "2024-01-03"], strict=False).count() == 1
    assert select.drop_constant_time(df, ["2024-01-01"]).columns == ["cell", "value"]
    assert select.drop_constant_time(df, ["2024-01-01", "2024-01-02"]).columns == ["cell", "time", "value"]
    channels = spark.createDataFrame([("a", 1.0)], "channel string, value double")
    with pytest.raises(select.MissingLabel):
        select.select_channels(channels, ["a", "b"])


def test_gates(spark, field):
    df = field([(1, "2024-01-01", 1.0), (2, "2024-01-01", None)])
    with pytest.raises(checks.IncompleteField):
        checks.require_complete(df)
    with pytest.raises(checks.IncompleteField):
        checks.require_complete(df.filter("cell = 1"), expected=2)
    assert checks.require_complete(df.filter("cell = 1"), expected=1).count() == 1
    with pytest.raises(PySparkException):
        checks.require_present(df).collect()
    faces = spark.createDataFrame([(0,), (11,)], "face int")
    assert checks.require_valid_face(faces).count() == 2
    with pytest.raises(PySparkException):
        checks.require_valid_face(spark.createDataFrame([(12,)], "face int")).collect()


def test_humidity_and_log_scale(spark):
    df = spark.createDataFrame([(100000.0, 283.15, 0.0)], "p double, td double, v double")
    row = df.select(physics.specific_humidity(F.col("p"), F.col("td")).alias("q"), physics.log_scale(F.col("v"), 0.1).alias("l")).first()
    e = 611.2 * math.exp(17.67 * 10.0 / (283.15 - 29.65))
    w = 0.622 * e / (100000.0 - e)
    assert row.q == pytest.approx(w / (1 + w)) and 0.0075 < row.q < 0.0078
    assert row.l == 0.0


def test_layouts_split_a_hot_time(spark, field):
    df = field([(c, "2024-01-01", 1.0) for c in range(2000)] + [(1, f"2024-02-{d:02d}", 1.0) for d in range(1, 20)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = src.layout_by_time(df.repartition(8), within=["cell"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in parts]
    assert max(sizes) < 1000 and sum(sizes) == 2019


def test_metadata_is_kept(spark, field):
    df = src.with_metadata(src.with_metadata(field([(1, "2024-01-01", 1.0)]), "value", {"a": 1}), "value", {"b": 2})
    assert df.schema["value"].metadata == {"a": 1, "b": 2}


def test_densify_gives_every_slot(spark, field):
    df = field([(1, "2024-01-02", 5.0)])
    cells = spark.createDataFrame([(1,), (2,)], "cell bigint")
    got = values(sp.densify(df, cells, ["cell"], sp.regular_times("2024-01-01", "2024-01-02", "D")), "cell", "time")
    assert got == {(1, "2024-01-01T00:00:00"): None, (1, "2024-01-02T00:00:00"): 5.0, (2, "2024-01-01T00:00:00"): None, (2, "2024-01-02T00:00:00"): None}


def test_files_are_ordered_and_only_overlapping_ones_searched(spark, field, tmp_path, monkeypatch):
    weeks = {"c": range(15, 22), "a": range(1, 8), "b": range(8, 15), "late": range(20, 25)}
    for name, days in weeks.items():
        rows = [(c, f"2024-01-{d:02d}", float(d)) for c in (1, 2) for d in days if not (name == "late" and d < 22 and c == 2)]
        field(rows).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    apart = [f"{tmp_path}/{n}" for n in "cab"]
    searched = []
    plain = src.duplicate_labels
    monkeypatch.setattr(src, "duplicate_labels", lambda df, keys: searched.append(df) or plain(df, keys))
    assert src.scan_union(spark, apart, ["cell", "time"], check=True, along="time").count() == 42
    assert searched.pop().count() == 0                                   # no file overlaps another: nothing is searched
    order = [(r.file.split("/")[-2], r.rows, r.stretch) for r in src.file_stretches(spark.read.parquet(*apart), "time").orderBy("low").collect()]
    assert order == [("a", 14, 0), ("b", 14, 1), ("c", 14, 2)]
    with pytest.raises(ValueError, match="more than once"):
        src.scan_union(spark, [*apart, f"{tmp_path}/late"], ["cell", "time"], check=True, along="time")
    assert {f.split("/")[-2] for f in searched[0].inputFiles()} == {"c", "late"}
    # Overlap without a common label is no error.
    field([(3, "2024-01-02", 1.0), (3, "2024-01-20", 1.0)]).coalesce(1).write.parquet(f"{tmp_path}/other")
    assert src.scan_union(spark, [*apart, f"{tmp_path}/other"], ["cell", "time"], check=True, along="time").count() == 44


def test_checks_ride_on_the_write(spark, field, tmp_path):
    def jobs_of(name, work):
        spark.sparkContext.setJobGroup(name, name)
        try:
            work()
        finally:
            spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    df = field([(c, "2024-01-01", float(c)) for c in range(50)])
    plain = jobs_of("plain", lambda: df.write.parquet(f"{tmp_path}/plain"))
    assert jobs_of("checked", lambda: checks.write_complete(df, f"{tmp_path}/good", 50)) == plain
    assert src.is_complete(spark, f"{tmp_path}/good") and spark.read.parquet(f"{tmp_path}/good").count() == 50
    assert not checks.write_complete(df, f"{tmp_path}/good", 51)           # is there: nothing is done
    for bad, expected in ((df, 49), (df.withColumn("value", F.when(F.col("cell") != 7, F.col("value"))), 50)):
        with pytest.raises(checks.IncompleteField):
            checks.write_complete(bad, f"{tmp_path}/bad", expected)
        assert not src.is_complete(spark, f"{tmp_path}/bad")
    assert checks.write_complete(df, f"{tmp_path}/bad", 50) and src.is_complete(spark, f"{tmp_path}/bad")
    empty = df.limit(0)
    assert checks.require_complete(empty, 0).count() == 0
    with pytest.raises(checks.IncompleteField):
        checks.require_complete(empty, 1)


def test_strict_merge_names_what_is_missing(spark):
    rows = [("inputs", ch, 0, t, 0, 1.0) for ch in ("a", "b") for t in ("2024-01-01", "2024-01-02")]
    store = spark.createDataFrame(rows, "role string, channel string, channel_idx int, time string, pix bigint, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    axis = lambda end: time_spine(spark, "2024-01-01", end, "D")
    assert jobs.merge_training({"inputs": [(store, ["a"]), (store, ["b"])]}, axis("2024-01-02")).count() == 4
    with pytest.raises(MissingLabel, match="2024-01-03"):
        jobs.merge_training({"inputs": [(store, ["a"])]}, axis("2024-01-03"))
    with pytest.raises(MissingLabel, match="channel c"):
        jobs.merge_training({"inputs": [(store, ["a", "c"])]}, axis("2024-01-02"))
    with pytest.raises(MissingLabel, match="channel a"):
        jobs.merge_training({"inputs": [(store, ["a"])], "targets": [(store, ["a"])]}, axis("2024-01-02"))
    assert jobs.merge_training({"inputs": [(store, ["a"])]}, axis("2024-01-03"), strict=False).count() == 2


def test_frames_are_cut_by_time(spark, tmp_path):
    rows = [("inputs", ch, 0, f"{y}-01-0{d}", p, 1.0) for ch in "ab" for y in (2023, 2024) for d in (1, 2) for p in range(12)]
    store = spark.createDataFrame(rows, "role string, channel string, channel_idx int, time string, pix bigint, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    path = f"{tmp_path}/frames"
    assert src.write_frames(jobs.pack_training(store, 1), path, files=2) and not src.write_frames(jobs.pack_training(store, 1), path)
    back = spark.read.parquet(path)
    assert back.count() == 2 * 4 * 12 and {r[0] for r in back.select("part").distinct().collect()} == {"y2023", "y2024"}
    assert len(back.inputFiles()) <= 2 * 2 * 2
