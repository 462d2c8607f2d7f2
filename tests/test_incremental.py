import glob
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlake.cluster import scratch_path
from gridlake.operators import stats as st
from gridlake.operators import temporal as tm
from gridlake.operators.spine import densify, grid_spine, time_spine
from gridlake.plans import incremental as inc
from gridlake.plans import jobs
from gridlake.sources import parts

COARSE = jobs.IndexGrid(ny=6, nx=12, lat0=75.0, dlat=-30.0, lon0=-180.0, dlon=30.0)
EDGES = [("p", 0, 0, 0.0, 0.0, 60.0, 0.0), ("p", 0, 0, 60.0, 0.0, 30.0, 60.0), ("p", 0, 0, 30.0, 60.0, 0.0, 0.0)]


def files_of(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_labels_and_spans():
    assert parts.part_label(datetime(2001, 3, 5), "month") == "m2001-03"
    assert parts.part_span("y2000") == (datetime(2000, 1, 1), datetime(2001, 1, 1))
    assert parts.part_span("m2000-12") == (datetime(2000, 12, 1), datetime(2001, 1, 1))
    assert parts.part_span("d2000-02-29") == (datetime(2000, 2, 29), datetime(2000, 3, 1))
    assert parts.parts_between(datetime(1999, 12, 31), datetime(2000, 2, 1), "month") == ["m1999-12", "m2000-01", "m2000-02"]
    known = {f"m2000-{m:02d}" for m in range(1, 13)}
    assert inc.parts_reached({"m2000-03"}, known, 3 * 86400, "month") == {"m2000-03", "m2000-04"}
    assert inc.parts_reached({"m2000-12"}, known, 3 * 86400, "month") == {"m2000-12"}
    assert inc.parts_needed({"m2000-03"}, known, 40 * 86400, "month") == {"m2000-01", "m2000-02", "m2000-03"}


def hpx_field(spark, nside, days):
    cells = spark.range(12 * nside * nside).withColumnRenamed("id", "pix")
    return cells.select("pix", F.explode(F.sequence(F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(days).cast("timestamp_ntz"),
                                                    F.make_dt_interval(days=F.lit(1)))).alias("time")).withColumn(
        "value", F.col("pix") * 0.5 + F.dayofyear("time"))


def test_a_layout_prunes_time_and_cells(spark):
    path = scratch_path(spark, "layout")
    df = hpx_field(spark, 8, "2001-12-31")
    parts.write_parts(df, path, "year", nside=8, files=8)
    path = path.removeprefix("file://")
    assert len(files_of(path)) <= 16
    back = spark.read.parquet(path).drop("part")
    assert back.count() == df.count() and back.exceptAll(df.select(*back.columns)).count() == 0
    some = parts.read_slice(spark, path, datetime(2001, 2, 1), datetime(2001, 2, 28))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "y2001" in plan
    files = [r[0] for r in some.select(F.input_file_name()).distinct().collect()]
    assert files and all("part=y2001" in f for f in files)
    assert some.count() == 28 * 768
    # A face's cells and a month of days lie in few of the files.
    meets = 0
    for f in files_of(path):
        meta = pq.read_metadata(f"{path}/{f}")
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        s = [meta.row_group(g).column(at["pix"]).statistics for g in range(meta.num_row_groups)]
        meets += any(x.min < 64 and x.max >= 0 for x in s)
    assert meets <= 8
    pushed = spark.read.parquet(path).filter("pix < 64")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in pushed and "LessThan(pix,64)" in pushed


def test_parts_are_replaced_one_by_one(spark):
    path = scratch_path(spark, "replace")
    df = hpx_field(spark, 1, "2000-03-31")
    parts.write_parts(df, path, "month", nside=1)
    before = files_of(path.removeprefix("file://"))
    old = parts.read_parts(spark, path, ["m2000-02"]).drop("part")
    parts.write_parts(old.withColumn("value", -F.col("value")), path, "month", nside=1, only=["m2000-02"])
    after = files_of(path.removeprefix("file://"))
    assert {k for k in before if k in after and before[k] == after[k]} == {k for k in before if "m2000-02" not in k}
    got = spark.read.parquet(path).groupBy("part").agg(F.count("*"), F.min("value")).collect()
    assert {r[0]: (r[1], r[2] < 0) for r in got} == {"m2000-01": (372, False), "m2000-02": (348, True), "m2000-03": (372, False)}


def granules(spark, days, seed=1):
    rows = []
    for k, day in enumerate(days):
        doy = datetime.fromisoformat(day).timetuple().tm_yday
        for y in range(6):
            for x in range(12):
                if (y * 7 + x * 3 + k * 5 + seed) % 4:               # some cells have no value that day
                    rows.append((f"raw/MCD19A3CMG.A{day[:4]}{doy:03d}.061.hdf", y, x, float((y * 31 + x * 17 + k * 13 + seed) % 50)))
    return spark.createDataFrame(rows, "path string, y int, x int, value double")


def build(spark, name):
    return inc.Build(root=scratch_path(spark, name), spine=time_spine(spark, "2000-01-01", "2000-08-31", "D"), ll_cells=grid_spine(spark, 7, 12),
                     edges=spark.createDataFrame(EDGES, "poly string, part int, ring int, x1 double, y1 double, x2 double, y2 double"),
                     nside=2, nlat=7, nlon=12, period="month", grid=COARSE, files=2)


def store(b):
    return sorted((tuple(r) for r in inc.satellite_store(b).withColumn("value", F.round("value", 4)).collect()), key=str)


DAYS = [f"2000-{m:02d}-{d:02d}" for m in range(1, 9) for d in (2, 9, 10, 16, 23)]


def test_added_days_give_the_store_of_a_full_build(spark, monkeypatch):
    every = granules(spark, DAYS)
    day = F.substring(F.substring_index("path", ".A", -1), 1, 7)
    whole = build(spark, "whole")
    inc.add_granules(whole, every, every.select("path").distinct())
    want = store(whole)

    # The full build is what the stages give in one go.
    sat = jobs.process_satellite(every, every.select("path").distinct(), whole.spine, whole.ll_cells.select("lat"), whole.ll_cells.select("lon"), COARSE)
    sat = sat.join(whole.ll_cells, ["lat", "lon"]).select("time", "lat_idx", "lon_idx", "value")
    times = F.sequence(F.lit("2000-01-01").cast("timestamp_ntz"), F.lit("2000-08-31").cast("timestamp_ntz"), F.make_dt_interval(days=F.lit(1)))
    ndvi = jobs.mask_job(jobs.remap_job(jobs.impute_job(densify(sat, whole.ll_cells, ["lat_idx", "lon_idx"], times), -1.0), 2, 7, 12),
                         2, whole.edges, -1.0, mask_south=True)
    plain = sorted(((r.time, r.pix, round(r.value, 4)) for r in ndvi.withColumn("value", F.col("value").cast("float")).collect()))
    assert [(t, p, round(v, 4)) for role, _, _, t, p, v in want if role == "inputs"].__len__() == len(plain)
    assert sorted((t, p, round(v, 4)) for role, _, _, t, p, v in want if role == "inputs") == plain

    grown = build(spark, "grown")
    missing = [f"2000{datetime(2000, 3, d).timetuple().tm_yday:03d}" for d in (9, 10)]
    some = every.filter(~day.isin(missing))
    inc.add_granules(grown, some, some.select("path").distinct())
    assert store(grown) != want
    before = files_of(grown.at("ndvi").removeprefix("file://"))
    asked = []
    plainly = parts.read_parts
    monkeypatch.setattr(inc, "read_parts", lambda s, p, only=None: asked.append((p.rsplit("/")[-1], set(only))) or plainly(s, p, only))
    late = every.filter(day == missing[0])
    changed = inc.add_granules(grown, late, late.select("path").distinct())
    assert changed["ndvi"] <= {"m2000-02", "m2000-03"} and "m2000-03" in changed["ndvi"] and changed["satellite"] == {"m2000-03"}
    assert all(only <= {"m2000-02", "m2000-03"} for _, only in asked)                    # of eight months
    after = files_of(grown.at("ndvi").removeprefix("file://"))
    assert {k for k in before if after.get(k) != before[k]} == {k for k in before if k.split("/")[0][5:] in changed["ndvi"]}
    last = every.filter(day == missing[1])
    inc.add_granules(grown, last, last.select("path").distinct())
    assert store(grown) == want
    # Once more changes nothing, nor does a day off the axis.
    inc.add_granules(grown, last, last.select("path").distinct())
    assert store(grown) == want
    off = granules(spark, ["2001-05-05"])
    assert inc.add_granules(grown, off, off.select("path").distinct()) == {"nearest": set(), "satellite": set(), "ndvi": set()}


def test_neighbours_far_away_are_reached(spark, field):
    # Cell 1 has no value from February to April: a new value in May changes its months back to January.
    rows = [(c, f"2000-{m:02d}-15", None if c == 1 and 2 <= m <= 5 else float(m * c)) for c in (1, 2) for m in range(1, 8)]
    df = field(rows).withColumn("part", parts.part_of(F.col("time"), "month"))
    new = df.withColumn("value", F.when((F.col("cell") == 1) & (F.month("time") == 5), 100.0).otherwise(F.col("value")))
    a, b = (inc.around(inc.ends_of(x, ["cell"]), ["cell"]) for x in (df, new))
    assert inc.changed_parts(a, b, ["cell"]) == {"m2000-02", "m2000-03", "m2000-04", "m2000-06", "m2000-01", "m2000-07"} - {"m2000-07"}
    some = new.filter(F.col("part").isin("m2000-02", "m2000-03", "m2000-04"))
    got = {(r.cell, r.time): r.value for r in inc.interpolate_parts(some, b, ["cell"]).collect()}
    want = {(r.cell, r.time): r.value for r in tm.interpolate_time(new.drop("part")).collect()}
    assert len(got) == 6 and all(want[k] == pytest.approx(v) for k, v in got.items())


def test_states_add_up_without_the_old_field(spark, field):
    rows = [(c, f"{y}-{m:02d}-{d:02d}", None if (c + y + m) % 7 == 0 else float((c * 31 + y * 7 + m * 3 + d) % 19))
            for c in range(3) for y in (1999, 2000, 2001) for m in (1, 2, 3, 12) for d in (1, 28)]
    df = field(rows)
    path, target = scratch_path(spark, "field"), scratch_path(spark, "states")
    parts.write_parts(df.filter(F.year("time") < 2001), path, "year", cell=["cell"])
    inc.update_states(spark, path, target, {"y1999", "y2000"}, ["cell"])
    alone = scratch_path(spark, "alone")                    # only the new year lies here
    parts.write_parts(df.filter(F.year("time") == 2001), alone, "year", cell=["cell"])
    inc.update_states(spark, alone, target, {"y2001"}, ["cell"])
    state = st.merge_states(spark.read.parquet(target).drop("part"))
    rounded = lambda d: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.collect()), key=str)
    assert rounded(st.climatology_of_state(state)) == rounded(st.doy_climatology(df))
    assert rounded(st.metas_of_state(state, "v")) == rounded(st.clim_metas(df, "v"))
    # A year that came again replaces its own state and is not counted twice.
    inc.update_states(spark, alone, target, {"y2001"}, ["cell"])
    assert rounded(st.climatology_of_state(st.merge_states(spark.read.parquet(target).drop("part")))) == rounded(st.doy_climatology(df))
