"""A: scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.cluster import scratch_path, stage_table
from gridlake.operators.spine import densify, regular_times, time_spine
from gridlake.sources import fields as src
from gridlake.sources import granules as gr
from workload import fixtures as fx
from workload.registry import query, rnd, srnd


@query("A1_scan_field", """
SELECT l_orderkey, l_linenumber, l_shipdate AS time, l_extendedprice AS value FROM lineitem
""")
def scan_field(spark, d):
    return src.scan_field(spark, f"{d}/lineitem.parquet", "l_extendedprice",
                          ["l_orderkey", "l_linenumber", F.col("l_shipdate").alias("time")])


@query("A2_scan_union", f"WITH {fx.CLIM_SQL} SELECT cell, time, {srnd('value')} AS value FROM clim")
def scan_union(spark, d):
    field = fx.clim(spark, d)
    odd = stage_table(field.filter(F.year("time") % 2 == 1), "odd-years")
    even = stage_table(field.filter(F.year("time") % 2 == 0).select("value", "time", "cell"), "even-years")
    files = [df.inputFiles() for df in (odd, even)]
    both = src.scan_union(spark, [f for part in files for f in part], ["cell", "time"], check=True)
    return both.select("cell", "time", rnd("value").alias("value"))


def weekly_files(spark, d):
    """Files of one field with a week each, as a field arrives over time."""
    field = stage_table(fx.obs(spark, d), "obs")
    week = F.floor((F.dayofmonth("time") - 1) / 7)
    return [f for k in range(5) for f in stage_table(field.filter(week == k).coalesce(1), "week").inputFiles()]


@query("A2_concat_fields", f"WITH {fx.OBS_SQL} SELECT cell, time, {srnd('value')} AS value FROM obs")
def concat_fields(spark, d):
    files = weekly_files(spark, d)
    some = src.scan_union(spark, files[::2], ["cell", "time"], check=True, along="time")
    rest = src.scan_union(spark, files[1::2], ["cell", "time"], check=True, along="time")
    return src.concat_fields([some, rest]).select("cell", "time", rnd("value").alias("value"))


@query("A2_file_stretches", f"""
WITH {fx.OBS_SQL}
SELECT CAST((dayofmonth(time) - 1) // 7 AS BIGINT) AS stretch, min(time) AS low, max(time) AS high, count(*) AS rows
FROM obs GROUP BY 1
""")
def file_stretches(spark, d):
    field = spark.read.parquet(*reversed(weekly_files(spark, d)))
    return src.file_stretches(field, "time").select("stretch", "low", "high", "rows")


@query("A2_duplicate_labels", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_labels(spark, d):
    return src.duplicate_labels(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("A3_time_from_filename", f"WITH {fx.DATED_SQL} SELECT name, time FROM dated")
def time_from_filename(spark, d):
    return gr.time_from_filename(gr.list_granules(fx.granules(spark, d))).select("name", "time")


@query("A4_rename_conventions", """
SELECT ts AS time, user_id AS latitude, event_id AS longitude, value AS ndvi FROM events
""")
def rename_conventions(spark, d):
    old = fx.table(spark, d, "events").select(
        F.col("ts").alias("valid_time"), F.col("user_id").alias("YDim:CMGgrid"),
        F.col("event_id").alias("lon"), F.col("value").alias("predictors"))
    return src.rename_conventions(old, "ndvi")


@query("A5_assign_grid_coords", f"""
SELECT l_orderkey % 3600 AS y, l_partkey % 7200 AS x,
       {srnd('90.0::DOUBLE + (-0.05::DOUBLE) * (l_orderkey % 3600)')} AS lat,
       {srnd('-180.0::DOUBLE + 0.05::DOUBLE * (l_partkey % 7200)')} AS lon
FROM lineitem
""")
def assign_grid_coords(spark, d):
    cells = fx.table(spark, d, "lineitem").select(
        (F.col("l_orderkey") % 3600).alias("y"), (F.col("l_partkey") % 7200).alias("x"))
    return src.assign_grid_coords(cells).select("y", "x", rnd("lat").alias("lat"), rnd("lon").alias("lon"))


@query("A6_shift_longitude", f"""
WITH {fx.POINTS_SQL}
SELECT {srnd('((lon - 180.0::DOUBLE) + 360.0::DOUBLE) % 360.0::DOUBLE')} AS lon, {srnd('lat')} AS lat, value FROM points
""")
def shift_longitude(spark, d):
    p = fx.points(spark, d).withColumn("lon", F.col("lon") - 180.0)
    return src.shift_longitude(p).select(rnd("lon").alias("lon"), rnd("lat").alias("lat"), "value")


@query("A7_write_field", f"WITH {fx.OBS_SQL} SELECT cell, time, {srnd('value')} AS value FROM obs")
def write_field(spark, d):
    path = scratch_path(spark, "field")
    field = fx.obs(spark, d)
    src.write_field(field, path)
    # A finished field is there: this write must be skipped, before any work.
    src.write_field(field.filter("value IS NULL"), path)
    return spark.read.parquet(path).select("cell", "time", rnd("value").alias("value"))


FRAME_CELLS = 48
FRAME_SQL = f"""
WITH {fx.CHANNELS_SQL}, frame_cells AS (
  SELECT channel, time, cell % {FRAME_CELLS} AS pix, avg(value) AS value FROM channels GROUP BY 1, 2, 3),
days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS time)
SELECT c.channel, t.time, CAST(p.pix AS INTEGER) AS position,
       {srnd('CAST(CAST(f.value AS FLOAT) AS DOUBLE)', 4)} AS value
FROM (SELECT DISTINCT channel FROM channels) c CROSS JOIN days t CROSS JOIN (SELECT unnest(range({FRAME_CELLS})) AS pix) p
LEFT JOIN frame_cells f ON f.channel = c.channel AND f.time = t.time AND f.pix = p.pix
"""


def frame_store(spark, d):
    found = fx.channels(spark, d).groupBy("channel", "time", (F.col("cell") % FRAME_CELLS).alias("pix")) \
        .agg(F.avg("value").alias("value"))
    cells = found.select("channel").distinct().select(
        "channel", F.explode(F.sequence(F.lit(0), F.lit(FRAME_CELLS - 1)).cast("array<bigint>")).alias("pix"))
    return densify(found, cells, ["channel", "pix"], regular_times(fx.OBS_START, fx.OBS_END, "D"))


@query("A8_pack_frames", FRAME_SQL)
def pack_frames(spark, d):
    packed = src.pack_frames(frame_store(spark, d), ["channel", "time"], "pix", size=FRAME_CELLS)
    return src.unpack_frames(packed, ["channel", "time"]).select(
        "channel", "time", "position", rnd(F.col("value").cast("double"), 4).alias("value"))


@query("A8_write_frames", FRAME_SQL)
def write_frames(spark, d):
    packed = src.pack_frames(frame_store(spark, d), ["channel", "time"], "pix", size=FRAME_CELLS)
    path = scratch_path(spark, "frames")
    src.write_frames(packed.withColumn("role", F.lit("inputs")), path)
    return src.unpack_frames(spark.read.parquet(path), ["channel", "time"]).select(
        "channel", "time", "position", rnd(F.col("value").cast("double"), 4).alias("value"))


@query("A9_layout_by_cell", f"WITH {fx.CLIM_SQL} SELECT cell, time, {srnd('value')} AS value FROM clim")
def layout_by_cell(spark, d):
    return src.layout_by_cell(fx.clim(spark, d), ["cell"]).select("cell", "time", rnd("value").alias("value"))


@query("A9_layout_by_time", f"WITH {fx.CLIM_SQL} SELECT cell, time, {srnd('value')} AS value FROM clim")
def layout_by_time(spark, d):
    return src.layout_by_time(fx.clim(spark, d), within=["cell"]).select("cell", "time", rnd("value").alias("value"))


@query("A10_with_metadata", f"""
WITH {fx.OBS_SQL} SELECT cell, time, {srnd('value')} AS value, 6 AS accumulation_period FROM obs
""")
def with_metadata(spark, d):
    df = src.with_metadata(fx.obs(spark, d), "value", {"accumulation_period": 6})
    note = df.schema["value"].metadata["accumulation_period"]
    return df.select("cell", "time", rnd("value").alias("value"), F.lit(note).alias("accumulation_period"))


@query("A11_list_granules", f"""
WITH {fx.GRANULES_SQL} SELECT path, replace(path, 'raw/', '') AS name FROM granules WHERE path LIKE '%.hdf'
""")
def list_granules(spark, d):
    return gr.list_granules(fx.granules(spark, d))


DAYS_SQL = f"""
days AS (SELECT unnest(generate_series(TIMESTAMP '{fx.CLIM_START}', TIMESTAMP '{fx.CLIM_END}', INTERVAL 1 DAY)) AS time)
"""


@query("A12_pending_granules", f"""
WITH {DAYS_SQL}, {fx.DATED_SQL} SELECT time FROM days WHERE time NOT IN (SELECT time FROM dated)
""")
def pending_granules(spark, d):
    done = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    return gr.pending_granules(time_spine(spark, fx.CLIM_START, fx.CLIM_END, "D"), done, "time")
