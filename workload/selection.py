"""B: label selection and projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import select
from gridlake.operators.spine import time_spine
from gridlake.sources import granules as gr
from workload import fixtures as fx
from workload.registry import query, rnd, srnd


@query("B1_time_slice", f"""
WITH {fx.CLIM_SQL}
SELECT cell, time, {srnd('value')} AS value FROM clim WHERE time BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '2000-11-30'
""")
def time_slice(spark, d):
    return select.time_slice(fx.clim(spark, d), "1996-02-01", "2000-11-30").select("cell", "time", rnd("value").alias("value"))


@query("B2_select_times", f"""
WITH {fx.OBS_SQL}
SELECT cell, time, {srnd('value')} AS value FROM obs
WHERE time IN (TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20')
""")
def select_times(spark, d):
    return select.select_times(fx.obs(spark, d), ["2024-01-02", "2024-01-03", "2024-01-20"]) \
        .select("cell", "time", rnd("value").alias("value"))


@query("B2_select_times_from", f"""
WITH {fx.OBS_SQL}
SELECT cell, time, {srnd('value')} AS value FROM obs WHERE extract('day' FROM time) % 3 = 1
""")
def select_times_from(spark, d):
    every_third = time_spine(spark, fx.OBS_START, fx.OBS_END, "3D")
    return select.select_times_from(fx.obs(spark, d), every_third).select("cell", "time", rnd("value").alias("value"))


@query("B3_select_level", """
SELECT l_orderkey AS cell, l_shipdate AS time, l_extendedprice AS value FROM lineitem WHERE l_linenumber = 1
""")
def select_level(spark, d):
    f = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("cell"), F.col("l_shipdate").alias("time"),
        F.col("l_linenumber").cast("double").alias("level"), F.col("l_extendedprice").alias("value"))
    return select.select_level(f, 1.0)


@query("B4_drop_constant_time", f"""
WITH {fx.OBS_SQL} SELECT cell, {srnd('value')} AS value FROM obs WHERE time = TIMESTAMP '2024-01-15'
""")
def drop_constant_time(spark, d):
    return select.drop_constant_time(fx.obs(spark, d), ["2024-01-15"]).select("cell", rnd("value").alias("value"))


@query("B5_select_channels", f"""
WITH {fx.CHANNELS_SQL}
SELECT channel, cell, time, {srnd('value')} AS value FROM channels WHERE channel IN ('click', 'view')
""")
def select_channels(spark, d):
    return select.select_channels(fx.channels(spark, d), ["click", "view"]) \
        .select("channel", "cell", "time", rnd("value").alias("value"))


@query("B6_first_varlev", """
SELECT l_orderkey AS cell, l_shipdate AS time, l_extendedprice AS value FROM lineitem WHERE l_linenumber - 1 = 0
""")
def first_varlev(spark, d):
    f = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("cell"), F.col("l_shipdate").alias("time"),
        (F.col("l_linenumber") - 1).alias("varlev"), F.col("l_extendedprice").alias("value"))
    return select.first_varlev(f)


@query("B7_drop_columns", "SELECT event_id, value FROM events")
def drop_columns(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "value", F.lit(0).alias("varlev"), F.lit(0.0).alias("mean"))
    return select.drop_columns(e)


@query("B8_cast_value", f"""
SELECT l_orderkey, l_linenumber, {srnd('CAST(CAST(l_extendedprice * l_discount AS FLOAT) AS DOUBLE)', 4)} AS value FROM lineitem
""")
def cast_value(spark, d):
    f = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_discount")).alias("value"))
    return select.cast_value(f).select("l_orderkey", "l_linenumber", rnd(F.col("value").cast("double"), 4).alias("value"))


@query("B9_granules_in_range", f"""
WITH {fx.DATED_SQL}, spine AS (
  SELECT unnest(generate_series(TIMESTAMP '{fx.CLIM_START}', TIMESTAMP '{fx.CLIM_END}', INTERVAL 36 HOUR)) AS time)
SELECT name, time FROM dated WHERE time IN (SELECT time FROM spine)
""")
def granules_in_range(spark, d):
    dated = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    spine = time_spine(spark, fx.CLIM_START, fx.CLIM_END, "36h")
    return gr.granules_in_range(dated, spine).select("name", "time")
