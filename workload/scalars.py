"""I: scalar functions, and J: quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions import geo, healpix, physics, timeaxis
from gridlake.operators import checks
from gridlake.sources import granules as gr
from workload import fixtures as fx
from workload.registry import query, rnd, srnd
from workload.spatial import N, PIX_SQL, even_sql, odd_sql, order_pixels, spread_sql

Q_SQL = """
hum AS (
  SELECT cell, time, sp.value AS p, 611.2::DOUBLE * exp(17.67::DOUBLE * (td.value - 273.15::DOUBLE) / (td.value - 29.65::DOUBLE)) AS e
  FROM sp JOIN td USING (cell, time)),
mix AS (SELECT *, 0.622::DOUBLE * e / (p - e) AS w FROM hum)
"""


@query("I1_specific_humidity", f"WITH {fx.HUMID_SQL}, {Q_SQL} SELECT cell, time, {srnd('w / (1 + w)', 9)} AS q FROM mix")
def humidity(spark, d):
    both = fx.sp_field(spark, d).withColumnRenamed("value", "sp").join(
        fx.td_field(spark, d).withColumnRenamed("value", "td"), ["cell", "time"])
    return both.select("cell", "time", rnd(physics.specific_humidity(F.col("sp"), F.col("td")), 9).alias("q"))


@query("I2_log_scale", f"SELECT event_id, {srnd('ln((value + 0.01::DOUBLE) / 0.01::DOUBLE)')} AS value FROM events")
def log_scale(spark, d):
    return fx.table(spark, d, "events").select("event_id", rnd(physics.log_scale(F.col("value"), 0.01)).alias("value"))


@query("I3_lon_to_pm180", f"""
WITH {fx.POINTS_SQL} SELECT {srnd('CASE WHEN lon > 180 THEN lon - 360 ELSE lon END')} AS lon, {srnd('lat')} AS lat FROM points
""")
def pm180(spark, d):
    return fx.points(spark, d).select(rnd(geo.lon_to_pm180(F.col("lon"))).alias("lon"), rnd("lat").alias("lat"))


@query("I4_difference", f"SELECT l_orderkey, l_linenumber, {srnd('l_extendedprice - l_quantity')} AS value FROM lineitem")
def difference(spark, d):
    return fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", rnd(physics.difference(F.col("l_extendedprice"), F.col("l_quantity"))).alias("value"))


@query("I5_time_functions", """
SELECT event_id, date_trunc('hour', ts) AS hour, strftime(ts, '%Y%m%dT%H%M') AS label,
       CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS parsed FROM events
""")
def time_functions(spark, d):
    t = F.col("ts")
    return fx.table(spark, d, "events").select(
        "event_id", timeaxis.truncate_hour(t).alias("hour"), timeaxis.frame_label(t).alias("label"),
        timeaxis.parse_iso(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).alias("parsed"))


@query("I6_window_rows", """
SELECT event_id, CAST(floor((event_id % 500000) / (1 + user_id)) AS BIGINT) AS n FROM events
""")
def window_rows(spark, d):
    return fx.table(spark, d, "events").select(
        "event_id", timeaxis.window_rows_col(F.col("event_id") % 500000, 1 + F.col("user_id")).alias("n"))


@query("I7_angles", f"""
WITH {fx.POINTS_SQL}
SELECT {srnd('lon')} AS lon, {srnd('radians(lon)')} AS rad, {srnd('sin(radians(lat))')} AS z,
       {srnd('degrees(asin(sin(radians(lat))))')} AS lat, {srnd('degrees(radians(lon) / 2)')} AS half FROM points
""")
def angles(spark, d):
    z = geo.sin_of_latitude(F.col("lat"))
    rad = geo.to_radians(F.col("lon"))
    return fx.points(spark, d).select(
        rnd("lon").alias("lon"), rnd(rad).alias("rad"), rnd(z).alias("z"),
        rnd(geo.latitude_of_sin(z)).alias("lat"), rnd(geo.to_degrees(rad / 2)).alias("half"))


@query("I8_bit_ops", f"""
SELECT l_orderkey, l_partkey, {even_sql(f'l_orderkey % {N * N}', 6)} AS even, {odd_sql(f'l_orderkey % {N * N}', 6)} AS odd,
       {spread_sql(f'l_partkey % {N}', 6)} + 2 * {spread_sql(f'l_suppkey % {N}', 6)} AS woven
FROM lineitem
""")
def bit_ops(spark, d):
    r = F.col("l_orderkey") % (N * N)
    return fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", healpix.even_bits(r, N).alias("even"), healpix.odd_bits(r, N).alias("odd"),
        healpix.interleave(F.col("l_partkey") % N, F.col("l_suppkey") % N, N).alias("woven"))


@query("I9_file_names", f"""
WITH {fx.GRANULES_SQL}
SELECT path, split_part(split_part(path, '/', 2), '.', 2) AS token,
       CAST(substring(split_part(path, '.', 2), 2, 4) AS INTEGER) AS year, CAST(substring(split_part(path, '.', 2), 6, 3) AS INTEGER) AS doy,
       regexp_replace(path, '[.](hdf|xml)$', '_temp.nc') AS staged
FROM granules
""")
def file_names(spark, d):
    token = gr.date_token(F.element_at(F.split("path", "/"), -1))
    return fx.granules(spark, d).select(
        "path", token.alias("token"), F.substring(token, 2, 4).cast("int").alias("year"),
        F.substring(token, 6, 3).cast("int").alias("doy"),
        F.regexp_replace("path", r"[.](hdf|xml)$", "_temp.nc").alias("staged"))


@query("J1_completeness_report", f"""
WITH {fx.OBS_SQL}
SELECT count(*) AS n_rows, count(*) - count(value) AS n_missing, (SELECT count(DISTINCT user_id) * 30 FROM events) AS n_expected,
       count(value) = count(*) AS complete FROM obs
""")
def completeness(spark, d):
    cells = fx.table(spark, d, "events").select("user_id").distinct().count()
    return checks.completeness_report(fx.obs(spark, d), cells * 30)


@query("J1_require_complete", f"WITH {fx.OBS_SQL} SELECT cell, time, {srnd('coalesce(value, 0.0)')} AS value FROM obs")
def require_complete(spark, d):
    full = fx.obs(spark, d).withColumn("value", F.coalesce("value", F.lit(0.0)))
    cells = fx.table(spark, d, "events").select("user_id").distinct().count()
    return checks.require_present(checks.require_complete(full, cells * 30)).select("cell", "time", rnd("value").alias("value"))


@query("J2_require_valid_face", f"WITH {PIX_SQL} SELECT id, CAST(pix // {N * N} AS INTEGER) AS face FROM p")
def valid_face(spark, d):
    return checks.require_valid_face(healpix.with_face_height_width(order_pixels(spark, d), N)).select("id", "face")
