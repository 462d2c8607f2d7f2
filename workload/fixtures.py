"""Views that turn the test tables into fields, and the SQL of the same views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.spine import densify, regular_times

OBS_START, OBS_END = "2024-01-01", "2024-01-30"
CLIM_START, CLIM_END = "1995-01-01", "2001-12-31"
NLAT, NLON, RES = 19, 36, 10.0        # the 10 degree grid
NSIDE = 4                             # 192 cells


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def day(column: str):
    return F.to_date(column).cast("timestamp_ntz")


def quarter(column: str):
    return F.date_trunc("quarter", column).cast("timestamp_ntz")


# Field values are square roots of means: means of amounts in cents often lie half-way between two
# rounded results, where the order of summation would decide the comparison.

# --- obs(cell, time, value): root of the daily mean per user; a day without events is missing -----

def obs_found(spark, d):
    return table(spark, d, "events").groupBy(F.col("user_id").alias("cell"), day("ts").alias("time")) \
        .agg(F.sqrt(F.avg("value")).alias("value"))


def obs(spark, d):
    found = obs_found(spark, d)
    cells = table(spark, d, "events").select(F.col("user_id").alias("cell")).distinct()
    return densify(found, cells, ["cell"], regular_times(OBS_START, OBS_END, "D"))


OBS_SQL = """
obs_found AS (
  SELECT user_id AS cell, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS time, sqrt(avg(value)) AS value
  FROM events GROUP BY 1, 2),
obs_days AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS time),
obs AS (
  SELECT c.cell, s.time, f.value
  FROM (SELECT DISTINCT user_id AS cell FROM events) c CROSS JOIN obs_days s
  LEFT JOIN obs_found f ON f.cell = c.cell AND f.time = s.time)
"""


# --- clim(cell, time, value): root of the daily mean price per supplier; days without are absent --

def clim(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("cell"), day("l_shipdate").alias("time")) \
        .agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))


CLIM_SQL = """
clim AS (
  SELECT l_suppkey AS cell, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS time, sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2)
"""


# --- granules(path): one satellite file name per order, some with another suffix -----------------

def granules(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.concat(
        F.lit("raw/MCD19A3CMG.A"), F.date_format("o_orderdate", "yyyy"),
        F.lpad(F.dayofyear("o_orderdate").cast("string"), 3, "0"),
        F.lit(".061."), F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderkey") % 7 == 0, ".xml").otherwise(".hdf"),
    ).alias("path"))


GRANULES_SQL = """
granules AS (
  SELECT 'raw/MCD19A3CMG.A' || strftime(o_orderdate, '%Y') || strftime(o_orderdate, '%j') || '.061.'
         || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 7 = 0 THEN '.xml' ELSE '.hdf' END AS path
  FROM orders)
"""
# The .hdf granules with the day in their name, by means other than the name.
DATED_SQL = """
dated AS (
  SELECT 'MCD19A3CMG.A' || strftime(o_orderdate, '%Y') || strftime(o_orderdate, '%j') || '.061.'
         || CAST(o_orderkey AS VARCHAR) || '.hdf' AS name,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS time
  FROM orders WHERE o_orderkey % 7 <> 0)
"""


# --- grid(time, lat_idx, lon_idx, value): root of the quarterly mean price on a 10 degree grid ---------------

def grid_found(spark, d):
    return table(spark, d, "lineitem").groupBy(
        quarter("l_shipdate").alias("time"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % NLAT).alias("lat_idx"),
        ((F.col("l_partkey") * 5 + F.col("l_suppkey")) % NLON).alias("lon_idx"),
    ).agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))


def quarters():
    return F.sequence(F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("2001-10-01").cast("timestamp_ntz"),
                      F.make_ym_interval(months=F.lit(3)))


def grid(spark, d):
    found = grid_found(spark, d)
    cells = spark.range(NLAT * NLON).select(
        F.floor(F.col("id") / NLON).alias("lat_idx"), (F.col("id") % NLON).alias("lon_idx"))
    return densify(found, cells, ["lat_idx", "lon_idx"], quarters())


def grid_filled(spark, d):
    """The grid with missing cells set to 0, for remaps that need every cell."""
    return grid(spark, d).withColumn("value", F.coalesce("value", F.lit(0.0)))


QUARTERS_SQL = """
quarters AS (
  SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-10-01', INTERVAL 3 MONTH)) AS time)
"""
GRID_SQL = QUARTERS_SQL + """,
grid_found AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS time,
         (l_orderkey * 7 + l_linenumber) % 19 AS lat_idx, (l_partkey * 5 + l_suppkey) % 36 AS lon_idx,
         sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2, 3),
grid AS (
  SELECT q.time, a.lat_idx, o.lon_idx, f.value
  FROM quarters q CROSS JOIN (SELECT unnest(range(19)) AS lat_idx) a CROSS JOIN (SELECT unnest(range(36)) AS lon_idx) o
  LEFT JOIN grid_found f ON f.time = q.time AND f.lat_idx = a.lat_idx AND f.lon_idx = o.lon_idx)
"""


# --- hfield(time, pix, value): root of the quarterly mean price on HEALPix cells, every cell at every quarter ---

def hfield_found(spark, d, *extra):
    return table(spark, d, "lineitem").groupBy(
        quarter("l_shipdate").alias("time"), *extra,
        ((F.col("l_orderkey") * 13 + F.col("l_partkey")) % (12 * NSIDE * NSIDE)).alias("pix"),
    ).agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))


def hfield(spark, d):
    cells = spark.range(12 * NSIDE * NSIDE).withColumnRenamed("id", "pix")
    return densify(hfield_found(spark, d), cells, ["pix"], quarters())


HFIELD_SQL = QUARTERS_SQL + """,
hfield_found AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS time, (l_orderkey * 13 + l_partkey) % 192 AS pix,
         sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2),
hfield AS (
  SELECT q.time, c.pix, f.value
  FROM quarters q CROSS JOIN (SELECT unnest(range(192)) AS pix) c
  LEFT JOIN hfield_found f ON f.time = q.time AND f.pix = c.pix)
"""


# --- points(id, lon, lat, value): one sample per lineitem ----------------------------------------

def points(spark, d):
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        ((k * 97 + p * 31) % 36000 / F.lit(100.0) + 0.003).alias("lon"),
        (((p * 53 + s * 17 + k) % 17998 - 8999) / F.lit(100.0) + 0.0007).alias("lat"),
        F.col("l_quantity").alias("value"),
    )


POINTS_SQL = """
points AS (
  SELECT ((l_orderkey * 97 + l_partkey * 31) % 36000) / 100.0::DOUBLE + 0.003::DOUBLE AS lon,
         ((l_partkey * 53 + l_suppkey * 17 + l_orderkey) % 17998 - 8999) / 100.0::DOUBLE + 0.0007::DOUBLE AS lat,
         l_quantity AS value
  FROM lineitem)
"""


# --- channels(channel, cell, time, value): daily mean per event type and user --------------------

CHANNELS = ["click", "error", "purchase", "signup", "view"]


def channels(spark, d):
    return table(spark, d, "events").groupBy(
        F.col("event_type").alias("channel"), F.col("user_id").alias("cell"), day("ts").alias("time")
    ).agg(F.avg("value").alias("value"))


CHANNELS_SQL = """
channels AS (
  SELECT event_type AS channel, user_id AS cell, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS time, avg(value) AS value
  FROM events GROUP BY 1, 2, 3)
"""


# --- sp, td(cell, time, value): two event types scaled to pressure (Pa) and dewpoint (K) ----------

def sp_field(spark, d):
    return channels(spark, d).filter("channel = 'view'").select(
        "cell", "time", (F.lit(85000.0) + F.col("value") * 60.0).alias("value"))


def td_field(spark, d):
    return channels(spark, d).filter("channel = 'click'").select(
        "cell", "time", (F.lit(250.0) + F.pmod(F.col("value"), F.lit(50.0))).alias("value"))


HUMID_SQL = CHANNELS_SQL + """,
sp AS (SELECT cell, time, 85000.0::DOUBLE + value * 60.0::DOUBLE AS value FROM channels WHERE channel = 'view'),
td AS (SELECT cell, time, 250.0::DOUBLE + (value % 50.0::DOUBLE) AS value FROM channels WHERE channel = 'click')
"""


# --- static shapes: polygons as edges, triangles with vertices ----------------------------------

# A square, a concave shape, and a square with a hole (made-up test shapes, closed rings).
POLYGONS = [
    ("square", 0, 0, [(-60.0, 55.0), (-15.0, 55.0), (-15.0, 85.0), (-60.0, 85.0), (-60.0, 55.0)]),
    ("concave", 0, 0, [(10.0, -50.0), (100.0, -50.0), (100.0, 20.0), (55.0, -30.0), (10.0, 20.0), (10.0, -50.0)]),
    ("holed", 0, 0, [(-150.0, -40.0), (-90.0, -40.0), (-90.0, 40.0), (-150.0, 40.0), (-150.0, -40.0)]),
    ("holed", 0, 1, [(-135.0, -20.0), (-105.0, -20.0), (-105.0, 20.0), (-135.0, 20.0), (-135.0, -20.0)]),
]
EDGES = [
    (poly, part, ring, x1, y1, x2, y2)
    for poly, part, ring, ps in POLYGONS
    for (x1, y1), (x2, y2) in zip(ps, ps[1:])
]
EDGE_SCHEMA = "poly string, part int, ring int, x1 double, y1 double, x2 double, y2 double"


def polygon_edges(spark):
    return spark.createDataFrame(EDGES, EDGE_SCHEMA)


EDGES_SQL = "edges(poly, part, ring, x1, y1, x2, y2) AS (VALUES " + ", ".join(
    f"('{p}', {a}, {r}, {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for p, a, r, x1, y1, x2, y2 in EDGES
) + ")"

# A fan of four triangles around (180, 0) that covers longitudes 0..360 and latitudes -90..90.
VERTICES = [(0, 180.0, 0.0), (1, 0.0, -90.0), (2, 360.0, -90.0), (3, 360.0, 90.0), (4, 0.0, 90.0)]
TRIANGLES = [(0, 0, 1, 2), (1, 0, 2, 3), (2, 0, 3, 4), (3, 0, 4, 1)]


def triangles(spark):
    return (spark.createDataFrame(TRIANGLES, "tri bigint, v0 bigint, v1 bigint, v2 bigint"),
            spark.createDataFrame(VERTICES, "v bigint, x double, y double"))


TRIANGLES_SQL = "vertices(v, x, y) AS (VALUES " + ", ".join(
    f"({v}::BIGINT, {x}::DOUBLE, {y}::DOUBLE)" for v, x, y in VERTICES
) + "), triangles(tri, v0, v1, v2) AS (VALUES " + ", ".join(
    f"({t}::BIGINT, {a}::BIGINT, {b}::BIGINT, {c}::BIGINT)" for t, a, b, c in TRIANGLES
) + ")"
