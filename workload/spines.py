"""C: spines and manifests, with ends and extents read from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import spine
from workload import fixtures as fx
from workload.registry import query


def order_range(spark, d):
    return fx.table(spark, d, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query("C1_time_spine", """
SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 3 HOUR)) AS time FROM orders
""")
def time_spine(spark, d):
    return spine.time_spine(order_range(spark, d), F.col("first"), F.col("last"), "3h")


@query("C2_day_chunks", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
k AS (SELECT a, b, unnest(range(CAST(date_diff('day', a, b) // 30 + 1 AS BIGINT))) AS chunk FROM r)
SELECT chunk, CAST(a + CAST(chunk * 30 AS INTEGER) AS DATE) AS chunk_start,
       least(CAST(a + CAST(chunk * 30 + 29 AS INTEGER) AS DATE), b) AS chunk_end
FROM k
""")
def day_chunks(spark, d):
    return spine.day_chunks(order_range(spark, d), F.col("first"), F.col("last"), 30)


@query("C3_request_manifest", """
WITH r AS (SELECT extract('year' FROM min(o_orderdate)) AS a, extract('year' FROM max(o_orderdate)) AS b FROM orders),
days AS (SELECT unnest(generate_series(make_timestamp(a, 1, 1, 0, 0, 0), make_timestamp(b, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS t FROM r)
SELECT CAST(extract('year' FROM t) AS INTEGER) AS year, CAST(extract('month' FROM t) AS INTEGER) AS month,
       CAST(extract('day' FROM t) AS INTEGER) AS day, CAST(h AS INTEGER) AS hour
FROM days, (SELECT unnest(range(0, 24, 3)) AS h)
""")
def request_manifest(spark, d):
    return spine.request_manifest(order_range(spark, d), F.year("first"), F.year("last"), 3)


@query("C4_grid_spine", f"""
WITH {fx.POINTS_SQL}, hits AS (
  SELECT CAST(floor((90.0 - lat) / 5.0 + 0.5) AS BIGINT) AS lat_idx,
         CAST(floor(lon / 5.0 + 0.5) AS BIGINT) % 72 AS lon_idx, count(*) AS n
  FROM points GROUP BY 1, 2)
SELECT a.lat_idx, o.lon_idx, 90.0::DOUBLE - a.lat_idx * 5.0::DOUBLE AS lat, o.lon_idx * 5.0::DOUBLE AS lon,
       coalesce(h.n, 0) AS n
FROM (SELECT unnest(range(37)) AS lat_idx) a CROSS JOIN (SELECT unnest(range(72)) AS lon_idx) o
LEFT JOIN hits h ON h.lat_idx = a.lat_idx AND h.lon_idx = o.lon_idx
""")
def grid_spine(spark, d):
    near = lambda c: F.floor(c / 5.0 + 0.5).cast("bigint")
    hits = fx.points(spark, d).groupBy(
        near(90.0 - F.col("lat")).alias("lat_idx"), (near(F.col("lon")) % 72).alias("lon_idx")
    ).agg(F.count(F.lit(1)).alias("n"))
    return spine.grid_spine(spark, 37, 72).join(hits, ["lat_idx", "lon_idx"], "left") \
        .withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
