"""H: stacking channels, reshaping, and comparing stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import reshape as rs
from gridlake.operators import temporal as tm
from gridlake.operators.spine import densify, hpx_cells
from workload import fixtures as fx
from workload.registry import query, rnd, srnd
from workload.spatial import CELLS4_SQL, ring_weights_sql
from workload.temporal import interp_sql

ORDER_SQL = "list_position(['click', 'error', 'purchase', 'signup', 'view'], channel) - 1"


def per_channel(spark, d):
    stored = fx.channels(spark, d)
    return {c: stored.filter(F.col("channel") == c).drop("channel") for c in fx.CHANNELS}


@query("H1_stack_channels", f"""
WITH {fx.CHANNELS_SQL}
SELECT 'inputs' AS role, channel, CAST({ORDER_SQL} AS INTEGER) AS channel_idx, cell, time, {srnd('value')} AS value FROM channels
""")
def stack(spark, d):
    return rs.stack_channels(per_channel(spark, d), "inputs").select(
        "role", "channel", "channel_idx", "cell", "time", rnd("value").alias("value"))


@query("H1_stack_columns", """
SELECT l_orderkey AS cell, l_shipdate AS time, 'targets' AS role, u.channel, CAST(u.k AS INTEGER) AS channel_idx,
       CASE u.k WHEN 0 THEN l_quantity WHEN 1 THEN l_extendedprice ELSE l_tax END AS value
FROM lineitem CROSS JOIN (VALUES ('l_quantity', 0), ('l_extendedprice', 1), ('l_tax', 2)) u(channel, k)
""")
def stack_columns(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_tax"]
    wide = fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cell"), F.col("l_shipdate").alias("time"), *names)
    return rs.stack_columns(wide, ["cell", "time"], names, "targets")


@query("H2_append_channels", f"""
WITH {fx.CHANNELS_SQL}
SELECT channel, CAST(CASE channel WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS INTEGER) AS channel_idx,
       cell, time, {srnd("CASE channel WHEN 'error' THEN value * 2 ELSE value END")} AS value
FROM channels WHERE channel IN ('view', 'click', 'error') AND time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
""")
def append(spark, d):
    first = fx.channels(spark, d)
    second = first.withColumn("value", F.col("value") * 2)
    return rs.append_channels([(first, ["view", "click"]), (second, ["error"])], ("2024-01-05", "2024-01-25")).select(
        "channel", "channel_idx", "cell", "time", rnd("value").alias("value"))


@query("H3_pivot_channels", f"""
WITH {fx.CHANNELS_SQL}
SELECT cell, time, {', '.join(srnd(f"max(CASE WHEN channel = '{c}' THEN value END)") + f' AS "{c}"' for c in fx.CHANNELS)}
FROM channels GROUP BY cell, time
""")
def pivot(spark, d):
    wide = rs.pivot_channels(fx.channels(spark, d), ["cell", "time"], fx.CHANNELS)
    return wide.select("cell", "time", *[rnd(c).alias(c) for c in fx.CHANNELS])


@query("H4_variable_union", """
WITH i AS (SELECT DISTINCT p_brand || '/' || p_size AS variable, 'in/' || p_brand || '/' || p_size AS path FROM part WHERE p_size <= 30),
o AS (SELECT DISTINCT p_brand || '/' || p_size AS variable, 'out/' || p_brand || '/' || p_size AS path FROM part WHERE p_size >= 20)
SELECT coalesce(o.variable, i.variable) AS variable, coalesce(o.path, i.path) AS path FROM i FULL JOIN o ON i.variable = o.variable
""")
def variables(spark, d):
    name = F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))
    p = fx.table(spark, d, "part").withColumn("variable", name)
    inputs = p.filter("p_size <= 30").select("variable", F.concat(F.lit("in/"), "variable").alias("path"))
    outputs = p.filter("p_size >= 20").select("variable", F.concat(F.lit("out/"), "variable").alias("path"))
    return rs.variable_union(inputs, outputs)


@query("H5_order_by_coords", f"""
WITH {fx.CHANNELS_SQL} SELECT time, channel, cell, {srnd('value')} AS value FROM channels ORDER BY time, channel, cell
""")
def ordered(spark, d):
    return rs.order_by_coords(fx.channels(spark, d), ["time", "channel", "cell"]).select(
        "time", "channel", "cell", rnd("value").alias("value"))


HPX_STORE_SQL = fx.QUARTERS_SQL + """,
store_found AS (
  SELECT l_returnflag AS channel, CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS time,
         (l_orderkey * 13 + l_partkey) % 192 AS pix, sqrt(avg(l_quantity)) AS value
  FROM lineitem GROUP BY 1, 2, 3),
store AS (
  SELECT c.channel, q.time, p.pix, coalesce(f.value, 0.0) AS value
  FROM (SELECT DISTINCT l_returnflag AS channel FROM lineitem) c CROSS JOIN quarters q CROSS JOIN (SELECT unnest(range(192)) AS pix) p
  LEFT JOIN store_found f ON f.channel = c.channel AND f.time = q.time AND f.pix = p.pix)
"""


def hpx_store(spark, d):
    found = fx.table(spark, d, "lineitem").groupBy(
        F.col("l_returnflag").alias("channel"), fx.quarter("l_shipdate").alias("time"),
        ((F.col("l_orderkey") * 13 + F.col("l_partkey")) % 192).alias("pix"),
    ).agg(F.sqrt(F.avg("l_quantity")).alias("value"))
    cells = found.select("channel").distinct().withColumn("pix", F.explode(F.sequence(F.lit(0), F.lit(191)).cast("array<bigint>")))
    return densify(found, cells, ["channel", "pix"], fx.quarters()).withColumn("value", F.coalesce("value", F.lit(0.0)))


@query("H6_frame_at", f"""
WITH {HPX_STORE_SQL}, {CELLS4_SQL}, {ring_weights_sql(13, 24, 15.0)}
SELECT s.time, s.channel, w.lat_idx, w.lon_idx, {srnd('sum(w.w * s.value)')} AS value
FROM store s JOIN w ON w.pix = s.pix WHERE s.time IN (TIMESTAMP '1997-01-01', TIMESTAMP '2000-07-01')
GROUP BY 1, 2, 3, 4
""")
def frames(spark, d):
    return rs.frame_at(hpx_store(spark, d), ["1997-01-01", "2000-07-01"], fx.NSIDE, 13, 24).select(
        "time", "channel", "lat_idx", "lon_idx", rnd("value").alias("value"))


@query("H7_before_after", f"""
WITH {fx.OBS_SQL}, {interp_sql('cell', 'obs')}
SELECT o.cell, o.time, {srnd('o.value')} AS before, {srnd('coalesce(f.value, -1.0)')} AS after, o.value IS NULL AS changed
FROM obs o JOIN filled f ON f.cell = o.cell AND f.time = o.time
WHERE o.time IN (TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-30')
""")
def before_after(spark, d):
    raw = fx.obs(spark, d)
    out = rs.before_after(raw, tm.impute(raw, -1.0), ["2024-01-02", "2024-01-12", "2024-01-30"], ["cell"])
    return out.select("cell", "time", rnd("before").alias("before"), rnd("after").alias("after"), "changed")
