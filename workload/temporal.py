"""D: operators along the time axis."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.cluster import scratch_path, stage_table
from gridlake.functions.timeaxis import doy_key
from gridlake.operators import temporal as tm
from gridlake.operators.spine import time_spine
from gridlake.plans import incremental
from gridlake.sources import parts
from workload import fixtures as fx
from workload.registry import query, rnd, srnd


def by_cell(df):
    return df.select("cell", "time", rnd("value").alias("value"))


@query("D1_rolling_sum", f"""
WITH {fx.OBS_SQL}
SELECT cell, time, {srnd('sum(value) OVER (PARTITION BY cell ORDER BY time ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS value
FROM obs
""")
def rolling_sum(spark, d):
    return by_cell(tm.rolling_sum(fx.obs(spark, d), 6, step="D"))


@query("D1_rolling_sum_irregular", f"""
WITH {fx.GRID_SQL}
SELECT time, lat_idx, lon_idx, {srnd('''sum(value) OVER (PARTITION BY lat_idx, lon_idx ORDER BY time
  ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)''', 5)} AS value
FROM grid
""")
def rolling_sum_irregular(spark, d):
    return tm.rolling_sum(fx.grid(spark, d), 4, keys=["lat_idx", "lon_idx"]) \
        .select("time", "lat_idx", "lon_idx", rnd("value", 5).alias("value"))


@query("D2_trailing_mean", f"""
WITH {fx.OBS_SQL}
SELECT cell, time, {srnd('CASE WHEN count(value) OVER w = 4 THEN avg(value) OVER w END')} AS value
FROM obs WINDOW w AS (PARTITION BY cell ORDER BY time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
""")
def trailing_mean(spark, d):
    return by_cell(tm.trailing_mean_over(fx.obs(spark, d), "4D", "D", axis=time_spine(spark, fx.OBS_START, fx.OBS_END, "D")))


# The field arrives without four days in the middle and the last week; these follow, and the means with them.
@query("D2_incremental", f"""
WITH {fx.OBS_SQL}
SELECT cell, time, {srnd('CASE WHEN count(value) OVER w = 4 THEN avg(value) OVER w END')} AS value
FROM obs WINDOW w AS (PARTITION BY cell ORDER BY time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
""")
def trailing_mean_incremental(spark, d):
    obs = stage_table(fx.obs(spark, d), "obs")
    field, mean = scratch_path(spark, "field"), scratch_path(spark, "mean")
    day = F.dayofmonth("time")
    late = (day > 23) | day.between(10, 13)
    first = True
    for some in (~late, late):
        part = obs.filter(some)
        changed = {r[0] for r in part.select(parts.part_of(F.col("time"), "day")).distinct().collect()}
        parts.write_parts(part, field, "day", cell=["cell"], files=1, only=None if first else changed)
        incremental.update_trailing(spark, field, mean, changed, 4, "D", ["cell"], "day", cell=["cell"], files=1)
        first = False
    return by_cell(spark.read.parquet(mean))


# Linear interpolation in SQL; ``key`` are the series columns and ``src`` the field.
def interp_sql(key: str, src: str) -> str:
    return f"""
marks AS (
  SELECT *, last_value(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER a AS t0,
         last_value(value IGNORE NULLS) OVER a AS v0,
         first_value(CASE WHEN value IS NOT NULL THEN time END IGNORE NULLS) OVER b AS t1,
         first_value(value IGNORE NULLS) OVER b AS v1
  FROM {src}
  WINDOW a AS (PARTITION BY {key} ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY {key} ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT {key}, time, coalesce(value, CASE WHEN t1 > t0 THEN v0 + (v1 - v0) * (epoch(time - t0) / epoch(t1 - t0)) END) AS value
  FROM marks)
"""


@query("D3_interpolate_time", f"WITH {fx.OBS_SQL}, {interp_sql('cell', 'obs')} SELECT cell, time, {srnd('value')} AS value FROM filled")
def interpolate_time(spark, d):
    return by_cell(tm.interpolate_time(fx.obs(spark, d)))


@query("D3_interpolate_across_years", f"""
WITH {fx.GRID_SQL}, {interp_sql('lat_idx, lon_idx', 'grid')} SELECT lat_idx, lon_idx, time, {srnd('value', 5)} AS value FROM filled
""")
def interpolate_grid(spark, d):
    return tm.interpolate_time(fx.grid(spark, d), ["lat_idx", "lon_idx"]).select("lat_idx", "lon_idx", "time", rnd("value", 5).alias("value"))


@query("D4_fill_constant", f"WITH {fx.OBS_SQL} SELECT cell, time, {srnd('coalesce(value, 1.0)')} AS value FROM obs")
def fill_constant(spark, d):
    return by_cell(tm.fill_constant(fx.obs(spark, d), 1.0))


SPINE_SQL = """
spine AS (SELECT unnest(generate_series(TIMESTAMP '1994-12-30', TIMESTAMP '2002-01-05', INTERVAL 36 HOUR)) AS time),
st AS (SELECT DISTINCT time FROM clim),
ends AS (SELECT min(time) AS lo, max(time) AS hi FROM st)
"""


def odd_spine(spark):
    return time_spine(spark, "1994-12-30", "2002-01-05", "36h")


@query("D5_reindex_ffill", f"""
WITH {fx.CLIM_SQL}, {SPINE_SQL},
m AS (SELECT s.time AS target, st.time AS src FROM spine s ASOF LEFT JOIN st ON s.time >= st.time)
SELECT c.cell, m.target AS time, CASE WHEN m.src IS NOT NULL THEN {srnd('c.value')} END AS value
FROM m JOIN ends ON true JOIN clim c ON c.time = coalesce(m.src, ends.lo)
""")
def reindex_ffill(spark, d):
    return by_cell(tm.reindex_ffill(fx.clim(spark, d), odd_spine(spark)))


@query("D6_nearest_time", f"""
WITH {fx.CLIM_SQL}, {SPINE_SQL},
p AS (SELECT s.time AS target, st.time AS prev FROM spine s ASOF LEFT JOIN st ON s.time >= st.time),
n AS (SELECT p.target, p.prev, st.time AS next FROM p ASOF LEFT JOIN st ON p.target <= st.time),
m AS (SELECT target, CASE WHEN prev IS NULL OR next IS NULL THEN NULL WHEN target - prev <= next - target THEN prev ELSE next END AS src,
             coalesce(prev, next) AS near FROM n)
SELECT c.cell, m.target AS time, CASE WHEN m.src IS NOT NULL THEN {srnd('c.value')} END AS value
FROM m JOIN clim c ON c.time = coalesce(m.src, m.near)
""")
def nearest_time(spark, d):
    return by_cell(tm.nearest_time(fx.clim(spark, d), odd_spine(spark)))


@query("D7_impute", f"WITH {fx.OBS_SQL}, {interp_sql('cell', 'obs')} SELECT cell, time, {srnd('coalesce(value, -1.0)')} AS value FROM filled")
def impute(spark, d):
    return by_cell(tm.impute(fx.obs(spark, d), -1.0))


@query("D8_sort_time", "SELECT l_shipdate AS time, l_orderkey, l_linenumber, l_extendedprice AS value FROM lineitem ORDER BY 1, 2, 3, 4")
def sort_time(spark, d):
    f = fx.table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("time"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value"))
    return tm.sort_time(f, keys=["l_orderkey", "l_linenumber", "value"])


@query("D9_same_time_axis", """
WITH a AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events),
b AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 3 HOUR)) AS h)
SELECT (SELECT count(*) FROM a WHERE h NOT IN (SELECT h FROM b)) AS n_only_field,
       (SELECT count(*) FROM b WHERE h NOT IN (SELECT h FROM a)) AS n_only_spine,
       false AS same
""")
def same_time_axis(spark, d):
    e = fx.table(spark, d, "events").select(F.col("ts").alias("time"))
    return tm.compare_time_axes(e, time_spine(spark, "2024-01-01", "2024-01-31", "3h"))


@query("D10_doy_key", f"""
WITH {fx.CLIM_SQL} SELECT cell, time, CAST(dayofyear(time) AS INTEGER) AS doy FROM clim
""")
def doy(spark, d):
    return fx.clim(spark, d).select("cell", "time", doy_key(F.col("time")).alias("doy"))


@query("D2_trailing_mean_gappy_axis", f"""
WITH {fx.CLIM_SQL},
axis AS (SELECT time, row_number() OVER (ORDER BY time) AS i FROM (SELECT DISTINCT time FROM clim))
SELECT cell, time, {srnd('CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END')} AS value
FROM clim JOIN axis USING (time)
WINDOW w AS (PARTITION BY cell ORDER BY i RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def trailing_mean_gappy_axis(spark, d):
    # Days without any row are no places of the axis: three places, not three days.
    return by_cell(tm.trailing_mean_over(fx.clim(spark, d).select("cell", "time", "value"), "3D", "D"))


@query("D9_subhour_axis", """
WITH a AS (SELECT DISTINCT ts AS t, date_trunc('hour', ts) AS h FROM events),
l AS (SELECT h, count(*) AS n FROM a GROUP BY h)
SELECT 0::BIGINT AS n_only_field, 0::BIGINT AS n_only_spine, max(n) = 1 AS same FROM l
""")
def subhour_axis(spark, d):
    # The spine has the field's own hours; the axes are the same only if no hour has several times.
    e = fx.table(spark, d, "events").select(F.col("ts").alias("time"))
    hours = e.select(F.date_trunc("hour", "time").cast("timestamp_ntz").alias("time")).distinct()
    return tm.compare_time_axes(e, hours)
