"""G: aggregates and accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import spine as sp
from gridlake.operators import stats as st
from gridlake.sources import fields as src
from gridlake.sources import granules as gr
from workload import fixtures as fx
from workload.registry import query, rnd, srnd
from workload.sources import DAYS_SQL

DOY_SQL = fx.CLIM_SQL + ", doy AS (SELECT cell, CAST(dayofyear(time) AS INTEGER) AS doy, avg(value) AS value FROM clim GROUP BY 1, 2)"


@query("G1_doy_climatology", f"WITH {DOY_SQL} SELECT cell, doy, {srnd('value', 5)} AS value FROM doy")
def doy(spark, d):
    return st.doy_climatology(fx.clim(spark, d)).select("cell", "doy", rnd("value", 5).alias("value"))


@query("G2_clim_min", f"WITH {DOY_SQL} SELECT cell, {srnd('min(value)', 5)} AS price_min FROM doy GROUP BY 1")
def low(spark, d):
    return st.clim_min(fx.clim(spark, d), "price").select("cell", rnd("price_min", 5).alias("price_min"))


@query("G3_clim_max", f"WITH {DOY_SQL} SELECT cell, {srnd('max(value)', 5)} AS price_max FROM doy GROUP BY 1")
def high(spark, d):
    return st.clim_max(fx.clim(spark, d), "price").select("cell", rnd("price_max", 5).alias("price_max"))


@query("G4_clim_annual_range", f"""
WITH {DOY_SQL}
SELECT cell, {srnd('min(value)', 5)} AS price_min, {srnd('max(value)', 5)} AS price_max,
       {srnd('max(value) - min(value)', 5)} AS price_annual_range FROM doy GROUP BY 1
""")
def annual_range(spark, d):
    out = st.clim_metas(fx.clim(spark, d), "price")
    return out.select("cell", *[rnd(c, 5).alias(c) for c in out.columns[1:]])


def yearly_state(spark, d):
    """The climatology's state, built year by year and stored, as a build that grows does it."""
    clim = src.staged(fx.clim(spark, d), "clim")
    years = sorted(r[0] for r in clim.select(F.year("time")).distinct().collect())
    states = [src.staged(st.climatology_state(clim.filter(F.year("time") == y)), "state") for y in years]
    return st.merge_states(states)


@query("G1_merged_states", f"WITH {DOY_SQL} SELECT cell, doy, {srnd('value', 5)} AS value FROM doy")
def merged_doy(spark, d):
    return st.climatology_of_state(yearly_state(spark, d)).select("cell", "doy", rnd("value", 5).alias("value"))


@query("G4_merged_states", f"""
WITH {DOY_SQL}
SELECT cell, {srnd('min(value)', 5)} AS price_min, {srnd('max(value)', 5)} AS price_max,
       {srnd('max(value) - min(value)', 5)} AS price_annual_range FROM doy GROUP BY 1
""")
def merged_range(spark, d):
    out = st.metas_of_state(yearly_state(spark, d), "price")
    return out.select("cell", *[rnd(c, 5).alias(c) for c in out.columns[1:]])


@query("G5_missing_count", f"WITH {fx.OBS_SQL} SELECT count(*) - count(value) AS n_missing FROM obs")
def missing(spark, d):
    return st.missing_count(fx.obs(spark, d))


@query("G6_global_mean_series", f"WITH {fx.OBS_SQL} SELECT time, {srnd('avg(value)')} AS value FROM obs GROUP BY time")
def series(spark, d):
    return st.global_mean_series(fx.obs(spark, d)).select("time", rnd("value").alias("value"))


@query("G6_field_check", f"""
WITH {fx.OBS_SQL}
SELECT time, {srnd('avg(value)')} AS value, count(*) - count(value) AS n_missing FROM obs GROUP BY ROLLUP (time)
""")
def field_check(spark, d):
    return st.field_check(fx.obs(spark, d)).select("time", rnd("value").alias("value"), "n_missing")


@query("G7_completeness", f"""
WITH {DAYS_SQL}, {fx.DATED_SQL}
SELECT (SELECT count(*) FROM dated) AS n_found, (SELECT count(*) FROM days) AS n_expected,
       (SELECT count(*) FROM days) - (SELECT count(*) FROM dated) AS n_difference,
       (SELECT count(*) FROM days WHERE time NOT IN (SELECT time FROM dated)) AS n_missing_days
""")
def completeness(spark, d):
    found = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    return gr.completeness(sp.time_spine(spark, fx.CLIM_START, fx.CLIM_END, "D"), found)


CHUNKS_SQL = f"""
{DAYS_SQL}, {fx.DATED_SQL},
c AS (SELECT CAST(date_diff('day', TIMESTAMP '{fx.CLIM_START}', time) // 30 AS BIGINT) AS chunk, time FROM days),
acc AS (
  SELECT c.chunk, CAST(min(c.time) AS DATE) AS chunk_start, CAST(max(c.time) AS DATE) AS chunk_end,
         CAST(sum(coalesce(g.n, 0)) AS BIGINT) AS n_granules, count(*) AS n_expected
  FROM c LEFT JOIN (SELECT time, count(*) AS n FROM dated GROUP BY time) g ON g.time = c.time GROUP BY c.chunk)
"""


def accounting(spark, d):
    found = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    return gr.chunk_accounting(found, sp.day_chunks(spark, fx.CLIM_START, fx.CLIM_END, 30))


@query("G8_chunk_accounting", f"WITH {CHUNKS_SQL} SELECT * FROM acc")
def chunks(spark, d):
    return accounting(spark, d)


@query("G8_accounting_total", f"""
WITH {CHUNKS_SQL} SELECT CAST(sum(n_granules) AS BIGINT) AS n_granules, CAST(sum(n_expected) AS BIGINT) AS n_expected FROM acc
""")
def chunk_total(spark, d):
    return gr.accounting_total(accounting(spark, d))
