"""F: joins on coordinate labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.cluster import co_partitioned, stage_bucketed
from gridlake.operators import axis
from gridlake.operators import spine as sp
from gridlake.operators.align import align_inner, merge_outer, with_dimension
from gridlake.sources import granules as gr
from workload import fixtures as fx
from workload.registry import query, rnd, srnd
from workload.sources import DAYS_SQL
from workload.spatial import CELLS4_SQL, MASK_SQL
from workload.temporal import SPINE_SQL, odd_spine


@query("F1_align_inner", f"""
WITH {fx.HUMID_SQL}
SELECT cell, time, {srnd('sp.value')} AS sp, {srnd('td.value')} AS td FROM sp JOIN td USING (cell, time)
""")
def inner(spark, d):
    return align_inner(fx.sp_field(spark, d).withColumnRenamed("value", "sp"),
                       fx.td_field(spark, d).withColumnRenamed("value", "td"), ["cell", "time"]) \
        .select("cell", "time", rnd("sp").alias("sp"), rnd("td").alias("td"))


# Both fields lie in buckets by cell, so the join by cell and time shuffles neither.
@query("F1_bucketed_stages", f"""
WITH {fx.HUMID_SQL}
SELECT cell, time, {srnd('sp.value')} AS sp, {srnd('td.value')} AS td FROM sp JOIN td USING (cell, time)
""")
def inner_of_stages(spark, d):
    own = co_partitioned(spark)
    sp_, td = (stage_bucketed(f(own, d).withColumnRenamed("value", n), n, ["cell"], 8, ["time"])
               for n, f in (("sp", fx.sp_field), ("td", fx.td_field)))
    return align_inner(sp_, td, ["cell", "time"]).select("cell", "time", rnd("sp").alias("sp"), rnd("td").alias("td"))


@query("F2_merge_outer", f"""
WITH {fx.HUMID_SQL}
SELECT cell, time, {srnd('sp.value')} AS sp, {srnd('td.value')} AS td FROM sp FULL JOIN td USING (cell, time)
""")
def outer(spark, d):
    return merge_outer(fx.sp_field(spark, d).withColumnRenamed("value", "sp"),
                       fx.td_field(spark, d).withColumnRenamed("value", "td"), ["cell", "time"]) \
        .select("cell", "time", rnd("sp").alias("sp"), rnd("td").alias("td"))


@query("F3_broadcast_dimension", f"""
WITH {fx.HFIELD_SQL}, {CELLS4_SQL}
SELECT h.time, h.pix, {srnd('h.value')} AS value, c.face, {srnd('c.lat')} AS lat FROM hfield h JOIN cells c ON c.pix = h.pix
""")
def dimension(spark, d):
    cells = sp.hpx_cells(spark, fx.NSIDE).select("pix", "face", "lat")
    return with_dimension(fx.hfield(spark, d), cells, ["pix"], rows=192).select(
        "time", "pix", rnd("value").alias("value"), "face", rnd("lat").alias("lat"))


@query("F4_semi_join", f"""
WITH {fx.CLIM_SQL}, {fx.DATED_SQL} SELECT cell, time, {srnd('value')} AS value FROM clim WHERE time IN (SELECT time FROM dated)
""")
def semi(spark, d):
    dated = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    return gr.granules_in_range(fx.clim(spark, d), dated).select("cell", "time", rnd("value").alias("value"))


@query("F5_missing_dates", f"""
WITH {DAYS_SQL}, {fx.DATED_SQL} SELECT d.time FROM days d LEFT JOIN dated g ON g.time = d.time WHERE g.time IS NULL
""")
def anti(spark, d):
    found = gr.time_from_filename(gr.list_granules(fx.granules(spark, d)))
    return gr.missing_dates(sp.time_spine(spark, fx.CLIM_START, fx.CLIM_END, "D"), found)


@query("F6_as_of_map", f"""
WITH {fx.CLIM_SQL}, {SPINE_SQL}
SELECT s.time, coalesce(st.time, ends.lo) AS src, st.time IS NOT NULL AS inside
FROM spine s ASOF LEFT JOIN st ON s.time >= st.time JOIN ends ON true
""")
def as_of(spark, d):
    return axis.axis_map(fx.clim(spark, d), odd_spine(spark), "time", "ffill")


@query("F7_spatial_join", f"""
WITH {fx.HFIELD_SQL}, {CELLS4_SQL}, mcells AS (SELECT * FROM cells), {MASK_SQL}
SELECT h.time, h.pix, {srnd('h.value')} AS value, mask.mask FROM hfield h JOIN mask ON mask.pix = h.pix
""")
def spatial(spark, d):
    from gridlake.operators.mask import polygon_mask
    mask = polygon_mask(sp.hpx_cells(spark, fx.NSIDE), fx.polygon_edges(spark))
    return with_dimension(fx.hfield(spark, d), mask, ["pix"], rows=192).select("time", "pix", rnd("value").alias("value"), "mask")


@query("F8_densify", f"WITH {fx.GRID_SQL} SELECT time, lat_idx, lon_idx, {srnd('value')} AS value FROM grid")
def densify(spark, d):
    return fx.grid(spark, d).select("time", "lat_idx", "lon_idx", rnd("value").alias("value"))
