"""K: whole stages of a training-data build."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.cluster import scratch_path
from gridlake.operators.spine import densify, grid_spine, regular_times, time_spine
from gridlake.plans import incremental, jobs
from gridlake.sources import fields as src
from workload import fixtures as fx
from workload.registry import query, rnd, srnd
from workload.scalars import Q_SQL
from workload.shaping import HPX_STORE_SQL, hpx_store
from workload.spatial import CELLS4_SQL, MASK_SQL, ll_weights_sql
from workload.temporal import interp_sql

COARSE = jobs.IndexGrid(ny=18, nx=36, lat0=90.0, dlat=-10.0, lon0=-180.0, dlon=10.0)


def granule_cells(spark, d, day):
    """Cells of daily granules on a 10 degree index grid: ``(path, y, x, value)``."""
    return fx.table(spark, d, "lineitem").groupBy(
        F.concat(F.lit("raw/MCD19A3CMG.A"), F.date_format(day, "yyyy"),
                 F.lpad(F.dayofyear(day).cast("string"), 3, "0"), F.lit(".061.hdf")).alias("path"),
        (F.col("l_orderkey") % 18).alias("y"), (F.col("l_partkey") % 36).alias("x"),
    ).agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))


@query("K1_process_satellite", f"""
WITH sat AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS time, l_orderkey % 18 AS y, l_partkey % 36 AS x, sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2, 3),
spine AS (SELECT unnest(generate_series(TIMESTAMP '{fx.CLIM_START}', TIMESTAMP '{fx.CLIM_END}', INTERVAL 12 HOUR)) AS time),
st AS (SELECT DISTINCT time FROM sat),
p AS (SELECT s.time AS target, st.time AS prev FROM spine s ASOF LEFT JOIN st ON s.time >= st.time),
n AS (SELECT p.target, p.prev, st.time AS next FROM p ASOF LEFT JOIN st ON p.target <= st.time),
m AS (SELECT target, CASE WHEN prev IS NULL OR next IS NULL THEN NULL WHEN target - prev <= next - target THEN prev ELSE next END AS src,
             coalesce(prev, next) AS near FROM n),
ma AS (SELECT 90.0::DOUBLE - 22.5::DOUBLE * t AS lat, y FROM (SELECT unnest(range(9)) AS t), (SELECT unnest(range(18)) AS y)
       QUALIFY row_number() OVER (PARTITION BY t ORDER BY abs(22.5 * t - 10.0 * y), y DESC) = 1),
mb AS (SELECT 45.0::DOUBLE * t AS lon, x FROM (SELECT unnest(range(8)) AS t), (SELECT unnest(range(36)) AS x)
       QUALIFY row_number() OVER (PARTITION BY t ORDER BY abs(45.0 * t - (180 + 10 * x) % 360), (180 + 10 * x) % 360) = 1)
SELECT m.target AS time, ma.lat, mb.lon,
       CASE WHEN m.src IS NOT NULL AND ma.lat >= -80 THEN {srnd('s.value')} END AS value
FROM m JOIN sat s ON s.time = coalesce(m.src, m.near) JOIN ma ON ma.y = s.y JOIN mb ON mb.x = s.x
""")
def satellite(spark, d):
    cells = src.staged(granule_cells(spark, d, "l_shipdate"), "cells")
    listing = cells.select("path").distinct()
    spine = time_spine(spark, fx.CLIM_START, fx.CLIM_END, "12h")
    lats = spark.range(9).select((90.0 - F.col("id") * 22.5).alias("lat"))
    lons = spark.range(8).select((F.col("id") * 45.0).alias("lon"))
    return jobs.process_satellite(cells, listing, spine, lats, lons, COARSE).select("time", "lat", "lon", rnd("value").alias("value"))


@query("K2_impute_job", f"""
WITH {fx.OBS_SQL}, part AS (SELECT * FROM obs WHERE time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'),
{interp_sql('cell', 'part')}
SELECT cell, time, {srnd('coalesce(value, -1.0)')} AS value FROM filled
""")
def impute(spark, d):
    return jobs.impute_job(fx.obs(spark, d), -1.0, "2024-01-03", "2024-01-28", ["cell"]).select("cell", "time", rnd("value").alias("value"))


@query("K2_impute_ocean_job", f"""
WITH {fx.GRID_SQL}
SELECT time, lat_idx, lon_idx, {srnd('coalesce(value, 1.0)')} AS value FROM grid WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
""")
def impute_ocean(spark, d):
    return jobs.impute_ocean_job(fx.grid(spark, d), 1.0, "1996-01-01", "2000-12-31").select(
        "time", "lat_idx", "lon_idx", rnd("value").alias("value"))


@query("K3_derive_q2m", f"""
WITH {fx.HUMID_SQL}, {Q_SQL} SELECT time, cell, {srnd('w / (1 + w)', 9)} AS value FROM mix
WHERE time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-29'
""")
def q2m(spark, d):
    return jobs.derive_q2m(fx.sp_field(spark, d), fx.td_field(spark, d), "2024-01-02", "2024-01-29", ["time", "cell"]) \
        .select("time", "cell", rnd("value", 9).alias("value"))


LEVELS_SQL = fx.QUARTERS_SQL + """,
lev_found AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS time, l_suppkey AS cell, avg(l_quantity) AS value
  FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2),
lev AS (
  SELECT q.time, c.cell, f.value FROM quarters q CROSS JOIN (SELECT DISTINCT l_suppkey AS cell FROM lineitem) c
  LEFT JOIN lev_found f ON f.time = q.time AND f.cell = c.cell),
acc AS (
  SELECT cell, time, sum(value) OVER (PARTITION BY cell ORDER BY time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS value FROM lev)
"""


def levels(spark, d):
    lineitem = fx.table(spark, d, "lineitem")
    found = lineitem.groupBy(
        F.col("l_linenumber").cast("double").alias("level"), F.col("l_suppkey").alias("cell"), fx.quarter("l_shipdate").alias("time")
    ).agg(F.avg("l_quantity").alias("value"))
    slots = lineitem.select(F.col("l_suppkey").alias("cell")).distinct().withColumn(
        "level", F.explode(F.array(*[F.lit(float(k)) for k in range(1, 8)])))
    return densify(found, slots, ["level", "cell"], fx.quarters())


@query("K4_accumulate_and_select", f"""
WITH {LEVELS_SQL}
SELECT cell, time, {srnd('value')} AS value, 4 AS accumulation_period FROM acc
WHERE time IN (TIMESTAMP '1995-01-01', TIMESTAMP '1998-04-01', TIMESTAMP '2001-10-01')
""")
def accumulate(spark, d):
    out = jobs.accumulate_and_select(levels(spark, d), ["1995-01-01", "1998-04-01", "2001-10-01"], 1.0, 4, keys=["cell"])
    note = out.schema["value"].metadata["accumulation_period"]
    return out.select("cell", "time", rnd("value").alias("value"), F.lit(note).alias("accumulation_period"))


@query("K4_constant_field", f"WITH {LEVELS_SQL} SELECT cell, {srnd('value')} AS value FROM lev WHERE time = TIMESTAMP '1998-04-01'")
def constant(spark, d):
    return jobs.accumulate_and_select(levels(spark, d), ["1998-04-01"], 1.0, keys=["cell"]).select("cell", rnd("value").alias("value"))


@query("K5_mask_job", f"""
WITH {fx.HFIELD_SQL}, {CELLS4_SQL}, mcells AS (SELECT * FROM cells), {MASK_SQL}
SELECT h.time, h.pix, CASE WHEN mask.mask OR c.lat < -60 THEN -1.0 ELSE {srnd('h.value')} END AS value
FROM hfield h JOIN mask ON mask.pix = h.pix JOIN cells c ON c.pix = h.pix
WHERE h.time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2001-01-01'
""")
def mask(spark, d):
    return jobs.mask_job(fx.hfield(spark, d), fx.NSIDE, fx.polygon_edges(spark), -1.0, "1996-01-01", "2001-01-01", True,
                         edge_rows=len(fx.EDGES)) \
        .select("time", "pix", rnd("value").alias("value"))


@query("K6_land_constants", f"""
WITH {fx.CLIM_SQL}, doy AS (
  SELECT cell, dayofyear(time) AS doy, avg(value) AS value FROM clim
  WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' GROUP BY 1, 2)
SELECT cell, {srnd('min(value)', 5)} AS price_min, {srnd('max(value)', 5)} AS price_max,
       {srnd('max(value) - min(value)', 5)} AS price_annual_range FROM doy GROUP BY cell
""")
def constants(spark, d):
    out = jobs.land_constants(fx.clim(spark, d), "price", "1996-01-01", "2000-12-31", keys=["cell"])
    return out.select("cell", *[rnd(c, 5).alias(c) for c in out.columns[1:]])


# --- compile and merge --------------------------------------------------------------------------

STORE_START, STORE_END, STORE_FREQ = "1995-03-01", "2001-12-01", "45D"
FLOAT = "CAST(CAST({} AS FLOAT) AS DOUBLE)"

COMPILED_SQL = f"""
{HPX_STORE_SQL},
axis AS (SELECT unnest(generate_series(TIMESTAMP '{STORE_START}', TIMESTAMP '{STORE_END}', INTERVAL 45 DAY)) AS time),
seen AS (SELECT * FROM store WHERE time BETWEEN TIMESTAMP '{STORE_START}' AND TIMESTAMP '{STORE_END}'),
st AS (SELECT DISTINCT time FROM seen),
m AS (SELECT a.time AS target, st.time AS src FROM axis a ASOF LEFT JOIN st ON a.time >= st.time),
moved AS (
  SELECT s.channel, m.target AS time, s.pix,
         CASE WHEN m.src IS NULL THEN NULL WHEN s.channel = 'N' THEN ln(s.value + 0.5) - ln(0.5) ELSE s.value END AS value
  FROM m JOIN seen s ON s.time = coalesce(m.src, (SELECT min(time) FROM st))),
fixed AS (SELECT pix, max(value) - min(value) AS value FROM (
  SELECT pix, dayofyear(time) AS doy, avg(value) AS value FROM store WHERE channel = 'R' GROUP BY 1, 2) GROUP BY pix),
compiled AS (
  SELECT 'inputs' AS role, channel, CASE channel WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS channel_idx, time, pix, value FROM moved
  UNION ALL SELECT 'targets', channel, CASE channel WHEN 'N' THEN 0 ELSE 1 END, time, pix, value FROM moved WHERE channel IN ('N', 'R')
  UNION ALL SELECT 'constants', 'r_annual_range', 0, NULL, pix, value FROM fixed)
"""


def compiled(spark, d):
    stored = src.staged(hpx_store(spark, d), "hpx")
    one = lambda c: stored.filter(F.col("channel") == c).select("time", "pix", "value")
    # One input in the old convention: other time and value names, and a dimension of its own.
    old = one("R").select(F.col("time").alias("sample"), "pix", F.col("value").alias("predictors"),
                          F.lit(0).alias("varlev"), F.lit(0.0).alias("mean"))
    fixed = jobs.land_constants(one("R"), "r", metas=["annual_range"]).withColumnRenamed("r_annual_range", "value")
    spine = time_spine(spark, STORE_START, STORE_END, STORE_FREQ)
    return jobs.compile_training({"R": old, "N": one("N"), "A": one("A")}, {"N": one("N"), "R": old},
                                 {"r_annual_range": fixed}, spine, STORE_START, STORE_END, {"N": 0.5})


def store_rows(df):
    return df.select("role", "channel", "channel_idx", "time", "pix", rnd(F.col("value").cast("double"), 4).alias("value"))


STORE_COLUMNS_SQL = f"role, channel, CAST(channel_idx AS INTEGER) AS channel_idx, time, pix, {srnd(FLOAT.format('value'), 4)} AS value"


@query("K7_compile_training", f"WITH {COMPILED_SQL} SELECT {STORE_COLUMNS_SQL} FROM compiled")
def compile_store(spark, d):
    return store_rows(compiled(spark, d))


@query("K7_packed_training", f"""
WITH {COMPILED_SQL}, {CELLS4_SQL}
SELECT role, channel, CAST(channel_idx AS INTEGER) AS channel_idx, time, face, CAST(height * 4 + width AS INTEGER) AS position,
       {srnd(FLOAT.format('value'), 4)} AS value
FROM compiled JOIN cells ON cells.pix = compiled.pix
""")
def packed_store(spark, d):
    frame = ["role", "channel", "channel_idx", "time", "face"]
    out = src.unpack_frames(jobs.pack_training(compiled(spark, d), fx.NSIDE), frame)
    return out.select(*frame, "position", rnd(F.col("value").cast("double"), 4).alias("value"))


@query("K8_merge_training", f"""
WITH {COMPILED_SQL},
merged AS (
  SELECT role, channel, 0 AS channel_idx, time, pix, value FROM compiled WHERE role = 'inputs' AND channel = 'A'
  UNION ALL SELECT role, channel, 1, time, pix, value * 2 FROM compiled WHERE role = 'inputs' AND channel = 'N'
  UNION ALL SELECT role, channel, 0, time, pix, value * 2 FROM compiled WHERE role = 'targets' AND channel = 'R'
  UNION ALL SELECT role, channel, 0, time, pix, value FROM compiled WHERE role = 'constants')
SELECT {STORE_COLUMNS_SQL} FROM merged WHERE role = 'constants' OR time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
""")
def merge(spark, d):
    first = src.staged(compiled(spark, d), "store")
    second = first.withColumn("value", F.col("value") * 2)
    return store_rows(jobs.merge_training({
        "inputs": [(first, ["A"]), (second, ["N"])],
        "targets": [(second, ["R"])],
        "constants": [(first, ["r_annual_range"])],
    }, ("1996-01-01", "2000-12-31")))


# Every third label of the store's own axis, all of which must be there.
@query("K8_merge_exact_axis", f"""
WITH {COMPILED_SQL},
chosen AS (SELECT unnest(generate_series(TIMESTAMP '{STORE_START}', TIMESTAMP '{STORE_END}', INTERVAL 135 DAY)) AS time)
SELECT {STORE_COLUMNS_SQL} FROM (
  SELECT role, channel, 0 AS channel_idx, time, pix, value FROM compiled WHERE role = 'inputs' AND channel = 'A'
  UNION ALL SELECT role, channel, 1, time, pix, value FROM compiled WHERE role = 'inputs' AND channel = 'R'
  UNION ALL SELECT role, channel, 0, time, pix, value FROM compiled WHERE role = 'targets' AND channel = 'N'
) m JOIN chosen USING (time)
""")
def merge_exact_axis(spark, d):
    store = src.staged(compiled(spark, d), "store")
    axis = time_spine(spark, STORE_START, STORE_END, "135D")
    return store_rows(jobs.merge_training({"inputs": [(store, ["A"]), (store, ["R"])], "targets": [(store, ["N"])]}, axis, strict=True))


# --- the whole build ----------------------------------------------------------------------------

BUILD = jobs.TrainingSet(
    start=fx.CLIM_START, end=fx.CLIM_END, freq="30D", nside=fx.NSIDE, nlat=fx.NLAT, nlon=fx.NLON, window="120D", grid=COARSE)


def step_of(days: int):
    """Start of the ``days``-day step that a ship date falls in."""
    n = F.floor(F.datediff("l_shipdate", F.lit(fx.CLIM_START).cast("date")) / days) * days
    return F.date_add(F.lit(fx.CLIM_START).cast("date"), n.cast("int")).cast("timestamp_ntz")


def step_sql(days: int) -> str:
    return f"(TIMESTAMP '{fx.CLIM_START}' + to_days(CAST((date_diff('day', TIMESTAMP '{fx.CLIM_START}', l_shipdate) // {days}) * {days} AS INTEGER)))"


def build_inputs(spark, d):
    found = fx.table(spark, d, "lineitem").groupBy(
        step_of(30).alias("time"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % fx.NLAT).alias("lat_idx"),
        ((F.col("l_partkey") * 5 + F.col("l_suppkey")) % fx.NLON).alias("lon_idx"),
    ).agg(F.avg("l_extendedprice").alias("price"), F.avg("l_quantity").alias("quantity"))
    ll = grid_spine(spark, fx.NLAT, fx.NLON)
    times = regular_times(fx.CLIM_START, fx.CLIM_END, "30D")
    return src.staged(densify(found, ll.select("lat_idx", "lon_idx"), ["lat_idx", "lon_idx"], times), "ll"), ll, times


BUILD_SQL = f"""
WITH steps AS (SELECT unnest(generate_series(TIMESTAMP '{fx.CLIM_START}', TIMESTAMP '{fx.CLIM_END}', INTERVAL 30 DAY)) AS time),
found AS (
  SELECT {step_sql(30)} AS time, (l_orderkey * 7 + l_linenumber) % 19 AS lat_idx, (l_partkey * 5 + l_suppkey) % 36 AS lon_idx,
         avg(l_extendedprice) AS price, avg(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2, 3),
slots AS (SELECT s.time, a.lat_idx, o.lon_idx FROM steps s CROSS JOIN (SELECT unnest(range(19)) AS lat_idx) a CROSS JOIN (SELECT unnest(range(36)) AS lon_idx) o),
ll AS (SELECT s.*, f.price, f.quantity FROM slots s LEFT JOIN found f USING (time, lat_idx, lon_idx)),
soil_ll AS (SELECT time, lat_idx, lon_idx, coalesce(sqrt(price) / 100, 1.0) AS value FROM ll),
humid AS (
  SELECT time, lat_idx, lon_idx, 90000.0::DOUBLE + 100 * coalesce(quantity, 25.0) AS p,
         611.2::DOUBLE * exp(17.67::DOUBLE * (250.0::DOUBLE + coalesce(quantity, 25.0) - 273.15::DOUBLE)
                             / (250.0::DOUBLE + coalesce(quantity, 25.0) - 29.65::DOUBLE)) AS e FROM ll),
q_ll AS (SELECT time, lat_idx, lon_idx, (0.622::DOUBLE * e / (p - e)) / (1 + 0.622::DOUBLE * e / (p - e)) AS value FROM humid),
sat AS (
  SELECT {step_sql(10)} AS time, l_orderkey % 18 AS y, l_partkey % 36 AS x, sqrt(avg(l_extendedprice)) AS value FROM lineitem GROUP BY 1, 2, 3),
sat_ll AS (
  SELECT s.time, s.lat_idx, s.lon_idx, sat.value FROM slots s
  LEFT JOIN sat ON sat.time = s.time AND sat.y = s.lat_idx AND sat.x = (s.lon_idx + 18) % 36),
{interp_sql('lat_idx, lon_idx', 'sat_ll')},
ndvi_ll AS (SELECT time, lat_idx, lon_idx, coalesce(value, -1.0) AS value FROM filled),
{CELLS4_SQL}, {ll_weights_sql('clamp')}, mcells AS (SELECT * FROM cells), {MASK_SQL},
hidden AS (SELECT c.pix, coalesce(k.mask, false) OR c.lat < -60 AS mask FROM cells c LEFT JOIN mask k ON k.pix = c.pix),
every AS (SELECT 'ndvi' AS v, * FROM ndvi_ll UNION ALL SELECT 'swvl1', * FROM soil_ll UNION ALL SELECT 'q2m-mean', * FROM q_ll),
hpx AS (
  SELECT e.v, e.time, w.pix, CASE WHEN count(w.w * e.value) = max(w.n) THEN sum(w.w * e.value) END AS value
  FROM every e JOIN w ON w.lat_idx = e.lat_idx AND w.lon_idx = e.lon_idx GROUP BY 1, 2, 3),
done AS (
  SELECT h.v, h.time, h.pix,
         CASE WHEN h.v = 'q2m-mean' THEN CASE WHEN count(h.value) OVER t = 4 THEN avg(h.value) OVER t END
              WHEN k.mask THEN CASE h.v WHEN 'ndvi' THEN -1.0 ELSE 1.0 END ELSE h.value END AS value
  FROM hpx h JOIN hidden k ON k.pix = h.pix
  WINDOW t AS (PARTITION BY h.v, h.pix ORDER BY h.time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
doy AS (SELECT v, pix, dayofyear(time) AS doy, avg(value) AS value FROM done WHERE v <> 'q2m-mean' GROUP BY 1, 2, 3),
span AS (SELECT v, pix, min(value) AS lo, max(value) AS hi FROM doy GROUP BY 1, 2),
compiled AS (
  SELECT 'inputs' AS role, v AS channel, CASE v WHEN 'ndvi' THEN 0 WHEN 'swvl1' THEN 1 ELSE 2 END AS channel_idx, time, pix, value FROM done
  UNION ALL SELECT 'targets', v, CASE v WHEN 'ndvi' THEN 0 ELSE 1 END, time, pix, value FROM done WHERE v <> 'q2m-mean'
  UNION ALL SELECT 'constants', 'ndvi_annual_range', 0, NULL, pix, hi - lo FROM span WHERE v = 'ndvi'
  UNION ALL SELECT 'constants', 'swvl1_min', 1, NULL, pix, lo FROM span WHERE v = 'swvl1'
  UNION ALL SELECT 'constants', 'swvl1_max', 2, NULL, pix, hi FROM span WHERE v = 'swvl1')
"""


@query("K9_prepare_training_set", f"{BUILD_SQL} SELECT {STORE_COLUMNS_SQL} FROM compiled")
def whole_build(spark, d):
    ll, cells_ll, times = build_inputs(spark, d)
    field = lambda c: ll.select("time", "lat_idx", "lon_idx", c.alias("value"))
    quantity = F.coalesce("quantity", F.lit(25.0))
    granules = src.staged(granule_cells(spark, d, step_of(10)), "cells")
    return store_rows(jobs.prepare_training_set(
        BUILD, soil=field(F.sqrt("price") / 100), sp=field(F.lit(90000.0) + 100 * quantity), td=field(F.lit(250.0) + quantity),
        cells=granules, listing=granules.select("path").distinct(), edges=fx.polygon_edges(spark),
        spine=time_spine(spark, fx.CLIM_START, fx.CLIM_END, "30D"), times=times, ll_cells=cells_ll,
        edge_rows=len(fx.EDGES),
    ))


# Granules arrive in two deliveries: without a year in the middle and the last one, and these.
@query("K9_incremental_build", f"{BUILD_SQL} SELECT {STORE_COLUMNS_SQL} FROM compiled WHERE channel IN ('ndvi', 'ndvi_annual_range')")
def incremental_build(spark, d):
    ll = grid_spine(spark, fx.NLAT, fx.NLON)
    cells = src.staged(granule_cells(spark, d, step_of(10)), "cells")
    build = incremental.Build(
        root=scratch_path(spark, "build"), spine=time_spine(spark, fx.CLIM_START, fx.CLIM_END, "30D"), ll_cells=ll,
        edges=fx.polygon_edges(spark), nside=fx.NSIDE, nlat=fx.NLAT, nlon=fx.NLON, fill=-1.0, grid=COARSE)
    year = F.substring(F.substring_index("path", ".A", -1), 1, 4)
    late, middle = year == "2001", year == "1998"
    for some in (~late & ~middle, middle | late):
        part = cells.filter(some)
        incremental.add_granules(build, part, part.select("path").distinct())
    return store_rows(incremental.satellite_store(build))
