"""E: grids, remaps and masks. HEALPix indices are derived from the keys of lineitem and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions import healpix
from gridlake.cluster import stage_table
from gridlake.operators import frames
from gridlake.operators import mask as mk
from gridlake.operators import regrid as rg
from gridlake.operators.spine import hpx_cells
from workload import fixtures as fx
from workload.registry import query, rnd, srnd

N = 64                      # nside of the per-row index queries
NPIX = 12 * N * N
BITS = N.bit_length() - 1


def even_sql(r: str, bits: int) -> str:
    """Even bits of r, by reading its binary digits in pairs."""
    return "(" + " + ".join(f"((({r}) // {4 ** k}) % 2) * {2 ** k}" for k in range(bits)) + ")"


def odd_sql(r: str, bits: int) -> str:
    return "(" + " + ".join(f"((({r}) // {2 * 4 ** k}) % 2) * {2 ** k}" for k in range(bits)) + ")"


def cells_sql(name: str, source: str, n: int) -> str:
    """Geometry of each ``pix`` of ``source``, as CTEs ending in ``name``."""
    bits = n.bit_length() - 1
    r = f"(pix % {n * n})"
    return f"""
{name}_xy AS (
  SELECT *, pix // {n * n} AS f, {even_sql(r, bits)} AS x, {odd_sql(r, bits)} AS y FROM {source}),
{name}_ring AS (
  SELECT *, (2 + f // 4) * {n} - x - y - 1 AS ring,
         CASE WHEN f // 4 = 1 THEN 2 * (f % 4) ELSE 2 * (f % 4) + 1 END AS jp0 FROM {name}_xy),
{name}_nr AS (
  SELECT *, CASE WHEN ring < {n} THEN ring WHEN ring > {3 * n} THEN {4 * n} - ring ELSE {n} END AS nr,
         CASE WHEN ring < {n} OR ring > {3 * n} THEN 0 ELSE (ring - {n}) % 2 END AS ks FROM {name}_ring),
{name}_pos AS (
  SELECT *, ((jp0 * nr + x - y + 1 + ks) // 2 - 1 + 4 * nr) % (4 * nr) + 1 AS ring_pos,
         CASE WHEN ring < {n} THEN 1.0::DOUBLE - (nr * nr) / (3.0::DOUBLE * {n * n})
              WHEN ring > {3 * n} THEN (nr * nr) / (3.0::DOUBLE * {n * n}) - 1.0::DOUBLE
              ELSE (2.0::DOUBLE * (2 * {n} - ring)) / (3.0::DOUBLE * {n}) END AS z FROM {name}_nr),
{name} AS (
  SELECT pix, CAST(f AS INTEGER) AS face, CAST({n - 1} - x AS INTEGER) AS height, CAST({n - 1} - y AS INTEGER) AS width,
         degrees(asin(z)) AS lat, (ring_pos - (ks + 1) / 2.0::DOUBLE) * 90.0::DOUBLE / nr AS lon, ring, ring_pos
  FROM {name}_pos)
"""


PIX_SQL = f"p AS (SELECT o_orderkey AS id, (o_orderkey * 7919 + o_custkey) % {NPIX} AS pix FROM orders)"
CELLS4_SQL = "pix4 AS (SELECT unnest(range(192)) AS pix), " + cells_sql("cells", "pix4", fx.NSIDE)


def order_pixels(spark, d):
    return fx.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") * 7919 + F.col("o_custkey")) % NPIX).alias("pix"))


@query("E1_regrid_nearest", f"""
WITH {fx.GRID_SQL},
ta AS (SELECT 97.5::DOUBLE - 7.5::DOUBLE * i AS lat FROM (SELECT unnest(range(27)) AS i)),
tb AS (SELECT 12.0::DOUBLE * j - 6.0::DOUBLE AS lon FROM (SELECT unnest(range(31)) AS j)),
sa AS (SELECT 90.0::DOUBLE - 10.0::DOUBLE * i AS s, i AS k FROM (SELECT unnest(range(19)) AS i)),
sb AS (SELECT 10.0::DOUBLE * j AS s, j AS k FROM (SELECT unnest(range(36)) AS j)),
ma AS (SELECT lat, k, lat BETWEEN -90 AND 90 AS ok FROM ta, sa QUALIFY row_number() OVER (PARTITION BY lat ORDER BY abs(lat - s), s) = 1),
mb AS (SELECT lon, k, lon BETWEEN 0 AND 350 AS ok FROM tb, sb QUALIFY row_number() OVER (PARTITION BY lon ORDER BY abs(lon - s), s) = 1)
SELECT g.time, ma.lat, mb.lon, CASE WHEN ma.ok AND mb.ok THEN {srnd('g.value')} END AS value
FROM grid g JOIN ma ON ma.k = g.lat_idx JOIN mb ON mb.k = g.lon_idx
""")
def regrid_nearest(spark, d):
    # Targets lie outside the source on both axes, at either end.
    f = fx.grid(spark, d).select(
        "time", (90.0 - F.col("lat_idx") * 10.0).alias("lat"), (F.col("lon_idx") * 10.0).alias("lon"), "value")
    lats = spark.range(27).select((97.5 - F.col("id") * 7.5).alias("lat"))
    lons = spark.range(31).select((F.col("id") * 12.0 - 6.0).alias("lon"))
    return rg.regrid_nearest(f, lats, lons, rows=(27, 31)).select("time", "lat", "lon", rnd("value").alias("value"))


@query("E2_hpx_cells", f"""
WITH {PIX_SQL}, ids AS (SELECT DISTINCT pix FROM p), {cells_sql('c', 'ids', N)}
SELECT p.id, p.pix, c.face, c.height, c.width, {srnd('c.lat')} AS lat, {srnd('c.lon')} AS lon,
       c.ring, c.ring_pos
FROM p JOIN c ON p.pix = c.pix
""")
def cells(spark, d):
    p = healpix.with_centre(healpix.with_face_height_width(order_pixels(spark, d), N), N)
    return p.select("id", "pix", "face", "height", "width", rnd("lat").alias("lat"), rnd("lon").alias("lon"), "ring", "ring_pos")


@query("E3_pix_to_face_hw", f"""
WITH {PIX_SQL}
SELECT id, pix, CAST(pix // {N * N} AS INTEGER) AS face,
       CAST({N - 1} - {even_sql(f'pix % {N * N}', BITS)} AS INTEGER) AS height,
       CAST({N - 1} - {odd_sql(f'pix % {N * N}', BITS)} AS INTEGER) AS width
FROM p
""")
def pix_to_face_hw(spark, d):
    return healpix.with_face_height_width(order_pixels(spark, d), N)


def spread_sql(v: str, bits: int) -> str:
    return "(" + " + ".join(f"((({v}) // {2 ** k}) % 2) * {4 ** k}" for k in range(bits)) + ")"


@query("E4_face_xy_to_pix", f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_orderkey % 12 AS face, l_partkey % {N} AS height, l_suppkey % {N} AS width FROM lineitem)
SELECT *, face * {N * N} + {spread_sql(f'{N - 1} - height', BITS)} + 2 * {spread_sql(f'{N - 1} - width', BITS)} AS pix FROM t
""")
def face_xy_to_pix(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 12).alias("face"),
        (F.col("l_partkey") % N).alias("height"), (F.col("l_suppkey") % N).alias("width"))
    return healpix.with_pix(t, N)


def ang2pix_sql(name: str, source: str, n: int) -> str:
    bits = n.bit_length() - 1
    return f"""
{name}_z AS (SELECT *, sin(radians(lat)) AS z, (lon % 360.0::DOUBLE) / 90.0::DOUBLE AS tt FROM {source}),
{name}_q AS (SELECT *, abs(z) <= 2.0::DOUBLE / 3.0::DOUBLE AS belt, least(3, CAST(floor(tt) AS BIGINT)) AS q,
                    {n} * sqrt(3.0::DOUBLE * (1.0::DOUBLE - abs(z))) AS s FROM {source}_z),
{name}_ab AS (
  SELECT *, CASE WHEN belt THEN CAST(floor({n} * (0.5::DOUBLE + tt - 0.75::DOUBLE * z)) AS BIGINT)
                 ELSE least({n - 1}, CAST(floor((tt - q) * s) AS BIGINT)) END AS a,
         CASE WHEN belt THEN CAST(floor({n} * (0.5::DOUBLE + tt + 0.75::DOUBLE * z)) AS BIGINT)
              ELSE least({n - 1}, CAST(floor((1.0::DOUBLE - (tt - q)) * s) AS BIGINT)) END AS b FROM {name}_q),
{name}_fxy AS (
  SELECT *, CASE WHEN belt THEN CASE WHEN a // {n} = b // {n} THEN (a // {n}) % 4 + 4
                                     WHEN a // {n} < b // {n} THEN a // {n} ELSE b // {n} + 8 END
                 WHEN z > 0 THEN q ELSE q + 8 END AS f,
         CASE WHEN belt THEN b % {n} WHEN z > 0 THEN {n - 1} - b ELSE a END AS x,
         CASE WHEN belt THEN {n - 1} - a % {n} WHEN z > 0 THEN {n - 1} - a ELSE b END AS y FROM {name}_ab),
{name} AS (SELECT *, f * {n * n} + {spread_sql('x', bits)} + 2 * {spread_sql('y', bits)} AS pix FROM {name}_fxy)
"""


def ang2pix_cte(n: int) -> str:
    return ang2pix_sql("points", "points", n).replace("\npoints AS (", "\nhits AS (")


@query("E5_ang2pix", f"WITH {fx.POINTS_SQL}, {ang2pix_cte(N)} SELECT {srnd('lon')} AS lon, {srnd('lat')} AS lat, value, pix FROM hits")
def ang2pix(spark, d):
    return healpix.with_containing_pix(fx.points(spark, d), N).select(
        rnd("lon").alias("lon"), rnd("lat").alias("lat"), "value", "pix")


def ll_weights_sql(wrap: str, order: str = "bilinear", nlat: int = fx.NLAT, nlon: int = fx.NLON) -> str:
    """Weights of a lat/lon grid at the nside 4 cell centres, written with joins instead of arrays."""
    res = 360.0 / nlon
    col = f"({nlon / 2.0}::DOUBLE + (lon - 180.0::DOUBLE) / {res}::DOUBLE)"
    row = f"({(nlat - 1) / 2.0}::DOUBLE - lat / {res}::DOUBLE)"
    if order == "nearest-neighbor":
        col, row = f"floor({col} + 0.5::DOUBLE)", f"floor({row} + 0.5::DOUBLE)"
    if wrap == "periodic":
        held, on_grid = "c", "true"
    else:
        held, on_grid = f"least(greatest(c, 0.0::DOUBLE), {nlon - 1}.0::DOUBLE)", f"c BETWEEN -0.5 AND {nlon - 0.5}"
    return f"""
spot AS (SELECT pix, {col} AS c, {row} AS r FROM cells),
held AS (SELECT pix, {held} AS c, least(greatest(r, 0.0::DOUBLE), {nlat - 1}.0::DOUBLE) AS r,
                ({on_grid}) AND r BETWEEN -0.5 AND {nlat - 0.5} AS inside FROM spot),
spread AS (
  SELECT pix, inside, least(CAST(floor(r) AS BIGINT) + dr, {nlat - 1}) AS lat_idx,
         {f'(CAST(floor(c) AS BIGINT) + dc + {nlon}) % {nlon}' if wrap == 'periodic'
          else f'least(CAST(floor(c) AS BIGINT) + dc, {nlon - 1})'} AS lon_idx,
         (CASE dr WHEN 0 THEN 1 - (r - floor(r)) ELSE r - floor(r) END)
         * (CASE dc WHEN 0 THEN 1 - (c - floor(c)) ELSE c - floor(c) END) AS w, dr, dc
  FROM held, (SELECT unnest(range(2)) AS dr), (SELECT unnest(range(2)) AS dc)),
w AS (
  SELECT pix, lat_idx, lon_idx, CASE WHEN inside THEN w END AS w, count(*) OVER (PARTITION BY pix) AS n
  FROM spread WHERE (inside AND w > 0) OR (NOT inside AND dr = 0 AND dc = 0))
"""


def remap_sql(field: str, digits: int = 5) -> str:
    return f"""
SELECT g.time, w.pix, CASE WHEN count(w.w * g.value) = max(w.n) THEN {srnd('sum(w.w * g.value)', digits)} END AS value
FROM {field} g JOIN w ON w.lat_idx = g.lat_idx AND w.lon_idx = g.lon_idx GROUP BY 1, 2
"""


def remapped(spark, d, **kwargs):
    out = rg.remap_ll_to_hpx(fx.grid(spark, d), fx.NSIDE, fx.NLAT, fx.NLON, **kwargs)
    return out.select("time", "pix", rnd("value", 5).alias("value"))


@query("E6_remap_ll_to_hpx", f"WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('clamp')} {remap_sql('grid')}")
def remap_bilinear(spark, d):
    return remapped(spark, d)


@query("E6_remap_packed", f"WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('clamp')} {remap_sql('grid')}")
def remap_packed(spark, d):
    packed = stage_table(frames.pack_bands(fx.grid(spark, d), fx.NLAT, fx.NLON, rows=5), "bands")
    out = frames.remap_ll_to_faces(packed, fx.NSIDE, fx.NLAT, fx.NLON, rows=5)
    return frames.unpack_faces(out, fx.NSIDE).select("time", "pix", rnd("value", 5).alias("value"))


@query("E6_remap_periodic", f"WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('periodic')} {remap_sql('grid')}")
def remap_periodic(spark, d):
    return remapped(spark, d, wrap="periodic")


@query("E6_remap_nearest_neighbor", f"WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('clamp', 'nearest-neighbor')} {remap_sql('grid')}")
def remap_nearest(spark, d):
    return remapped(spark, d, order="nearest-neighbor")


@query("E6_remap_constant_field", f"""
WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('clamp')},
still AS (SELECT lat_idx, lon_idx, avg(value) AS value FROM grid GROUP BY 1, 2)
SELECT w.pix, CASE WHEN count(w.w * g.value) = max(w.n) THEN {srnd('sum(w.w * g.value)', 5)} END AS value
FROM still g JOIN w ON w.lat_idx = g.lat_idx AND w.lon_idx = g.lon_idx GROUP BY 1
""")
def remap_constant(spark, d):
    still = fx.grid(spark, d).groupBy("lat_idx", "lon_idx").agg(F.avg("value").alias("value"))
    out = rg.remap_ll_to_hpx(still, fx.NSIDE, fx.NLAT, fx.NLON, group=())
    return out.select("pix", rnd("value", 5).alias("value"))


def ring_weights_sql(nlat: int, nlon: int, res: float, n: int = fx.NSIDE) -> str:
    """Weights from rings of cells to a lat/lon grid. Ring latitudes are read off the cells themselves."""
    return f"""
rings AS (SELECT ring, acos(max(sin(radians(lat)))) AS th, count(*) AS m, min(lon) AS lon0 FROM cells GROUP BY ring),
tg AS (
  SELECT a AS lat_idx, o AS lon_idx, acos(sin(radians(90.0::DOUBLE - a * {res}::DOUBLE))) AS th, o * {res}::DOUBLE AS lon,
         sin(radians(90.0::DOUBLE - a * {res}::DOUBLE)) AS z
  FROM (SELECT unnest(range({nlat})) AS a), (SELECT unnest(range({nlon})) AS o)),
tup AS (
  SELECT *, CAST(CASE WHEN z > 2.0::DOUBLE / 3.0::DOUBLE THEN floor({n} * sqrt(3.0::DOUBLE * (1.0::DOUBLE - z)))
              WHEN z < -2.0::DOUBLE / 3.0::DOUBLE THEN {4 * n - 1} - floor({n} * sqrt(3.0::DOUBLE * (1.0::DOUBLE + z)))
              ELSE floor({n} * (2.0::DOUBLE - 1.5::DOUBLE * z)) END AS BIGINT) AS up FROM tg),
sides AS (
  SELECT t.lat_idx, t.lon_idx, t.lon, r.ring, r.m, r.lon0,
         CASE WHEN t.up = 0 THEN t.th / r.th
              WHEN t.up = {4 * n - 1} THEN (pi() - t.th) / (pi() - r.th)
              WHEN r.ring = t.up THEN (o.th - t.th) / (o.th - r.th)
              ELSE (t.th - o.th) / (r.th - o.th) END AS share
  FROM tup t JOIN rings r ON r.ring IN (t.up, t.up + 1)
  LEFT JOIN rings o ON o.ring IN (t.up, t.up + 1) AND o.ring <> r.ring),
spots AS (SELECT *, (lon - lon0) * m / 360.0::DOUBLE AS ph FROM sides),
on_rings AS (
  SELECT lat_idx, lon_idx, ring, (CAST(floor(ph) AS BIGINT) + k + m) % m + 1 AS ring_pos,
         share * CASE k WHEN 0 THEN 1 - (ph - floor(ph)) ELSE ph - floor(ph) END AS w
  FROM spots, (SELECT unnest(range(2)) AS k)),
at_poles AS (
  SELECT t.lat_idx, t.lon_idx, c.ring, c.ring_pos,
         (1 - (SELECT max(s.share) FROM sides s WHERE s.lat_idx = t.lat_idx AND s.lon_idx = t.lon_idx)) / 4 AS w
  FROM tup t JOIN cells c ON c.ring = CASE WHEN t.up = 0 THEN 1 WHEN t.up = {4 * n - 1} THEN {4 * n - 1} END),
every AS (SELECT * FROM on_rings UNION ALL SELECT * FROM at_poles),
w AS (
  SELECT e.lat_idx, e.lon_idx, c.pix, e.w FROM every e
  JOIN cells c ON c.ring = e.ring AND c.ring_pos = e.ring_pos WHERE e.w > 1e-12)
"""


def to_ll_sql(field: str, group: str, digits: int = 4) -> str:
    cols = ", ".join(f"g.{c}" for c in group.split(", "))
    return f"""
SELECT {cols}, w.lat_idx, w.lon_idx, CASE WHEN count(g.value) = count(*) THEN {srnd('sum(w.w * g.value)', digits)} END AS value
FROM {field} g JOIN w ON w.pix = g.pix GROUP BY {cols}, w.lat_idx, w.lon_idx
"""


@query("E7_remap_hpx_to_ll", f"WITH {fx.HFIELD_SQL}, {CELLS4_SQL}, {ring_weights_sql(13, 24, 15.0)} {to_ll_sql('hfield', 'time')}")
def remap_to_ll(spark, d):
    out = rg.remap_hpx_to_ll(fx.hfield(spark, d), fx.NSIDE, 13, 24)
    return out.select("time", "lat_idx", "lon_idx", rnd("value", 4).alias("value"))


FORECAST_SQL = fx.QUARTERS_SQL + """,
fc_found AS (
  SELECT CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS time, l_linenumber AS step,
         (l_orderkey * 13 + l_partkey) % 192 AS pix, sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2, 3),
fc AS (
  SELECT t.time, s.step, c.pix, f.value
  FROM (SELECT DISTINCT time FROM fc_found) t CROSS JOIN (SELECT DISTINCT step FROM fc_found) s
  CROSS JOIN (SELECT unnest(range(192)) AS pix) c
  LEFT JOIN fc_found f ON f.time = t.time AND f.step = s.step AND f.pix = c.pix)
"""


def forecasts(spark, d):
    found = fx.table(spark, d, "lineitem").groupBy(
        F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("time"), F.col("l_linenumber").alias("step"),
        ((F.col("l_orderkey") * 13 + F.col("l_partkey")) % 192).alias("pix"),
    ).agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))
    slots = found.select("time", "step").distinct().withColumn(
        "pix", F.explode(F.sequence(F.lit(0), F.lit(191)).cast("array<bigint>")))
    return slots.join(found, ["time", "step", "pix"], "left")


@query("E8_inverse_remap", f"WITH {FORECAST_SQL}, {CELLS4_SQL}, {ring_weights_sql(7, 12, 30.0)} {to_ll_sql('fc', 'time, step')}")
def inverse_remap(spark, d):
    return rg.inverse_remap(forecasts(spark, d), fx.NSIDE, 7, 12).select(
        "time", "step", "lat_idx", "lon_idx", rnd("value", 4).alias("value"))


@query("E9_face_mosaic", f"""
WITH {PIX_SQL}, ids AS (SELECT DISTINCT pix FROM p), {cells_sql('c', 'ids', N)},
place(face, r, k) AS (VALUES (0,3,0),(1,2,1),(2,1,2),(3,0,3),(4,4,0),(5,3,1),(6,2,2),(7,1,3),(8,4,1),(9,3,2),(10,2,3),(11,1,4))
SELECT p.id, p.pix, CAST(place.r * {N} + c.height AS INTEGER) AS row, CAST(place.k * {N} + c.width AS INTEGER) AS col
FROM p JOIN c ON c.pix = p.pix JOIN place ON place.face = c.face
""")
def face_mosaic(spark, d):
    p = healpix.with_face_height_width(order_pixels(spark, d), N)
    return rg.face_mosaic(p, N).select("id", "pix", "row", "col")


@query("E10_bin_mean_to_hpx", f"""
WITH {fx.POINTS_SQL}, {ang2pix_cte(16)}
SELECT c.pix, {srnd('coalesce(s.s / (s.n + 1e-7::DOUBLE), 0.0::DOUBLE)')} AS value
FROM (SELECT unnest(range(3072)) AS pix) c
LEFT JOIN (SELECT pix, sum(value) AS s, count(value) AS n FROM hits GROUP BY pix) s ON s.pix = c.pix
""")
def bin_mean(spark, d):
    return rg.bin_mean_to_hpx(fx.points(spark, d), 16).select("pix", rnd("value").alias("value"))


@query("E11_mirror_at_360", f"""
WITH {fx.GRID_SQL}, g AS (SELECT time, lat_idx, lon_idx * 10.0::DOUBLE AS lon, value FROM grid)
SELECT time, lat_idx, lon, {srnd('value')} AS value FROM g
UNION ALL SELECT time, lat_idx, 360.0::DOUBLE, {srnd('value')} FROM g WHERE lon = 0
""")
def mirror(spark, d):
    g = fx.grid(spark, d).select("time", "lat_idx", (F.col("lon_idx") * 10.0).alias("lon"), "value")
    return rg.mirror_at_360(g).select("time", "lat_idx", "lon", rnd("value").alias("value"))


TRI_TARGETS_SQL = fx.POINTS_SQL + """,
targets AS (SELECT DISTINCT CAST(floor(lon / 4) AS BIGINT) * 200 + CAST(floor(lat / 4) AS BIGINT) AS target,
                   floor(lon / 4) * 4 + 0.25::DOUBLE AS x, floor(lat / 4) * 4 + 0.3::DOUBLE AS y FROM points)
"""


def tri_targets(spark, d):
    x, y = F.floor(F.col("lon") / 4), F.floor(F.col("lat") / 4)
    return fx.points(spark, d).select(
        (x * 200 + y).alias("target"), (x * 4 + 0.25).alias("x"), (y * 4 + 0.3).alias("y")).distinct()


VERTEX_FIELD_SQL = """
vf AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS time, l_orderkey % 5 AS v, sqrt(avg(l_extendedprice)) AS value
  FROM lineitem GROUP BY 1, 2)
"""


@query("E12_barycentric_interp", f"""
WITH {TRI_TARGETS_SQL}, {fx.TRIANGLES_SQL}, {VERTEX_FIELD_SQL},
t AS (
  SELECT tri, v0, v1, v2, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1, c.x AS x2, c.y AS y2
  FROM triangles JOIN vertices a ON a.v = v0 JOIN vertices b ON b.v = v1 JOIN vertices c ON c.v = v2),
area AS (SELECT *, (x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0) AS two FROM t),
s AS (
  SELECT target, tri, v0, v1, v2,
         ((x1 - p.x) * (y2 - p.y) - (x2 - p.x) * (y1 - p.y)) / two AS w0,
         ((x2 - p.x) * (y0 - p.y) - (x0 - p.x) * (y2 - p.y)) / two AS w1
  FROM targets p, area),
hit AS (SELECT *, 1 - w0 - w1 AS w2 FROM s WHERE w0 >= -1e-12 AND w1 >= -1e-12 AND 1 - w0 - w1 >= -1e-12
        QUALIFY row_number() OVER (PARTITION BY target ORDER BY tri) = 1)
SELECT a.time, h.target, {srnd('h.w0 * a.value + h.w1 * b.value + h.w2 * c.value', 4)} AS value
FROM hit h JOIN vf a ON a.v = h.v0 JOIN vf b ON b.v = h.v1 AND b.time = a.time JOIN vf c ON c.v = h.v2 AND c.time = a.time
""")
def barycentric(spark, d):
    tri, vert = fx.triangles(spark)
    yearly = fx.table(spark, d, "lineitem").groupBy(
        fx.quarter("l_shipdate").alias("time"), (F.col("l_orderkey") % 5).alias("v")
    ).agg(F.sqrt(F.avg("l_extendedprice")).alias("value"))
    out = rg.barycentric_interp(yearly, tri, vert, tri_targets(spark, d), rows=len(fx.TRIANGLES))
    return out.select("time", "target", rnd("value", 4).alias("value"))


MASK_SQL = f"""
{fx.EDGES_SQL},
pl AS (SELECT DISTINCT pix, lat, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon FROM mcells),
cr AS (
  SELECT pl.pix, e.poly,
         sum(CASE WHEN (e.y1 > lat) <> (e.y2 > lat) AND lon < (e.x2 - e.x1) * (lat - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) AS n,
         max(CASE WHEN (e.x2 - e.x1) * (lat - e.y1) = (e.y2 - e.y1) * (lon - e.x1)
                   AND lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                   AND lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS edge
  FROM pl, edges e GROUP BY 1, 2),
mask AS (SELECT pix, bool_or(n % 2 = 1 AND edge = 0) AS mask FROM cr GROUP BY pix)
"""


@query("E13_polygon_mask", f"""
WITH {PIX_SQL}, ids AS (SELECT DISTINCT pix FROM p), {cells_sql('mcells', 'ids', N)}, {MASK_SQL}
SELECT p.id, p.pix, mask.mask FROM p JOIN mask ON mask.pix = p.pix
""")
def polygon_mask(spark, d):
    p = order_pixels(spark, d)
    centres = healpix.with_centre(p.select("pix").distinct(), N)
    return p.join(mk.polygon_mask(centres, fx.polygon_edges(spark), rows=len(fx.EDGES)), "pix").select("id", "pix", "mask")


@query("E14_polar_cap_mask", f"""
WITH {PIX_SQL}, ids AS (SELECT DISTINCT pix FROM p), {cells_sql('c', 'ids', N)}
SELECT p.id, p.pix, c.lat < -60 AS mask FROM p JOIN c ON c.pix = p.pix
""")
def polar_cap_mask(spark, d):
    p = order_pixels(spark, d)
    centres = healpix.with_centre(p.select("pix").distinct(), N)
    return p.join(mk.polar_cap_mask(centres), "pix").select("id", "pix", "mask")


MASKED_SQL = f"""
{fx.HFIELD_SQL}, {CELLS4_SQL}, mcells AS (SELECT * FROM cells), {MASK_SQL}
"""


@query("E15_apply_mask", f"""
WITH {MASKED_SQL}
SELECT h.time, h.pix, CASE WHEN mask.mask THEN -1.0 ELSE {srnd('h.value')} END AS value FROM hfield h JOIN mask ON mask.pix = h.pix
""")
def apply_mask(spark, d):
    mask = mk.polygon_mask(hpx_cells(spark, fx.NSIDE), fx.polygon_edges(spark), rows=len(fx.EDGES))
    return mk.apply_mask(fx.hfield(spark, d), mask, -1.0, rows=192).select("time", "pix", rnd("value").alias("value"))


@query("E16_apply_weights", f"""
WITH {fx.GRID_SQL}, {CELLS4_SQL}, {ll_weights_sql('clamp')}
SELECT w.pix, CASE WHEN count(w.w * g.value) = max(w.n) THEN {srnd('sum(w.w * g.value)', 5)} END AS value, CAST(extract('year' FROM g.time) AS INTEGER) AS year,
       CAST(extract('month' FROM g.time) AS INTEGER) AS month
FROM grid g JOIN w ON w.lat_idx = g.lat_idx AND w.lon_idx = g.lon_idx GROUP BY 1, 3, 4
""")
def apply_weights(spark, d):
    g = fx.grid(spark, d).withColumns({"year": F.year("time"), "month": F.month("time")})
    weights = rg.ll_to_hpx_weights(hpx_cells(spark, fx.NSIDE), fx.NLAT, fx.NLON)
    return rg.apply_weights(g, weights, rg.LL, ["pix"], ["year", "month"], rows=4 * 192).select(
        "year", "month", "pix", rnd("value", 5).alias("value"))


