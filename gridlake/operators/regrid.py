"""Moving fields between grids.

Every remap is a static *weights* table (source cell, target cell, ``w``, ``n``) applied by
``apply_weights``: one equality join and one grouped sum. ``n`` is the number of source cells a
target needs. The weights depend on the grids only and are made once, whatever the field's length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import broadcast_within, stage_table
from gridlake.functions import geo, healpix
from gridlake.operators.axis import axis_map
from gridlake.operators.spine import grid_spine, hpx_cells

LL = ("lat_idx", "lon_idx")


def apply_weights(df: DataFrame, weights: DataFrame, source: Sequence[str], target: Sequence[str],
                  group: Sequence[str] = ("time",), value: str = "value", rows: int | None = None) -> DataFrame:
    """Weighted sum of source cells per target cell; missing when any source cell it needs is missing.

    ``group`` names the coordinates that are carried along (time, or time and step). ``rows`` bounds
    the size of the weights table.
    """
    part = F.col("w") * F.col(value)
    return (
        df.select(*group, *source, value)
        .join(broadcast_within(weights, rows), list(source))
        .groupBy(*group, *target)
        .agg(F.sum(part).alias("_s"), F.count(part).alias("_c"), F.max("n").alias("_n"))
        .select(*group, *target, F.when(F.col("_c") == F.col("_n"), F.col("_s")).alias(value))
    )


# --- latitude/longitude grid to HEALPix ---------------------------------------------------------

def _pixel_neighbours(at: Column, size: int, periodic: bool) -> tuple[Column, Column, Column, Column]:
    """(lower index, upper index, fraction towards the upper one, whether the point is on the grid)."""
    if periodic:
        low = F.floor(at)
        return F.pmod(low, F.lit(size)), F.pmod(low + 1, F.lit(size)), at - low, F.lit(True)
    held = F.least(F.greatest(at, F.lit(0.0)), F.lit(float(size - 1)))
    low = F.floor(held)
    return low, F.least(low + 1, F.lit(size - 1).cast("bigint")), held - low, at.between(-0.5, size - 0.5)


def ll_to_hpx_weights(cells: DataFrame, nlat: int, nlon: int, order: str = "bilinear",
                      resolution_factor: float = 1.0, wrap: str = "clamp") -> DataFrame:
    """Weights that sample a north-first lat/lon grid at cell centres (``pix``, ``lat``, ``lon``).

    One resolution, 360/nlon, holds on both axes, and the rows are centred on the equator. With
    ``wrap="clamp"`` a point within half a pixel outside the grid takes the edge value and one
    further out is missing; ``"periodic"`` joins the last longitude to the first.
    """
    if wrap not in ("clamp", "periodic"):
        raise ValueError(f"unknown edge rule: {wrap}")
    res = 360.0 / nlon
    at = cells.select(
        "pix",
        (F.lit(nlon / 2.0) + (F.col("lon") - 180.0) / F.lit(res * resolution_factor)).alias("_c"),
        (F.lit((nlat - 1) / 2.0) - F.col("lat") / F.lit(res)).alias("_r"),
    )
    if order == "nearest-neighbor":
        at = at.withColumns({"_c": F.floor(F.col("_c") + 0.5).cast("double"),
                             "_r": F.floor(F.col("_r") + 0.5).cast("double")})
    elif order != "bilinear":
        raise ValueError(f"unsupported interpolation order: {order}")
    c0, c1, fc, c_in = _pixel_neighbours(F.col("_c"), nlon, wrap == "periodic")
    r0, r1, fr, r_in = _pixel_neighbours(F.col("_r"), nlat, False)
    at = at.select("pix", c0.alias("c0"), c1.alias("c1"), fc.alias("fc"), r0.alias("r0"), r1.alias("r1"),
                   fr.alias("fr"), (c_in & r_in).alias("inside"))

    def corner(row, col, w):
        return F.struct(F.col(row).alias("lat_idx"), F.col(col).alias("lon_idx"),
                        F.when(F.col("inside"), w).alias("w"))

    fc, fr = F.col("fc"), F.col("fr")
    corners = F.array(
        corner("r0", "c0", (1 - fr) * (1 - fc)), corner("r0", "c1", (1 - fr) * fc),
        corner("r1", "c0", fr * (1 - fc)), corner("r1", "c1", fr * fc),
    )
    used = F.when(F.col("inside"), F.filter(corners, lambda s: s["w"] > 0)).otherwise(F.slice(corners, 1, 1))
    return at.select("pix", used.alias("_used")).select(
        "pix", F.size("_used").cast("bigint").alias("n"), F.explode_outer("_used").alias("_s")
    ).select("pix", "_s.lat_idx", "_s.lon_idx", "_s.w", "n")


def remap_ll_to_hpx(df: DataFrame, nside: int, nlat: int, nlon: int, order: str = "bilinear",
                    resolution_factor: float = 1.0, wrap: str = "clamp", group: Sequence[str] = ("time",),
                    value: str = "value", weights: DataFrame | None = None) -> DataFrame:
    """A lat/lon field (``lat_idx``, ``lon_idx``) on HEALPix cells (``pix``).

    Pass ``group=()`` for a field without time. ``weights`` reuses a stored weights table.
    """
    if weights is None:
        weights = ll_to_hpx_weights(hpx_cells(df.sparkSession, nside), nlat, nlon, order, resolution_factor, wrap)
    return apply_weights(df, weights, LL, ["pix"], group, value, rows=4 * healpix.npix(nside))


# --- HEALPix to latitude/longitude grid ---------------------------------------------------------

def _ring_shape(ring: Column, n: int) -> tuple[Column, Column]:
    """Quarter length of a ring and 1 when its first cell is centred on longitude 0, else 0."""
    cap = (ring < n) | (ring > 3 * n)
    nr = F.when(ring < n, ring).when(ring > 3 * n, 4 * n - ring).otherwise(n)
    ks = F.when(cap, 0).otherwise((ring - n).bitwiseAND(F.lit(1).cast("bigint")))
    return nr.cast("bigint"), ks.cast("bigint")


def _ring_z(ring: Column, n: int) -> Column:
    nr = F.when(ring < n, ring).otherwise(4 * n - ring).cast("double")
    cap = nr * nr / F.lit(3.0 * n * n)
    return (F.when(ring < n, 1.0 - cap).when(ring > 3 * n, cap - 1.0)
            .otherwise((F.lit(2 * n) - ring).cast("double") * 2.0 / F.lit(3.0 * n)))


def hpx_to_ll_weights(targets: DataFrame, cells: DataFrame, nside: int, key: Sequence[str] = LL) -> DataFrame:
    """Bilinear weights on the sphere for points (``key``, ``lat``, ``lon``).

    A point lies between two rings; on each ring it takes two adjacent cells, linear in longitude,
    and the two rings are combined linearly in colatitude. Poleward of the outermost ring, the mean
    of that ring's four cells stands for the pole.
    """
    n = nside
    d = targets.select(*key, F.pmod(F.col("lon"), F.lit(360.0)).alias("_lon"),
                       geo.sin_of_latitude(F.col("lat")).alias("_z"))
    z = F.col("_z")
    s = F.floor(F.lit(float(n)) * F.sqrt(3.0 * F.greatest(1.0 - F.abs(z), F.lit(0.0))))
    d = d.withColumns({
        "_theta": F.acos(z),
        "_up": F.when(z > F.lit(2.0 / 3.0), s).when(z < F.lit(-2.0 / 3.0), 4 * n - s - 1)
        .otherwise(F.floor(F.lit(float(n)) * (2.0 - 1.5 * z))).cast("bigint"),
    })
    last = 4 * n - 1
    d = d.withColumns({
        "_a": F.greatest(F.col("_up"), F.lit(1).cast("bigint")),
        "_b": F.least(F.col("_up") + 1, F.lit(last).cast("bigint")),
    })
    d = d.withColumns({"_ta": F.acos(_ring_z(F.col("_a"), n)), "_tb": F.acos(_ring_z(F.col("_b"), n))})
    theta, ta, tb = F.col("_theta"), F.col("_ta"), F.col("_tb")
    north, south = F.col("_up") == 0, F.col("_up") == last
    d = d.withColumns({
        # Shares of the ring above, the ring below, and the pole.
        "_wa": F.when(north, 0.0).when(south, (F.lit(_PI) - theta) / (F.lit(_PI) - ta))
        .otherwise((tb - theta) / (tb - ta)),
        "_wb": F.when(south, 0.0).when(north, theta / tb).otherwise((theta - ta) / (tb - ta)),
    })
    for side in ("a", "b"):
        nr, ks = _ring_shape(F.col(f"_{side}"), n)
        d = d.withColumns({f"_n{side}": nr * 4, f"_p{side}": F.col("_lon") * nr / 90.0 - (1 - ks) / F.lit(2.0)})

    def on_ring(side):
        place = F.col(f"_p{side}")
        low = F.floor(place)
        share = place - low
        return [_ring_cell(F.col(f"_{side}"), F.pmod(low, F.col(f"_n{side}")) + 1, F.col(f"_w{side}") * (1 - share)),
                _ring_cell(F.col(f"_{side}"), F.pmod(low + 1, F.col(f"_n{side}")) + 1, F.col(f"_w{side}") * share)]

    quarter = (1.0 - F.col("_wa") - F.col("_wb")) / 4.0
    pole_ring = F.when(north, F.lit(1)).otherwise(F.lit(last)).cast("bigint")
    pole = [_ring_cell(pole_ring, F.lit(k).cast("bigint"), F.when(north | south, quarter).otherwise(0.0))
            for k in (1, 2, 3, 4)]
    used = F.filter(F.array(*on_ring("a"), *on_ring("b"), *pole), lambda c: c["w"] > 0)
    spread = d.select(*key, used.alias("_used")).select(
        *key, F.size("_used").cast("bigint").alias("n"), F.explode_outer("_used").alias("_s")
    ).select(*key, "n", "_s.ring", "_s.ring_pos", "_s.w")
    places = cells.select("pix", "ring", "ring_pos")
    return spread.join(broadcast_within(places, healpix.npix(n)), ["ring", "ring_pos"]).select(*key, "pix", "w", "n")


_PI = 3.141592653589793


def _ring_cell(ring: Column, pos: Column, w: Column) -> Column:
    return F.struct(ring.alias("ring"), pos.alias("ring_pos"), w.cast("double").alias("w"))


def remap_hpx_to_ll(df: DataFrame, nside: int, nlat: int, nlon: int, resolution: float | None = None,
                    group: Sequence[str] = ("time",), value: str = "value",
                    weights: DataFrame | None = None) -> DataFrame:
    """A HEALPix field on a north-first lat/lon grid (row 0 at 90 N, column 0 at longitude 0)."""
    spark = df.sparkSession
    if weights is None:
        weights = hpx_to_ll_weights(grid_spine(spark, nlat, nlon, resolution), hpx_cells(spark, nside), nside)
    return apply_weights(df, weights, ["pix"], LL, group, value, rows=8 * nlat * nlon)


def inverse_remap(df: DataFrame, nside: int, nlat: int, nlon: int, **kwargs) -> DataFrame:
    """Forecast cubes (time, step, cell) to the lat/lon grid."""
    return remap_hpx_to_ll(df, nside, nlat, nlon, group=("time", "step"), **kwargs)


# --- other grids --------------------------------------------------------------------------------

def regrid_nearest(df: DataFrame, target_lats: DataFrame, target_lons: DataFrame, value: str = "value",
                   source_lats: DataFrame | None = None, source_lons: DataFrame | None = None,
                   rows: tuple[int, int] | None = None) -> DataFrame:
    """Each target (lat, lon) takes the nearest source latitude and longitude, axis by axis.

    Targets outside the source axes are missing. The axes are searched, not the field: its rows meet
    the two maps by equality, and those no target needs go before anything is shuffled. ``rows`` bounds
    the numbers of distinct target latitudes and longitudes, where parameters give them.
    """
    lat = axis_map(df.select("lat") if source_lats is None else source_lats, target_lats, "lat", "nearest")
    lon = axis_map(df.select("lon") if source_lons is None else source_lons, target_lons, "lon", "nearest")
    # A map has at most one row per target label, so the target axes bound its size.
    n_lat, n_lon = rows or (None, None)
    lat = broadcast_within(
        lat.select(F.col("lat").alias("_lat"), F.col("src").alias("_slat"), F.col("inside").alias("_ilat")), n_lat)
    lon = broadcast_within(
        lon.select(F.col("lon").alias("_lon"), F.col("src").alias("_slon"), F.col("inside").alias("_ilon")), n_lon)
    taken = df.join(lat, F.col("lat") == F.col("_slat")).join(lon, F.col("lon") == F.col("_slon"))
    new = {"lat": F.col("_lat"), "lon": F.col("_lon"),
           value: F.when(F.col("_ilat") & F.col("_ilon"), F.col(value))}
    return taken.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def mirror_at_360(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Repeat the points at longitude 0 at longitude 360, in one pass over the field."""
    both = F.when(F.col(lon) == 0, F.array(F.col(lon), F.col(lon) + 360)).otherwise(F.array(F.col(lon)))
    return df.withColumn(lon, F.explode(both))


def bin_mean_to_hpx(points: DataFrame, nside: int, value: str = "value") -> DataFrame:
    """Mean of the samples in each cell, as sum / (count + 1e-7); a cell without any gets 0."""
    hit = healpix.with_containing_pix(points, nside)
    sums = hit.groupBy("pix").agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    # Samples without a place go to -1, which no cell has. It also tells the optimizer that the join
    # key is never NULL, so that it does not repeat the whole index computation in a filter below.
    sums = sums.withColumn("pix", F.coalesce("pix", F.lit(-1).cast("bigint")))
    cells = points.sparkSession.range(healpix.npix(nside)).withColumnRenamed("id", "pix")
    return cells.join(sums, "pix", "left").select(
        "pix", F.coalesce(F.col("_s") / (F.col("_n") + 1e-7), F.lit(0.0)).alias(value)
    )


def face_mosaic(df: DataFrame, nside: int) -> DataFrame:
    """Place of each (face, height, width) on the 5 x 5 diamond of faces: ``row``, ``col``.

    Faces run down-left within each group of four; the second and third group start one step lower,
    the third also one step further right.
    """
    face, quarter = F.col("face"), F.col("face") % 4
    row = 3 - quarter + F.when(face >= 4, 1).otherwise(0)
    col = quarter + F.when(face >= 8, 1).otherwise(0)
    return df.withColumns({"row": (row * nside + F.col("height")).cast("int"),
                           "col": (col * nside + F.col("width")).cast("int")})


# --- triangles ----------------------------------------------------------------------------------

# Smallest bins of a triangle, against its extent: so many of them a side at most.
FINEST = 32


def with_corners(triangles: DataFrame, vertices: DataFrame) -> DataFrame:
    """``triangles(tri, v0, v1, v2)`` with ``x0`` ... ``y2``; without those that lack a corner or have no area."""
    corner = triangles.select("tri", F.posexplode(F.array("v0", "v1", "v2")).alias("_k", "v")).join(vertices.select("v", "x", "y"), "v")
    at = lambda k, c: F.max(F.when(F.col("_k") == k, F.col(c)))
    t = corner.groupBy("tri").agg(*[at(k, c).alias(f"{c}{k}") for k in (0, 1, 2) for c in "vxy"])
    dx0, dx1 = F.col("x0") - F.col("x2"), F.col("x1") - F.col("x2")
    dy0, dy1 = F.col("y0") - F.col("y2"), F.col("y1") - F.col("y2")
    return t.withColumns({"dx0": dx0, "dx1": dx1, "dy0": dy0, "dy1": dy1, "det": dx0 * dy1 - dx1 * dy0}).filter("det <> 0")


def triangle_bins(t: DataFrame) -> DataFrame:
    """Triangles in the square bins that they touch: ``_level``, ``_bx``, ``_by``.

    A level's bins have sides of 2 ** level. Each triangle goes to the level of its own size: of the root of twice
    its area, so that few triangles of a triangulation share a bin even if they are long and thin, but
    not below FINEST bins along its extent. So a triangle has a handful of rows, at most some times FINEST,
    whatever the others' sizes are, and a target meets the triangles of one bin for each level there is.
    """
    low = {c: F.least(*[F.col(f"{c}{k}") for k in (0, 1, 2)]) for c in "xy"}
    high = {c: F.greatest(*[F.col(f"{c}{k}") for k in (0, 1, 2)]) for c in "xy"}
    extent = F.greatest(high["x"] - low["x"], high["y"] - low["y"])
    level = F.ceil(F.log2(F.greatest(F.sqrt(F.abs(F.col("det"))), extent / FINEST)))
    # Rounding can leave a point on an edge a hair outside both triangles that share it.
    hair = F.col("_size") * 1e-9
    t = t.withColumn("_level", level.cast("int")).withColumn("_size", F.pow(F.lit(2.0), F.col("_level")))
    t = t.withColumn("_by", F.explode(F.sequence(
        F.floor((low["y"] - hair) / F.col("_size")), F.floor((high["y"] + hair) / F.col("_size")))))
    bottom, top = F.col("_by") * F.col("_size") - hair, (F.col("_by") + 1) * F.col("_size") + hair

    def reach(a: int, b: int) -> list[Column]:
        """Where an edge enters and leaves the row of bins; missing if it does not."""
        xa, ya, xb, yb = (F.col(f"{c}{k}") for k in (a, b) for c in "xy")
        meets = (F.least(ya, yb) <= top) & (F.greatest(ya, yb) >= bottom)
        at = lambda y: F.when(ya == yb, xa).otherwise(xa + (xb - xa) * ((F.least(F.greatest(y, bottom), top) - ya) / (yb - ya)))
        return [F.when(meets, F.when(ya == yb, x).otherwise(at(y))) for x, y in ((xa, ya), (xb, yb))]

    ends = [e for a, b in ((0, 1), (1, 2), (2, 0)) for e in reach(a, b)]
    first = F.floor((F.greatest(F.least(*ends), low["x"]) - hair) / F.col("_size"))
    last = F.floor((F.least(F.greatest(*ends), high["x"]) + hair) / F.col("_size"))
    return t.withColumn("_bx", F.explode(F.sequence(first, last))).drop("_size")


def target_bins(targets: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Targets in the bin that holds them, for each of the levels."""
    if not levels:
        levels = [0]
    p = targets.select("target", "x", "y", F.explode(F.array(*[F.lit(v) for v in sorted(levels)])).alias("_level"))
    size = F.pow(F.lit(2.0), F.col("_level"))
    return p.withColumns({"_bx": F.floor(F.col("x") / size), "_by": F.floor(F.col("y") / size)})


def barycentric_weights(triangles: DataFrame, vertices: DataFrame, targets: DataFrame, rows: int | None = None) -> DataFrame:
    """Weights of the three corners of the triangle that holds each target.

    ``triangles(tri, v0, v1, v2)``, ``vertices(v, x, y)``, ``targets(target, x, y)``. Triangles and targets meet
    on the bins of ``triangle_bins``; on a shared edge the lowest triangle wins. A target outside all triangles
    has no weights. The triangles' bins are written once, to learn the levels there are (one for each doubling
    of size). ``rows`` bounds the number of triangles, where parameters give it.
    """
    t = stage_table(triangle_bins(with_corners(triangles, vertices)), "triangles")
    levels = [r[0] for r in t.select("_level").distinct().collect()]
    t = broadcast_within(t, None if rows is None else 4 * FINEST * rows)
    rx, ry = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    hit = target_bins(targets, levels).join(t, ["_level", "_bx", "_by"]).withColumns({
        "w0": (F.col("dy1") * rx - F.col("dx1") * ry) / F.col("det"),
        "w1": (F.col("dx0") * ry - F.col("dy0") * rx) / F.col("det"),
    }).withColumn("w2", 1.0 - F.col("w0") - F.col("w1"))
    slack = F.lit(-1e-12)
    hit = hit.filter((F.col("w0") >= slack) & (F.col("w1") >= slack) & (F.col("w2") >= slack))
    parts = ["v0", "v1", "v2", "w0", "w1", "w2"]
    won = hit.groupBy("target").agg(F.min(F.struct("tri", *parts)).alias("_w")).select("target", "_w.*")
    corner = lambda k: F.struct(F.col(f"v{k}").alias("v"), F.col(f"w{k}").alias("w"))
    return won.select("target", F.lit(3).cast("bigint").alias("n"), F.explode(F.array(corner(0), corner(1), corner(2))).alias("_s")) \
        .select("target", "_s.v", "_s.w", "n")


def barycentric_interp(values: DataFrame, triangles: DataFrame, vertices: DataFrame, targets: DataFrame,
                       group: Sequence[str] = ("time",), value: str = "value", rows: int | None = None) -> DataFrame:
    """Field values at the vertices (``v``) interpolated linearly to the targets. ``rows`` as of the weights."""
    return apply_weights(values, barycentric_weights(triangles, vertices, targets, rows), ["v"], ["target"], group, value)
