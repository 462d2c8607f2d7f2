import math
import random

import pytest
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.operators import regrid as rg
from gridlake.operators.spine import grid_spine, hpx_cells


def grid_field(spark, nlat, nlon, value):
    return grid_spine(spark, nlat, nlon).select(
        F.lit("2024-01-01").cast("timestamp_ntz").alias("time"), "lat_idx", "lon_idx", value.cast("double").alias("value"))


def test_constant_stays_constant_both_ways(spark):
    f = grid_field(spark, 181, 360, F.lit(3.5))
    out = rg.remap_ll_to_hpx(f, 16, 181, 360)
    stats = out.agg(F.count("*").alias("n"), F.count("value").alias("v"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    assert (stats.n, stats.v) == (3072, 3072)
    assert stats.lo == pytest.approx(3.5) and stats.hi == pytest.approx(3.5)
    back = rg.remap_hpx_to_ll(out, 16, 37, 72).agg(F.count("value").alias("v"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    assert back.v == 37 * 72
    assert back.lo == pytest.approx(3.5) and back.hi == pytest.approx(3.5)


def test_bilinear_reproduces_a_linear_field(spark):
    out = rg.remap_ll_to_hpx(grid_field(spark, 181, 360, F.col("lat") * 2 + F.col("lon")), 16, 181, 360)
    both = out.join(hpx_cells(spark, 16), "pix").withColumn("err", F.abs(F.col("value") - F.col("lat") * 2 - F.col("lon")))
    assert both.filter("lon < 359").agg(F.max("err")).first()[0] < 1e-9


def test_edge_rules(spark):
    """A 30 degree grid ends at column 11 (330 E); cells past 345 E are outside unless periodic."""
    f = grid_field(spark, 7, 12, F.lit(1.0))
    clamp = rg.remap_ll_to_hpx(f, 16, 7, 12).join(hpx_cells(spark, 16), "pix")
    assert clamp.count() == 3072
    assert clamp.filter("lon > 345 AND value IS NOT NULL").count() == 0
    assert clamp.filter("lon <= 345 AND value IS NULL").count() == 0
    assert rg.remap_ll_to_hpx(f, 16, 7, 12, wrap="periodic").filter("value IS NULL").count() == 0


def test_missing_contributor_makes_missing(spark):
    f = grid_field(spark, 19, 36, F.lit(1.0)).withColumn("value", F.when((F.col("lat_idx") == 9) & (F.col("lon_idx") == 9), None).otherwise(F.col("value")))
    w = rg.ll_to_hpx_weights(hpx_cells(spark, 8), 19, 36)
    hit = {r.pix for r in w.filter("lat_idx = 9 AND lon_idx = 9").collect()}
    dense = rg.remap_ll_to_hpx(f, 8, 19, 36, weights=w)
    assert {r.pix for r in dense.filter("value IS NULL AND pix IN (%s)" % ",".join(map(str, hit))).collect()} == hit
    # An absent row counts as missing too.
    sparse = rg.remap_ll_to_hpx(f.filter("value IS NOT NULL"), 8, 19, 36, weights=w)
    outside = {r.pix for r in w.filter("w IS NULL").collect()}
    assert {r.pix for r in sparse.filter("value IS NULL").collect()} == hit | outside


def test_hpx_to_ll_weights(spark):
    """Weights add up to one, at most six cells, also at both poles; x, y, z come back closely."""
    cells = hpx_cells(spark, 16)
    w = rg.hpx_to_ll_weights(grid_spine(spark, 37, 72), cells, 16)
    per = w.groupBy("lat_idx", "lon_idx").agg(F.sum("w").alias("s"), F.count("*").alias("c"), F.max("n").alias("n"))
    worst = per.agg(F.count("*").alias("k"), F.max(F.abs(F.col("s") - 1)).alias("e"), F.max("c").alias("c"),
                    F.max(F.abs(F.col("c") - F.col("n"))).alias("d")).first()
    assert worst.k == 37 * 72 and worst.e < 1e-12 and worst.c <= 6 and worst.d == 0
    z = w.join(cells, "pix").groupBy("lat_idx").agg((F.sum(F.col("w") * F.sin(F.radians("lat"))) / 72).alias("z")).collect()
    assert max(abs(r.z - math.sin(math.radians(90 - 5 * r.lat_idx))) for r in z) < 3e-3


def test_orders(spark):
    with pytest.raises(ValueError):
        rg.ll_to_hpx_weights(hpx_cells(spark, 4), 19, 36, order="bicubic")
    near = rg.ll_to_hpx_weights(hpx_cells(spark, 4), 181, 360, order="nearest-neighbor")
    assert near.count() == 192 and near.filter("w <> 1").count() == 0


def test_regrid_nearest_out_of_range(spark):
    f = spark.createDataFrame([(1, la, lo, la * 1000 + lo) for la in (80.0, 70.0, -80.0) for lo in (0.0, 10.0, 350.0)],
                              "time int, lat double, lon double, value double")
    lats = spark.createDataFrame([(90.0,), (75.0,), (74.9,), (-80.0,)], "lat double")
    lons = spark.createDataFrame([(5.0,), (359.0,), (349.0,)], "lon double")
    got = {(r.lat, r.lon): r.value for r in rg.regrid_nearest(f, lats, lons).collect()}
    assert len(got) == 12
    assert got[(90.0, 5.0)] is None and got[(75.0, 359.0)] is None
    assert got[(75.0, 5.0)] == 70.0 * 1000 + 0.0        # ties go to the lower coordinate
    assert got[(74.9, 349.0)] == 70.0 * 1000 + 350.0
    assert got[(-80.0, 5.0)] == -80.0 * 1000


def test_mirror(spark):
    f = spark.createDataFrame([(0.0, 1.0), (10.0, 2.0), (0.0, 3.0)], "lon double, value double")
    assert sorted((r.lon, r.value) for r in rg.mirror_at_360(f).collect()) == [(0.0, 1.0), (0.0, 3.0), (10.0, 2.0), (360.0, 1.0), (360.0, 3.0)]


def test_barycentric(spark):
    vert = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 0.0, 10.0), (3, 10.0, 10.0)], "v bigint, x double, y double")
    tri = spark.createDataFrame([(0, 0, 1, 2), (1, 1, 3, 2)], "tri bigint, v0 bigint, v1 bigint, v2 bigint")
    values = vert.select(F.lit(1).alias("time"), "v", (F.col("x") * 3 + F.col("y") * 5).alias("value"))
    pts = spark.createDataFrame([(0, 2.0, 3.0), (1, 5.0, 5.0), (2, 9.0, 9.0), (3, 11.0, 5.0), (4, 10.0, 0.0)], "target bigint, x double, y double")
    w = rg.barycentric_weights(tri, vert, pts)
    assert {r.target for r in w.collect()} == {0, 1, 2, 4}          # 3 lies outside
    assert {r.v for r in w.filter("target = 1").collect()} == {0, 1, 2}   # shared edge: lowest triangle
    got = {r.target: r.value for r in rg.barycentric_interp(values, tri, vert, pts).collect()}
    assert got == {0: pytest.approx(21.0), 1: pytest.approx(40.0), 2: pytest.approx(72.0), 4: pytest.approx(30.0)}


def holders(corners, x, y):
    """Triangles that hold a point, by the signs of three areas."""
    out = []
    for tri, ((x0, y0), (x1, y1), (x2, y2)) in corners.items():
        areas = [(x1 - x0) * (y - y0) - (y1 - y0) * (x - x0), (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1), (x0 - x2) * (y - y2) - (y0 - y2) * (x - x2)]
        if all(a >= 0 for a in areas) or all(a <= 0 for a in areas):
            out.append(tri)
    return out


def test_triangles_of_all_sizes(spark):
    r = random.Random(6)
    shapes = []
    for k in range(300):
        size = 10.0 ** r.uniform(-3, 3)
        x, y, turn = r.uniform(-50, 50), r.uniform(-50, 50), r.uniform(0, 6.3)
        thin = r.choice([1.0, 1.0, 0.01, 1e-4])
        shapes.append([(x + size * (a * math.cos(turn) - b * thin * math.sin(turn)), y + size * (a * math.sin(turn) + b * thin * math.cos(turn)))
                       for a, b in ((0, 0), (1, 0), (0.3, 1))])
    shapes += [[(0.0, 0.0), (8.0, 0.0), (0.0, 8.0)], [(8.0, 0.0), (8.0, 8.0), (0.0, 8.0)], [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]]   # the last has no area
    corners = {1000 - k: p for k, p in enumerate(shapes)}
    vert = spark.createDataFrame([(10 * t + i, *p) for t, ps in corners.items() for i, p in enumerate(ps)], "v bigint, x double, y double")
    tri = spark.createDataFrame([(t, 10 * t, 10 * t + 1, 10 * t + 2) for t in corners], "tri bigint, v0 bigint, v1 bigint, v2 bigint")
    points = [(r.uniform(-60, 60), r.uniform(-60, 60)) for _ in range(500)] + [(sum(a * x for a, (x, _) in zip(w, ps)), sum(a * y for a, (_, y) in zip(w, ps)))
              for ps in shapes[:300] for w in ((0.2, 0.3, 0.5), (0.9, 0.05, 0.05))]
    at = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "target bigint, x double, y double")
    got = {x.target: x.v // 10 for x in rg.barycentric_weights(tri, vert, at).collect()}
    flat = corners.pop(1000 - len(shapes) + 1)
    assert flat == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]
    want = {i: min(h) for i, p in enumerate(points) if (h := holders(corners, *p))}
    assert got == want


def test_a_target_meets_few_of_many_triangles(spark):
    n = 224                                    # 100,352 small triangles, and a huge one below them all
    cells = spark.range(n * n).select((F.col("id") % n).alias("i"), F.floor(F.col("id") / n).alias("j"))
    corner = lambda i, j: F.col("j") * 1000 + j * 1000 + F.col("i") + i
    small = cells.select((F.col("j") * 1000 + F.col("i")).alias("k"), corner(0, 0).alias("a"), corner(1, 0).alias("b"), corner(0, 1).alias("c"), corner(1, 1).alias("d"))
    huge = spark.createDataFrame([(10 ** 9, 10 ** 9, 10 ** 9 + 1, 10 ** 9 + 2)], "tri bigint, v0 bigint, v1 bigint, v2 bigint")
    tri = small.selectExpr("2 * k as tri", "a as v0", "b as v1", "c as v2").union(small.selectExpr("2 * k + 1", "b", "d", "c")).union(huge)
    vert = spark.range((n + 1) * 1000).select(F.col("id").alias("v"), (F.col("id") % 1000 / 7.0).alias("x"), (F.floor(F.col("id") / 1000) / 7.0).alias("y"))
    vert = vert.union(spark.createDataFrame([(10 ** 9, -5000.0, -5000.0), (10 ** 9 + 1, 9000.0, -5000.0), (10 ** 9 + 2, 0.0, 9000.0)], "v bigint, x double, y double"))
    bins = stage_table(rg.triangle_bins(rg.with_corners(tri, vert)), "bins")
    levels = [x[0] for x in bins.select("_level").distinct().collect()]
    assert len(levels) == 2 and bins.count() < 7 * 100_353
    r = random.Random(1)
    at = spark.createDataFrame([(i, r.uniform(-40, 40), r.uniform(-40, 40)) for i in range(2000)], "target bigint, x double, y double")
    met = rg.target_bins(at, levels).join(bins, ["_level", "_bx", "_by"]).groupBy("target").count().agg(F.max("count"), F.min("count")).first()
    assert met[0] <= 20 and met[1] >= 1
    values = vert.select(F.lit(1).alias("time"), "v", (F.col("x") * 2 - F.col("y") * 3).alias("value"))
    got = rg.barycentric_interp(values, tri, vert, at).join(at, "target").select(F.max(F.abs(F.col("value") - F.col("x") * 2 + F.col("y") * 3)), F.count("*")).first()
    assert got[1] == 2000 and got[0] < 1e-6


def test_no_triangles_and_no_targets(spark):
    tri = spark.createDataFrame([], "tri bigint, v0 bigint, v1 bigint, v2 bigint")
    vert = spark.createDataFrame([(0, 0.0, 0.0)], "v bigint, x double, y double")
    at = spark.createDataFrame([(1, 1.0, 1.0)], "target bigint, x double, y double")
    assert rg.barycentric_weights(tri, vert, at).count() == 0
    assert rg.barycentric_weights(tri, vert, at.limit(0)).count() == 0


def test_bin_mean(spark):
    pts = spark.createDataFrame([(45.0, 40.0, 2.0), (45.5, 40.5, 4.0), (45.5, 40.5, None), (None, 3.0, 9.0)], "lon double, lat double, value double")
    got = {r.pix: r.value for r in rg.bin_mean_to_hpx(pts, 1).collect()}
    assert len(got) == 12 and got[0] == pytest.approx(6.0 / (2 + 1e-7)) and sum(v != 0 for v in got.values()) == 1


def test_face_mosaic(spark):
    one = rg.face_mosaic(hpx_cells(spark, 1), 1)
    places = {r.face: (r.row, r.col) for r in one.collect()}
    assert places == {0: (3, 0), 1: (2, 1), 2: (1, 2), 3: (0, 3), 4: (4, 0), 5: (3, 1), 6: (2, 2), 7: (1, 3),
                      8: (4, 1), 9: (3, 2), 10: (2, 3), 11: (1, 4)}
