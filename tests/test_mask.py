import math
import random

from conftest import values
from pyspark.sql import functions as F

from gridlake.functions.geo import lon_to_pm180
from gridlake.operators import mask as mk
from gridlake.operators.spine import hpx_cells

SQUARE = [("s", 0, 0, 0.0, 0.0, 10.0, 0.0), ("s", 0, 0, 10.0, 0.0, 10.0, 10.0), ("s", 0, 0, 10.0, 10.0, 0.0, 10.0), ("s", 0, 0, 0.0, 10.0, 0.0, 0.0)]
HOLE = [("s", 0, 1, 4.0, 4.0, 6.0, 4.0), ("s", 0, 1, 6.0, 4.0, 6.0, 6.0), ("s", 0, 1, 6.0, 6.0, 4.0, 6.0), ("s", 0, 1, 4.0, 6.0, 4.0, 4.0)]
WEST = [("w", 0, 0, -30.0, -5.0, -10.0, -5.0), ("w", 0, 0, -10.0, -5.0, -20.0, 15.0), ("w", 0, 0, -20.0, 15.0, -30.0, -5.0)]
SCHEMA = "poly string, part int, ring int, x1 double, y1 double, x2 double, y2 double"


def masked(spark, points, edges, **kwargs):
    cells = spark.createDataFrame([(i, lon, lat) for i, (lon, lat) in enumerate(points)], "pix bigint, lon double, lat double")
    got = {r.pix: r.mask for r in mk.polygon_mask(cells, spark.createDataFrame(edges, SCHEMA), **kwargs).collect()}
    return [got[i] for i in range(len(points))]


def test_inside_outside_and_boundary(spark):
    points = [(5.0, 5.0), (11.0, 5.0), (10.0, 5.0), (0.0, 0.0), (5.0, 0.0), (5.0, 10.0), (5.0, -1.0), (0.5, 9.5)]
    assert masked(spark, points, SQUARE) == [True, False, False, False, False, False, False, True]


def test_hole(spark):
    points = [(5.0, 5.0), (4.0, 5.0), (2.0, 5.0), (8.0, 5.0)]
    assert masked(spark, points, SQUARE + HOLE) == [False, False, True, True]


def test_longitudes_above_180_turn_west(spark):
    points = [(340.0, 0.0), (335.0, 14.0), (340.0, 14.0), (180.0, 0.0)]
    assert masked(spark, points, SQUARE + WEST) == [True, False, True, False]


def test_band_width_does_not_matter(spark):
    points = [(x + 0.5, y + 0.25) for x in range(-2, 12, 2) for y in range(-2, 12, 2)]
    wide, narrow = (masked(spark, points, SQUARE + HOLE, band=b) for b in (50.0, 0.3))
    assert wide == narrow and any(wide) and not all(wide)


def test_polar_cap_is_strict(spark):
    cells = spark.createDataFrame([(0, -60.0), (1, -60.01), (2, 0.0)], "pix bigint, lat double")
    assert {r.pix: r.mask for r in mk.polar_cap_mask(cells).collect()} == {0: False, 1: True, 2: False}


def test_apply_mask_keeps_missing(spark, field):
    df = field([(1, "2024-01-01", None), (2, "2024-01-01", 3.0), (3, "2024-01-01", None), (4, "2024-01-01", 5.0)], "pix bigint")
    mask = spark.createDataFrame([(1, True), (2, True), (3, False)], "pix bigint, mask boolean")
    assert values(mk.apply_mask(df, mask, -1.0), "pix") == {1: -1.0, 2: -1.0, 3: None, 4: 5.0}


def ring(n, centre, radius, wave=0.0, poly="r", ring_no=0):
    at = [2 * math.pi * k / n for k in range(n)]
    p = [(centre[0] + (radius + wave * math.sin(40 * a)) * math.cos(a), centre[1] + (radius + wave * math.sin(40 * a)) * math.sin(a) / 2) for a in at]
    return [(poly, 0, ring_no, *p[k], *p[(k + 1) % n]) for k in range(n)]


def plainly(points, edges):
    """Every edge against every point."""
    out = []
    for lon, lat in points:
        lon = lon - 360 if lon > 180 else lon
        inside = False
        for poly in {e[0] for e in edges}:
            n, on = 0, False
            for _, _, _, x1, y1, x2, y2 in (e for e in edges if e[0] == poly):
                if (y1 > lat) != (y2 > lat):
                    n += lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
                on |= ((x2 - x1) * (lat - y1) == (y2 - y1) * (lon - x1) and min(x1, x2) <= lon <= max(x1, x2)
                       and min(y1, y2) <= lat <= max(y1, y2))
            inside |= n % 2 == 1 and not on
        out.append(inside)
    return out


def test_boxes_equal_every_edge_against_every_point(spark):
    r = random.Random(8)
    edges = ring(90, (20, 10), 25, 9) + ring(30, (25, 8), 6, ring_no=1) + ring(50, (-100.5, -40), 30, 12, "s") + ring(5, (0, 0), 170, poly="t")
    corners = [(e[3], e[4]) for e in edges]
    whole = [("u", 0, 0, float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(
        [(-150, 60), (-120, 60), (-120, 70), (-130, 65), (-140, 70), (-150, 70)], [(-120, 60), (-120, 70), (-130, 65), (-140, 70), (-150, 70), (-150, 60)])]
    points = [(r.uniform(0, 360), r.uniform(-90, 90)) for _ in range(400)] + [(float(r.randint(0, 360)), float(r.randint(-90, 90))) for _ in range(300)]
    points += r.sample(corners, 60) + [(float(x), float(y)) for x in range(-152, -117, 3) for y in (59.0, 60.0, 62.0, 65.0, 67.0, 70.0, 71.0)]
    points += [(x, c[1]) for c in corners[::7] for x in (-170.0, c[0] - 1, c[0] + 1, 10.0)]
    want = plainly(points, edges + whole)
    assert any(want) and not all(want)
    for size in (1.0, 0.37, 10.0, 400.0):
        assert masked(spark, points, edges + whole, band=size) == want


def test_a_cell_meets_few_of_many_edges(spark):
    edges = ring(10_000, (-40, 70), 35, 4)
    cells = hpx_cells(spark, 64).select("pix", "lon", "lat")
    size = 0.25
    boxes = mk.polygon_boxes(spark.createDataFrame(edges, SCHEMA), size)
    at = cells.select("pix", F.floor(F.col("lat") / size).alias("_band"), F.floor(lon_to_pm180(F.col("lon")) / size).alias("_bin"))
    met = at.join(boxes, ["_band", "_bin"]).groupBy("pix").count()
    most, pairs = met.agg(F.max("count"), F.sum("count")).first()
    assert most <= 100 and pairs < 40_000                 # of 10,000 edges and 49,152 cells
    mask = mk.polygon_mask(cells, spark.createDataFrame(edges, SCHEMA), size)
    assert mask.count() == 49_152
    some = cells.filter("pix % 37 = 0").join(mask, "pix").filter("lat > 40").collect()
    assert [c.mask for c in some] == plainly([(c.lon, c.lat) for c in some], edges)


def test_empty_polygons_and_cells(spark):
    assert masked(spark, [(5.0, 5.0)], []) == [False]
    assert masked(spark, [], SQUARE) == []
    assert masked(spark, [(5.0, 5.0)], SQUARE, rows=4) == [True]
