import math

import pytest
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.functions import healpix
from gridlake.operators.spine import hpx_cells


def test_known_centres(spark):
    one = {r.pix: (r.lon, r.lat) for r in hpx_cells(spark, 1).collect()}
    assert one[0] == (45.0, pytest.approx(math.degrees(math.asin(2 / 3))))
    assert one[4] == (0.0, 0.0)
    assert one[8] == (45.0, pytest.approx(-math.degrees(math.asin(2 / 3))))


@pytest.mark.parametrize("nside", [1, 2, 4, 16, 64, 512])
def test_round_trips(spark, nside):
    cells = stage_table(hpx_cells(spark, nside), "cells")
    back = healpix.with_containing_pix(cells, nside, out="found")
    back = healpix.with_pix(back, nside, out="rebuilt")
    wrong = back.filter((F.col("found") != F.col("pix")) | (F.col("rebuilt") != F.col("pix"))).count()
    assert wrong == 0
    stats = cells.agg(F.count("*").alias("n"), F.countDistinct("face", "height", "width").alias("d"),
                      F.countDistinct("ring", "ring_pos").alias("r"), F.max("lon").alias("lon"), F.avg("lat").alias("lat")).first()
    assert stats.n == stats.d == stats.r == 12 * nside * nside
    assert 0 <= stats.lon < 360 and abs(stats.lat) < 1e-9


def test_layout_of_a_face(spark):
    """Index 0 of a face is its last row and column; the highest index its first."""
    rows = {r.pix: (r.height, r.width) for r in hpx_cells(spark, 4).filter("face = 0").collect()}
    assert rows[0] == (3, 3) and rows[15] == (0, 0)
    assert rows[1] == (2, 3) and rows[2] == (3, 2)     # bit 0 moves height, bit 1 moves width


def test_nearest_centre_contains_point(spark):
    """A point's cell centre is about as near as a cell is wide."""
    pts = spark.range(500).select("id", (F.pmod(F.col("id") * 73.13, F.lit(360.0))).alias("lon"),
                                  (F.pmod(F.col("id") * 37.77, F.lit(180.0)) - 90.0).alias("lat"))
    hit = healpix.with_containing_pix(pts, 16).alias("p").join(
        hpx_cells(spark, 16).select("pix", F.col("lat").alias("clat"), F.col("lon").alias("clon")), "pix")
    assert hit.count() == 500
    for r in hit.collect():
        a, b = math.radians(r.lat), math.radians(r.clat)
        cos = math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(r.lon - r.clon))
        assert math.degrees(math.acos(min(1.0, cos))) < 5.2


def test_nside_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        healpix.level(3)
