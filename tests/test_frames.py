import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.operators import frames, regrid
from gridlake.operators.spine import grid_spine


def field(spark, nlat, nlon, days=3):
    cells = grid_spine(spark, nlat, nlon).select("lat_idx", "lon_idx")
    rows = cells.withColumn("time", F.explode(F.sequence(F.lit("2024-01-01").cast("timestamp_ntz"), F.lit(f"2024-01-0{days}").cast("timestamp_ntz"),
                                                         F.make_dt_interval(days=F.lit(1)))))
    value = (F.col("lat_idx") * 31 + F.col("lon_idx") * 7 + F.dayofmonth("time") * 5) % 97 * 1.0
    return rows.withColumn("value", F.when((F.col("lat_idx") + F.col("lon_idx") + F.dayofmonth("time")) % 23 != 0, value))


def rounded(df):
    return sorted(((r.time, r.pix, None if r.value is None else round(r.value, 9)) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows, options", [(4, {}), (1, {"wrap": "periodic"}), (64, {"order": "nearest-neighbor"})])
def test_packed_equals_long(spark, rows, options):
    df = field(spark, 19, 36)
    packed = stage_table(frames.pack_bands(df, 19, 36, rows), "bands")
    got = frames.unpack_faces(frames.remap_ll_to_faces(packed, 4, 19, 36, rows, **options), 4)
    want = regrid.remap_ll_to_hpx(df, 4, 19, 36, **options)
    assert rounded(got) == rounded(want) and got.count() == 3 * 192


def test_no_cell_travels(spark):
    packed = stage_table(frames.pack_bands(field(spark, 19, 36), 19, 36, 8), "bands")
    weights = stage_table(frames.band_weights(regrid.ll_to_hpx_weights(regrid.hpx_cells(spark, 4), 19, 36), 4, 36, 8), "weights")
    plan = frames.remap_bands(packed, weights, 4)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange (?!Single)[a-z]*partitioning\(([^)]*)\)", plan)
    assert dealt and all({c.strip().split("#")[0] for c in d.split(",")[:-1]} <= {"time", "face"} for d in dealt), dealt
    assert "BroadcastHashJoin" in plan and "explode" not in plan


def test_absent_rows_are_missing_and_repeated_ones_an_error(spark):
    df = field(spark, 19, 36, 1)
    some = df.filter("lat_idx <> 9 or lon_idx > 3")
    got = frames.unpack_faces(frames.remap_ll_to_faces(frames.pack_bands(some, 19, 36, 4), 4, 19, 36, 4), 4)
    want = {(t, p): v for t, p, v in rounded(regrid.remap_ll_to_hpx(some, 4, 19, 36))}      # without rows for cells that have no source at all
    assert all(v == want.get((t, p)) for t, p, v in rounded(got)) and len(want) < got.count() == 192
    with pytest.raises(PySparkException, match="more than once"):
        frames.pack_bands(df.union(df.limit(1)), 19, 36, 4).collect()
    with pytest.raises(PySparkException, match="a band is not there"):
        frames.remap_ll_to_faces(frames.pack_bands(df, 19, 36, 4).filter("band <> 1"), 4, 19, 36, 4).collect()
    assert frames.pack_bands(df.limit(0), 19, 36, 4).count() == 0
