"""Remaps on packed frames: a field as dense arrays, weights as sparse blocks, and their product.

A lat/lon field is one array for each time and band of latitudes (``pack_bands``). The weights of a remap are told
for each band and face: which places of the band's array a cell needs, and with what weight (``band_weights``).
A band and its weights give the band's cells of a face in one step of array functions, so a field of 10^11 values
is 10^11 numbers in some million rows, and none of them travels by cell: what is shuffled to put faces together are
arrays, by time and face.

A cell that lies between two bands belongs to the northern one, whose array therefore has one more row of
latitudes at its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import BROADCAST_BYTES
from gridlake.functions import healpix
from gridlake.operators.regrid import ll_to_hpx_weights
from gridlake.operators.spine import hpx_cells

ENTRY_BYTES = 24      # of a weight in a block: place, weight, and its share of the arrays' heads


def pack_bands(df: DataFrame, nlat: int, nlon: int, rows: int = 64, group: Sequence[str] = ("time",), value: str = "value") -> DataFrame:
    """A lat/lon field (``lat_idx``, ``lon_idx``) as ``(group, band, values)``: ``rows`` latitudes and one more, row by row.

    Places without a row are missing. A place that occurs twice is an error. A band is bounded by the grid:
    ``(rows + 1) * nlon`` values.
    """
    band = F.floor(F.col("lat_idx") / F.lit(rows)).cast("int")
    first = (F.col("lat_idx") % rows == 0) & (F.col("lat_idx") > 0)             # ends the band before it, too
    cells = df.select(*group, "lat_idx", "lon_idx", F.col(value).cast("double").alias("_v"),
                      F.explode(F.when(first, F.array(band, band - 1)).otherwise(F.array(band))).alias("band"))
    one = cells.groupBy(*group, "band", ((F.col("lat_idx") - F.col("band") * rows) * nlon + F.col("lon_idx")).cast("int").alias("_p")).agg(
        F.first("_v").alias("_v"), F.count(F.lit(1)).alias("_n"))
    packed = one.groupBy(*group, "band").agg(F.map_from_entries(F.collect_list(F.struct("_p", "_v"))).alias("_m"), F.max("_n").alias("_n"))
    size = F.least(F.lit(rows + 1), F.lit(nlat) - F.col("band") * rows) * nlon
    dense = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.col("_m")[i])
    return packed.select(*group, "band", F.when(F.col("_n") == 1, dense).otherwise(
        F.raise_error(F.lit("a place of the grid occurs more than once")).cast("array<double>")).alias("values"))


def band_weights(weights: DataFrame, nside: int, nlon: int, rows: int = 64) -> DataFrame:
    """Weights (``pix``, ``lat_idx``, ``lon_idx``, ``w``) as ``(band, face, cells)``, one row for a band and face that meet.

    ``cells`` lists a face's cells by position: their places in the band's array and the weights there. ``rows`` as of
    ``pack_bands``. A cell may need latitudes of two neighbouring rows at most, as bilinear and nearest weights do.
    """
    cells = weights.groupBy("pix").agg(
        F.floor(F.min("lat_idx") / F.lit(rows)).cast("int").alias("band"), (F.max("lat_idx") - F.min("lat_idx")).alias("_span"),
        F.sort_array(F.collect_list(F.struct("lat_idx", "lon_idx", "w"))).alias("_s"))
    at = F.transform("_s", lambda s: ((s["lat_idx"] - F.col("band") * rows) * nlon + s["lon_idx"]).cast("int"))
    at = F.when(F.col("_span") <= 1, at).otherwise(F.raise_error(F.lit("a cell needs rows that lie apart")).cast("array<int>"))
    placed = healpix.with_face_height_width(cells.select("pix", "band", at.alias("at"), F.transform("_s", lambda s: s["w"]).alias("w")), nside)
    cell = F.struct((F.col("height") * nside + F.col("width")).alias("position"), "at", "w")
    return placed.groupBy("band", "face").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def remap_bands(packed: DataFrame, weights: DataFrame, nside: int, group: Sequence[str] = ("time",)) -> DataFrame:
    """Packed bands on HEALPix faces: ``(group, face, values)``, a dense array of ``nside ** 2`` values by position.

    ``weights`` comes from ``band_weights``. A cell is missing if a value that it needs is, or its weight;
    unlike in the long form it has its place even if no source row is there at all.
    """
    if 4 * healpix.npix(nside) * ENTRY_BYTES <= BROADCAST_BYTES:
        weights = F.broadcast(weights)

    def product(cell):
        term = F.zip_with(cell["at"], cell["w"], lambda place, w: F.get(F.col("values"), place) * w)
        return F.struct(cell["position"].alias("p"), F.aggregate(term, F.lit(0.0), lambda a, b: a + b).alias("v"))

    pieces = packed.join(weights, "band").select(*group, "face", F.transform("cells", product).alias("_cells"))
    faces = pieces.groupBy(*group, "face").agg(F.array_sort(F.flatten(F.collect_list("_cells"))).alias("_cells"))
    return faces.select(*group, "face", F.when(F.size("_cells") == nside * nside, F.transform("_cells", lambda c: c["v"])).otherwise(
        F.raise_error(F.format_string("%d cells in a face: a band is not there", F.size("_cells"))).cast("array<double>")).alias("values"))


def unpack_faces(frames: DataFrame, nside: int, group: Sequence[str] = ("time",)) -> DataFrame:
    """Frames as one row a cell: ``(group, pix, value)``."""
    long = frames.select(*group, "face", F.posexplode("values").alias("_p", "value"))
    long = long.withColumns({"height": F.floor(F.col("_p") / nside), "width": F.col("_p") % nside})
    return healpix.with_pix(long, nside).select(*group, "pix", "value")


def remap_ll_to_faces(df: DataFrame, nside: int, nlat: int, nlon: int, rows: int = 64, group: Sequence[str] = ("time",), **kwargs) -> DataFrame:
    """``regrid.remap_ll_to_hpx`` from a packed lat/lon field to packed frames; ``kwargs`` as of ``ll_to_hpx_weights``."""
    weights = ll_to_hpx_weights(hpx_cells(df.sparkSession, nside), nlat, nlon, **kwargs)
    return remap_bands(df, band_weights(weights, nside, nlon, rows), nside, group)
