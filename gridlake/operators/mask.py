"""Masks on the static cells table, and applying them to fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import BROADCAST_BYTES, broadcast_within
from gridlake.functions.geo import lon_to_pm180

BOX_BYTES = 128       # of a row of ``polygon_boxes``, with a polygon's name of some letters


def polygon_boxes(edges: DataFrame, box: float = 1.0) -> DataFrame:
    """What a point needs to know of each polygon, for each ``box`` x ``box`` degrees: ``_band``, ``_bin``, ``poly``.

    An edge is cut at the bands of latitude, and a piece is listed in the boxes that it touches, so an edge makes
    about as many rows as the bands and bins it spans. ``_b1`` and ``_b2`` tell whether the piece's ends lie east
    of the box. A row without an edge says that an odd number of edges crosses the band's upper side east of the box.

    That is all there is to say of the edges that lie wholly east of a box: a ray at latitude y crosses such a
    piece if one end is above y and one is not. Rings are closed, so each vertex ends two pieces, and summed over
    all ends east of the box only those remain that lie on the band's upper side, and the eastern ends of pieces that
    reach into the box. The former are counted once for each box, the latter are in it. No geometry is computed
    for either, so nothing can be rounded to the wrong side.
    """
    size = F.lit(float(box))
    piece = edges.select("poly", "x1", "y1", "x2", "y2", F.explode(F.sequence(
        F.floor(F.least("y1", "y2") / size), F.floor(F.greatest("y1", "y2") / size))).alias("_band"))
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    bottom, top = F.col("_band") * size, (F.col("_band") + 1) * size

    def end(x: Column, y: Column) -> Column:
        """Longitude of the piece's end: the edge's own, or where it leaves the band."""
        at = x1 + (x2 - x1) * ((F.when(y >= top, top).otherwise(bottom) - y1) / (y2 - y1))
        held = F.least(F.greatest(at, F.least(x1, x2)), F.greatest(x1, x2))
        return F.when((y < top) & (y >= bottom), x).otherwise(held)

    piece = piece.withColumns({"_e1": end(x1, y1), "_e2": end(x2, y2), "_up": F.when(y1 >= top, 1).when(y2 >= top, 2)})
    piece = piece.withColumns({"_k1": F.floor(F.col("_e1") / size), "_k2": F.floor(F.col("_e2") / size)})
    # Boxes within a hair of the piece are listed too, lest a rounded cut hides an edge from a point on it.
    hair = F.lit(1e-9)
    touched = F.sequence(F.floor((F.least("_e1", "_e2") - hair) / size), F.floor((F.greatest("_e1", "_e2") + hair) / size))
    tested = piece.withColumn("_bin", F.explode(touched)).select(
        "_band", "_bin", "poly", "x1", "y1", "x2", "y2", (F.col("_k1") > F.col("_bin")).alias("_b1"), (F.col("_k2") > F.col("_bin")).alias("_b2"))

    odd = (piece.filter("_up IS NOT NULL").groupBy("poly", "_band", F.when(F.col("_up") == 1, F.col("_k1")).otherwise(F.col("_k2")).alias("_k"))
           .agg((F.count(F.lit(1)) % 2).alias("_n")).filter("_n = 1")
           .groupBy("poly", "_band").agg(F.sort_array(F.collect_list("_k")).alias("_ks")).filter(F.size("_ks") > 1))
    pairs = F.transform(F.sequence(F.lit(0), F.size("_ks") - 2, F.lit(2)),
                        lambda i: F.sequence(F.col("_ks")[i], F.col("_ks")[i + 1] - 1))
    inside = odd.select("_band", F.explode(F.flatten(pairs)).alias("_bin"), "poly")
    return tested.unionByName(inside, allowMissingColumns=True)


def polygon_mask(cells: DataFrame, edges: DataFrame, band: float = 1.0, key: str = "pix", rows: int | None = None) -> DataFrame:
    """Whether each cell centre lies strictly inside any polygon: ``(key, mask)``.

    ``edges(poly, part, ring, x1, y1, x2, y2)`` holds closed rings in longitudes -180..180. A ring
    within a ring is a hole. A point on an edge is outside. Cells and edges meet in boxes of ``band`` degrees
    in both directions (``polygon_boxes``); a cell is inside a polygon when its parallel crosses an odd number of
    edges to its east, and meets only those that cross its own box. ``rows`` bounds the number of edges, where
    parameters give it.
    """
    size = F.lit(float(band))
    c = cells.select(key, F.col("lat").alias("_lat"), lon_to_pm180(F.col("lon")).alias("_lon")).withColumns({
        "_band": F.floor(F.col("_lat") / size), "_bin": F.floor(F.col("_lon") / size)})
    boxes = polygon_boxes(edges, band)
    if rows is not None and rows * (540 / band + 4) * BOX_BYTES <= BROADCAST_BYTES:
        boxes = F.broadcast(boxes)
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    lon, lat = F.col("_lon"), F.col("_lat")
    meets = (y1 > lat) != (y2 > lat)
    crosses = F.when(meets, lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1).otherwise(False)
    on_edge = (
        ((x2 - x1) * (lat - y1) == (y2 - y1) * (lon - x1))
        & lon.between(F.least(x1, x2), F.greatest(x1, x2))
        & lat.between(F.least(y1, y2), F.greatest(y1, y2))
    )
    count = F.when(x1.isNull() & F.col("poly").isNotNull(), 1).otherwise(
        crosses.cast("int") + F.coalesce((F.col("_b1") & (y1 > lat)).cast("int"), F.lit(0))
        + F.coalesce((F.col("_b2") & (y2 > lat)).cast("int"), F.lit(0)))
    # A cell whose box no polygon touches keeps its row, with nothing to count.
    return (
        c.join(boxes, ["_band", "_bin"], "left")
        .groupBy(key, "poly")
        .agg((F.sum(count) % 2 == 1).alias("_odd"), F.coalesce(F.bool_or(on_edge), F.lit(False)).alias("_edge"))
        .groupBy(key)
        .agg(F.coalesce(F.bool_or(F.col("_odd") & ~F.col("_edge")), F.lit(False)).alias("mask"))
    )


def polar_cap_mask(cells: DataFrame, lat0: float = -60.0, key: str = "pix") -> DataFrame:
    """Cells strictly south of ``lat0``."""
    return cells.select(key, (F.col("lat") < lat0).alias("mask"))


def either_mask(a: DataFrame, b: DataFrame, key: str = "pix") -> DataFrame:
    return a.join(b.withColumnRenamed("mask", "_other"), key).select(key, (F.col("mask") | F.col("_other")).alias("mask"))


def icesheet_mask(cells: DataFrame, edges: DataFrame, south_of: float | None = None, key: str = "pix",
                  rows: int | None = None) -> DataFrame:
    """Polygons, and with ``south_of`` also everything south of that latitude. ``rows`` as of ``polygon_mask``."""
    mask = polygon_mask(cells, edges, key=key, rows=rows)
    return mask if south_of is None else either_mask(mask, polar_cap_mask(cells, south_of, key), key)


def apply_mask(df: DataFrame, mask: DataFrame, fill: float, key: str = "pix", value: str = "value",
               rows: int | None = None) -> DataFrame:
    """Masked cells take the fill value at every time; other cells stay as they are."""
    masked = broadcast_within(mask.filter("mask").select(key, F.lit(True).alias("_masked")), rows)
    return df.join(masked, key, "left").withColumn(
        value, F.when(F.col("_masked"), F.lit(fill)).otherwise(F.col(value))
    ).select(*df.columns)
