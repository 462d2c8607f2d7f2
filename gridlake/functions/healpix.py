"""HEALPix nested index arithmetic as Spark columns (Gorski et al. 2005, ApJ 622, 759).

A cell is named by its nested index ``pix``. Within a base face, ``x`` counts towards north-east
and ``y`` towards north-west; the array layout of a face is ``height = n-1-x``, ``width = n-1-y``.
The ``with_*`` functions add columns in steps, so that each step is computed once per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions import geo


def level(nside: int) -> int:
    """log2(nside); nside must be a power of two."""
    if nside < 1 or nside & (nside - 1):
        raise ValueError(f"nside must be a power of two: {nside}")
    return nside.bit_length() - 1


def npix(nside: int) -> int:
    return 12 * nside * nside


# Bits of a byte moved two apart, and every other bit of a byte moved together, for all bytes. A
# lookup names its argument once; the shifts it stands for would name it once per bit, and the
# optimizer would repeat all of that wherever a filter or a join key needs the result.
# The tables are written as text, which the optimizer turns into one constant.
_SPREAD = ",".join(str(sum((byte >> k & 1) << 2 * k for k in range(8))) for byte in range(256))
_GATHER = ",".join(str(sum((byte >> 2 * k & 1) << k for k in range(4))) for byte in range(256))


def _by_byte(table: str, value: Column, n_bytes: int, out_bits: int) -> Column:
    """Look up each byte of ``value``; the result of one takes ``out_bits`` bits of the whole."""
    entries = F.split(F.lit(table), ",").cast("array<bigint>")

    def one(i: int) -> Column:
        byte = F.shiftright(value, 8 * i) if i else value
        found = F.get(entries, byte.bitwiseAND(F.lit(255).cast("bigint")).cast("int"))
        return F.shiftleft(found, out_bits * i) if i else found
    return reduce(lambda a, b: a + b, [one(i) for i in range(n_bytes)])


def even_bits(index: Column, nside: int) -> Column:
    """Gather bits 0, 2, 4, ... of a within-face index."""
    return _by_byte(_GATHER, index, max(1, -(-2 * level(nside) // 8)), 4)


def odd_bits(index: Column, nside: int) -> Column:
    """Gather bits 1, 3, 5, ... of a within-face index."""
    return even_bits(F.shiftright(index, 1), nside)


def interleave(x: Column, y: Column, nside: int) -> Column:
    """Inverse of ``even_bits``/``odd_bits``: x to the even bits, y to the odd bits."""
    n_bytes = max(1, -(-level(nside) // 8))
    return _by_byte(_SPREAD, x, n_bytes, 16) + F.shiftleft(_by_byte(_SPREAD, y, n_bytes, 16), 1)


def face_of(pix: Column, nside: int) -> Column:
    return F.shiftright(pix, 2 * level(nside))


def within_face(pix: Column, nside: int) -> Column:
    return pix.bitwiseAND(F.lit(nside * nside - 1).cast("bigint"))


def with_face_height_width(df: DataFrame, nside: int, pix: str = "pix") -> DataFrame:
    """Add ``face``, ``height``, ``width`` for a nested index."""
    p = F.col(pix).cast("bigint")
    r = within_face(p, nside)
    return df.withColumns({
        "face": face_of(p, nside).cast("int"),
        "height": (F.lit(nside - 1) - even_bits(r, nside)).cast("int"),
        "width": (F.lit(nside - 1) - odd_bits(r, nside)).cast("int"),
    })


def with_pix(df: DataFrame, nside: int, face="face", height="height", width="width", out="pix") -> DataFrame:
    """Add the nested index of (face, height, width)."""
    x = (F.lit(nside - 1) - F.col(height)).cast("bigint")
    y = (F.lit(nside - 1) - F.col(width)).cast("bigint")
    return df.withColumn(
        out, F.shiftleft(F.col(face).cast("bigint"), 2 * level(nside)) + interleave(x, y, nside)
    )


def with_centre(df: DataFrame, nside: int, pix: str = "pix") -> DataFrame:
    """Add ``ring``, ``ring_pos``, ``lat``, ``lon`` of the centre of each nested cell.

    Rings run 1..4n-1 from north to south, positions 1..4*nr along a ring.
    """
    n = nside
    p = F.col(pix).cast("bigint")
    r = within_face(p, n)
    out = df.withColumns({"_f": face_of(p, n), "_x": even_bits(r, n), "_y": odd_bits(r, n)})
    f, x, y = F.col("_f"), F.col("_x"), F.col("_y")
    row = F.shiftright(f, 2)                      # 0 north, 1 equator, 2 south
    quarter = f.bitwiseAND(F.lit(3).cast("bigint"))
    out = out.withColumns({
        "ring": (row + 2) * n - x - y - 1,
        "_jp": quarter * 2 + F.when(row == 1, 0).otherwise(1),
    })
    ring = F.col("ring")
    out = out.withColumns({
        "_nr": F.when(ring < n, ring).when(ring > 3 * n, 4 * n - ring).otherwise(n).cast("bigint"),
        "_ks": F.when((ring < n) | (ring > 3 * n), 0)
        .otherwise((ring - n).bitwiseAND(F.lit(1).cast("bigint"))).cast("bigint"),
    })
    nr, ks = F.col("_nr"), F.col("_ks")
    out = out.withColumn(
        "ring_pos",
        F.pmod(F.shiftright(F.col("_jp") * nr + x - y + 1 + ks, 1) - 1, nr * 4) + 1,
    )
    cap = nr.cast("double") * nr / F.lit(3.0 * n * n)
    z = (F.when(ring < n, 1.0 - cap).when(ring > 3 * n, cap - 1.0)
         .otherwise((F.lit(2 * n) - ring).cast("double") * 2.0 / F.lit(3.0 * n)))
    return out.withColumns({
        "lat": geo.latitude_of_sin(z),
        "lon": (F.col("ring_pos") - (ks + 1) / F.lit(2.0)) * 90.0 / nr,
    }).drop("_f", "_x", "_y", "_jp", "_nr", "_ks")


def with_containing_pix(df: DataFrame, nside: int, lon="lon", lat="lat", out="pix") -> DataFrame:
    """Add the nested index of the cell that holds each (lon, lat)."""
    n = nside
    d = df.withColumns({
        "_z": geo.sin_of_latitude(F.col(lat)),
        "_tt": F.pmod(F.col(lon), F.lit(360.0)) / 90.0,
    })
    z, tt = F.col("_z"), F.col("_tt")
    belt = F.abs(z) <= F.lit(2.0 / 3.0)
    d = d.withColumns({
        "_q": F.least(F.lit(3.0), F.floor(tt).cast("double")),
        "_s": F.lit(float(n)) * F.sqrt(3.0 * (1.0 - F.abs(z))),
    })
    turn, s = tt - F.col("_q"), F.col("_s")
    top = F.lit(n - 1).cast("bigint")
    d = d.withColumns({
        "_a": F.when(belt, F.floor(F.lit(float(n)) * (0.5 + tt - 0.75 * z)).cast("bigint"))
        .otherwise(F.least(top, F.floor(turn * s).cast("bigint"))),
        "_b": F.when(belt, F.floor(F.lit(float(n)) * (0.5 + tt + 0.75 * z)).cast("bigint"))
        .otherwise(F.least(top, F.floor((1.0 - turn) * s).cast("bigint"))),
    })
    a, b = F.col("_a"), F.col("_b")
    fa, fb = F.shiftright(a, level(n)), F.shiftright(b, level(n))
    q = F.col("_q").cast("bigint")
    north = z > 0
    d = d.withColumns({
        "_f": F.when(belt, F.when(fa == fb, fa.bitwiseOR(F.lit(4).cast("bigint")))
                     .when(fa < fb, fa).otherwise(fb + 8))
        .when(north, q).otherwise(q + 8),
        "_x": F.when(belt, b.bitwiseAND(top)).when(north, top - b).otherwise(a),
        "_y": F.when(belt, top - a.bitwiseAND(top)).when(north, top - a).otherwise(b),
    })
    return d.withColumn(
        out,
        F.shiftleft(F.col("_f"), 2 * level(n)) + interleave(F.col("_x"), F.col("_y"), n),
    ).drop("_z", "_tt", "_q", "_s", "_a", "_b", "_f", "_x", "_y")
