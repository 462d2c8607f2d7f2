"""What the operators share: learn splits, bounded samples, and texts as flat byte arrays.

A text column arrives in Python as an Arrow array. ``blocks`` hands it on in runs of whole texts of
about one megabyte, as one byte array with offsets, so that numpy works on many texts at once and
memory does not grow with the batch. A text longer than that is a block of its own.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20

# The bytes [\x20\x09-\x0D], which separate words; A-Z are lower-cased.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240901).integers(1, 1 << 63, 256, dtype=np.uint64)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application, as Spark's own py-file."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="gridlake-py-"), "gridlake_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def split_of(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, key: Column, limit: int, rows: int, seed: int = 7) -> DataFrame:
    """About ``limit`` of ``rows`` rows, chosen by the hash of ``key``; all of them if there are fewer."""
    if rows <= limit:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * limit / rows))


# What a Python worker keeps between tasks. A worker that turns to other work gives the memory back.
remembered: list[dict] = []


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; nulls are empty texts."""
    for kept in remembered:
        kept.clear()
    arr = texts.fill_null("").cast(pa.large_string())
    if not len(arr):
        return
    _, offsets, values = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None):
    """(starts, ends, first): the words of a block, and per text the index of its first word.

    ``inside`` says for each byte whether it belongs to words; by default all but white space do.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = (~SPACE if inside is None else inside)[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    left = cut[:n].copy()
    left[1:] |= ~w[:-1]
    right = cut[1:].copy()
    right[:-1] |= ~w[1:]
    starts = np.flatnonzero(w & left)
    return starts, np.flatnonzero(w & right) + 1, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0..n and those of its inverse, modulo 2**64."""
    if _powers and len(_powers[0]) > n:
        return _powers[0], _powers[1]
    out = []
    for base in (_MULT, _INVERSE):
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 4 * BLOCK_BYTES:
        _powers[:] = out
    return out[0], out[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of each word; ``table`` maps bytes before hashing (A-Z to a-z by default)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[table][data] * power[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h ^ (ends - starts).astype(np.uint64))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text's run of words or bytes, given the runs' bounds."""
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
