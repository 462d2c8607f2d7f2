"""Nearest neighbours by randomly rotated one-bit codes.

Rows are dealt to blocks by a hash. In a block the centroid is the block's own mean; of each row's residual the
unit vector o is turned by a random rotation into ``bits`` dimensions, and only the signs are kept, packed. Two
scalars go with a code: the residual's length, and <code, o>, by which the code's inner product with a query is
divided to make it an unbiased estimate of <o, q>. The estimate's error is below
EPSILON * sqrt((1 - <code, o>^2) / <code, o>^2 / (bits - 1)) * |q| but for a small known share of rows (1 in 100 at
2.5). So a tile, a block of queries against a block of codes, is searched in three steps: estimates from the
packed bits; the 4 k best estimates scored exactly, whose k-th score is a floor; and of all other rows those whose
estimate plus error bound reaches the floor are scored exactly too. Nothing else of the original vectors is
touched, and nothing is cut at a number of candidates.

A tile gives each query's k best, the tiles' lists are merged in a tree. Nothing is fitted, so every row is in the
index; the only way to lose a neighbour is an estimate that is off by more than its bound.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.cluster import stage_table

LEAST_BITS = 256           # of a code; vectors of more dimensions get a bit for each
EPSILON = 2.5
BLOCK_BYTES = 32 << 20     # of a block's vectors, eight bytes a number
LEAST_ROWS = 2048
TILES_PER_CORE = 3
FAN = 32
SEEDS = 4                  # times k: the best estimates that are scored first
QUERIES_AT_ONCE, ROWS_AT_ONCE, PAIRS_AT_ONCE = 256, 8192, 1 << 15
BLOCK = "dims int, block int, ids binary, vectors binary, centroid binary, codes binary, lengths binary, shares binary"


@functools.lru_cache(maxsize=8)
def rotation(dims: int, bits: int, seed: int = 20) -> np.ndarray:
    """(bits, dims): the first ``dims`` columns of a random rotation, the same for the same arguments."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))[0]


def code_bits(dims: int) -> int:
    return max(LEAST_BITS, -(-dims // 64) * 64)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, packed signs, residual lengths, <code, o>) of the rows of ``x``."""
    centroid = x.mean(axis=0)
    rest = x - centroid
    lengths = np.linalg.norm(rest, axis=1)
    bits = code_bits(x.shape[1])
    codes, shares = np.zeros((len(x), bits // 8), np.uint8), np.ones(len(x))
    for a in range(0, len(x), ROWS_AT_ONCE):
        part = slice(a, a + ROWS_AT_ONCE)
        unit = rest[part] / np.where(lengths[part] > 0, lengths[part], 1.0)[:, None]
        turned = unit @ rotation(x.shape[1], bits).T
        codes[part] = np.packbits(turned >= 0, axis=1)
        shares[part] = np.abs(turned).sum(axis=1) / np.sqrt(bits)
    shares[lengths == 0] = 1.0
    return centroid, codes, lengths, shares


def estimate(q: np.ndarray, centroid: np.ndarray, codes: np.ndarray, lengths: np.ndarray, shares: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, error bounds) of the inner products of all queries with all coded rows."""
    bits = codes.shape[1] * 8
    turned = (q @ rotation(q.shape[1], bits).T).astype(np.float32)
    scale = lengths / shares / np.sqrt(bits)
    guess = np.empty((len(q), len(codes)))
    for a in range(0, len(codes), ROWS_AT_ONCE):
        part = slice(a, a + ROWS_AT_ONCE)
        signs = np.unpackbits(codes[part], axis=1).astype(np.float32) * 2 - 1
        guess[:, part] = (turned @ signs.T) * scale[part]
    guess += (q @ centroid)[:, None]
    spread = EPSILON * lengths * np.sqrt(np.maximum(1 - shares ** 2, 0) / shares ** 2 / (bits - 1))
    return guess, np.linalg.norm(q, axis=1)[:, None] * (spread + 1e-6 * lengths)


def _exact(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The inner product of each pair (row of q, row of x)."""
    out = np.empty(len(row))
    for a in range(0, len(row), PAIRS_AT_ONCE):
        b = slice(a, a + PAIRS_AT_ONCE)
        out[b] = np.einsum("ij,ij->i", q[row[b]], x[col[b]])
    return out


def nearest_of_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, coded: tuple, k: int
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of each query's k best of a block, and how many pairs were scored exactly."""
    guess, error = estimate(q, *coded)
    own = q_ids[:, None] == ids
    guess[own] = -np.inf                                         # a row is never found for its own id
    seeds = SEEDS * k
    if len(ids) > seeds:
        first_row = np.repeat(np.arange(len(q)), seeds)
        first = np.argpartition(guess, len(ids) - seeds, axis=1)[:, len(ids) - seeds:].ravel()
        score = np.where(own[first_row, first], -np.inf, _exact(q, x, first_row, first)).reshape(len(q), seeds)
        floor = np.partition(score, seeds - k, axis=1)[:, seeds - k]
        wanted = guess + error >= floor[:, None]
        wanted[first_row, first] = True
        row, col = np.nonzero(wanted & ~own)
    else:
        row, col = np.nonzero(~own)
    score = _exact(q, x, row, col)
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return row[keep], ids[col[keep]], score[keep], len(row)


def _pack(rows: DataFrame, with_codes: bool) -> DataFrame:
    """One row a block of rows (dims, block, id, numbers)."""
    def pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        dims, n = key[0].as_py(), t.num_rows
        ids = t.column("id").to_numpy()
        flat = t.column("numbers").combine_chunks().flatten().to_numpy().reshape(n, dims)
        parts = encode(flat) if with_codes else (np.zeros(0),) * 4
        return pa.table({"dims": pa.array([dims], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         **{name: pa.array([v.tobytes()], pa.binary()) for name, v in
                            zip(("ids", "vectors", "centroid", "codes", "lengths", "shares"), (ids, flat, *parts))}})

    return rows.groupBy("dims", "block").applyInArrow(pack, BLOCK)


def _top(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy("query_id", *by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding"
            ) -> DataFrame:
    """(query_id, rank, vec_id, score): k rows of about the largest inner product for each row where ``queries`` holds.

    The score is the inner product of the vectors as doubles. A row is never found for its own id. Equal scores
    are ranked by ascending id. Vectors that are null, zero or empty, or hold null or non-finite components take
    no part, nor do rows with a null id; vectors of another length than the query's are not compared with it.
    Every repeated row is a candidate; a repeated query's lists are ranked as one. No rows give no rows. Other
    columns are not read, so they cannot clash.
    """
    x = F.col(embedding).cast("array<double>")
    good = x.isNotNull() & F.col(vec_id).isNotNull() & F.exists(x, lambda v: v != 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.filter(good).select(
        F.col(vec_id).cast("long").alias("id"), F.size(x).alias("dims"), queries.alias("asks"), x.alias("numbers"))
    size = rows.agg(F.count("*"), F.sum(F.col("asks").cast("int")), F.max("dims")).first()
    n, n_queries, dims = size[0], size[1] or 0, max(1, size[2] or 1)
    most = max(1, BLOCK_BYTES // (8 * dims))
    tiles = max(1, TILES_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism)
    query_blocks = max(1, -(-n_queries // most))
    shards = max(1, -(-n // min(most, max(LEAST_ROWS, -(-n * query_blocks // tiles)))))
    spread = F.xxhash64("id", "numbers", F.monotonically_increasing_id())      # copies of a row go to all blocks
    block = lambda count: F.pmod(spread, F.lit(count)).cast("int")             # noqa: E731
    rows = stage_table(rows.withColumn("i", block(query_blocks)).withColumn("j", block(shards)), "one-bit-rows")
    ask = stage_table(_pack(rows.filter("asks").withColumn("block", F.col("i")).drop("asks", "i", "j"), False), "one-bit-queries")
    coded = stage_table(_pack(rows.withColumn("block", F.col("j")).drop("asks", "i", "j"), True), "one-bit-codes")
    left = ask.select("dims", F.col("block").alias("i"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = coded.withColumnRenamed("block", "j").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                at = {name: batch.column(c)[r].as_py() for c, name in enumerate(batch.schema.names)}
                dims, j = at.pop("dims"), at.pop("j")
                num = lambda name, kind=np.float64: np.frombuffer(at[name], kind)      # noqa: E731
                q_ids, ids = num("q_ids", np.int64), num("ids", np.int64)
                q, vecs = num("q").reshape(-1, dims), num("vectors").reshape(-1, dims)
                code = (num("centroid"), num("codes", np.uint8).reshape(len(ids), -1), num("lengths"), num("shares"))
                step = max(1, min(QUERIES_AT_ONCE, (1 << 23) // max(1, len(ids))))
                for a in range(0, len(q), step):
                    row, found, score, _ = nearest_of_block(q_ids[a:a + step], q[a:a + step], ids, vecs, code, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[a + row]), pa.array(found), pa.array(score),
                         pa.array(np.full(len(row), j, np.int32))], names=["query_id", "vec_id", "score", "j"])

    names = ["dims", "j", "q_ids", "q", "ids", "vectors", "centroid", "codes", "lengths", "shares"]
    lists = (left.hint("merge").join(right, ["dims", "i", "j"]).select(*names)
             .mapInArrow(search, "query_id long, vec_id long, score double, j int"))
    while shards > FAN:
        lists = _top(lists.withColumn("j", (F.col("j") / FAN).cast("int")), ["j"], k).drop("rank")
        shards = -(-shards // FAN)
    return _top(lists, [], k).select("query_id", "rank", "vec_id", "score")
