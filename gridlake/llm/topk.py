"""Exact top-k inner products by tiles.

Queries and candidates are packed into blocks, one row of bytes each. A tile is one block of queries and one
of candidates: a matrix product, from which each query's k best candidates are kept. The lists of all tiles
are merged in a tree, FAN tiles at a time. Every query meets every candidate, in blocks.

With n candidates and q queries, n * q / (block rows) vectors travel for each side, so blocks are as large as
leaves every core a few tiles, up to BLOCK_BYTES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.cluster import stage_table

BLOCK_BYTES = 32 << 20     # of a block's numbers, eight bytes each
LEAST_ROWS = 512
TILES_PER_CORE = 4
FAN = 32
PRODUCT_ROWS = 512         # queries of a tile that are multiplied at once


def _pack(rows: DataFrame, scale: int) -> DataFrame:
    """(dims, block, ids, numbers) of rows (dims, block, id, numbers): a block's rows, as bytes; each number x
    becomes floor(scale * x)."""
    def pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        dims, n = key[0].as_py(), t.num_rows
        ids = t.column("id").to_numpy()
        flat = np.floor(scale * t.column("numbers").combine_chunks().flatten().to_numpy().reshape(n, dims))
        return pa.table({"dims": pa.array([dims], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "ids": pa.array([ids.tobytes()], pa.binary()),
                         "numbers": pa.array([flat.tobytes()], pa.binary())})

    return rows.groupBy("dims", "block").applyInArrow(pack, "dims int, block int, ids binary, numbers binary")


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64: in doubles where these hold all sums, else in Python's."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if bound < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.clip(whole(q) @ whole(c).T, low, high).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of each row's k largest scores, ties to the smaller id."""
    rows, out_ids, out_scores = [], [], []
    n = scores.shape[1]
    for r in range(len(scores)):
        s = scores[r]
        if n > k:
            least = s[np.argpartition(s, n - k)[n - k:]].min()
            at = np.flatnonzero(s >= least)
            at = at[np.lexsort((ids[at], -s[at]))][:k]
        else:
            at = np.lexsort((ids, -s))
        rows.append(np.full(len(at), r))
        out_ids.append(ids[at])
        out_scores.append(s[at])
    return np.concatenate(rows), np.concatenate(out_ids), np.concatenate(out_scores)


def most_repeated(ids: np.ndarray) -> int:
    """How often the most frequent id occurs: so many places a query's own id may take in a list."""
    return int(np.unique(ids, return_counts=True)[1].max(initial=0))


def _top(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy("query_id", *by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
                scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all rows for each row where ``queries`` holds.

    Components become floor(scale * x), x as double; the score is their inner product, a long (beyond its range
    the nearest long). A row is never found for its own id. Ties go to the smaller id. Vectors that are null or
    hold null or non-finite components take no part, nor do rows with a null id; vectors of another length than
    the query's are not compared with it. Every repeated row is a candidate; a repeated query's lists are ranked
    as one.
    """
    spark = vectors.sparkSession
    x = F.col(embedding).cast("array<double>")
    good = x.isNotNull() & F.col(vec_id).isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.filter(good).select(
        F.col(vec_id).cast("long").alias("id"), F.size(x).alias("dims"), queries.alias("asks"),
        x.alias("numbers"))
    size = rows.agg(F.count("*"), F.sum(F.col("asks").cast("int")), F.max("dims")).first()
    n, n_queries, dims = size[0], size[1] or 0, max(1, size[2] or 1)
    cores = spark.sparkContext.defaultParallelism
    most = max(1, BLOCK_BYTES // (8 * dims))
    tiles = max(1, TILES_PER_CORE * cores)
    query_blocks = max(1, -(-n_queries // most))
    shard_rows = min(most, max(LEAST_ROWS, -(-n * query_blocks // tiles)))
    shards = max(1, -(-n // shard_rows))
    spread = F.xxhash64("id", "numbers", F.monotonically_increasing_id())      # copies of a row go to all blocks
    block = lambda count: F.pmod(spread, F.lit(count)).cast("int")                    # noqa: E731
    ask = stage_table(_pack(rows.filter("asks").withColumn("block", block(query_blocks)).drop("asks"), scale), "top-queries")
    all_ = stage_table(_pack(rows.withColumn("block", block(shards)).drop("asks"), scale), "top-shards")
    left = ask.withColumnRenamed("block", "i").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = all_.toDF("dims", "j", "other_ids", "other_numbers").withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dims, shard, q_ids, q, c_ids, c = (batch.column(i)[r].as_py() for i in range(6))
                q_ids, c_ids = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                q, c = (np.frombuffer(v, np.float64).reshape(-1, dims) if dims else np.zeros((len(w), 0))
                        for v, w in ((q, q_ids), (c, c_ids)))
                for a in range(0, len(q_ids), PRODUCT_ROWS):
                    scores = _products(q[a:a + PRODUCT_ROWS], c)
                    row, ids, s = _best(scores, c_ids, k + most_repeated(c_ids))
                    own = q_ids[a + row]
                    ok = own != ids
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[ok]), pa.array(ids[ok]), pa.array(s[ok]),
                         pa.array(np.full(ok.sum(), shard, np.int32))], names=["query_id", "vec_id", "score", "j"])

    lists = (left.hint("merge").join(right, ["dims", "i", "j"]).select("dims", "j", "ids", "numbers", "other_ids", "other_numbers")
             .mapInArrow(tile, "query_id long, vec_id long, score long, j int"))
    while shards > FAN:
        lists = _top(lists.withColumn("j", (F.col("j") / FAN).cast("int")), ["j"], k).drop("rank")
        shards = -(-shards // FAN)
    return _top(lists, [], k).select("query_id", "rank", "vec_id", "score")
