"""Ranked lexical search: exact inner products of sparse vectors by ball trees.

One pass over the whole texts counts, for each document, all its terms and those that occur in a benchmark item;
the counts are written as narrow rows. From these come the corpus statistics (documents with terms, all terms,
documents a term) and with them each document's vector: a whole number for each term. An item is a vector too,
of its terms' counts, and a document's score is their inner product.

Runs of documents become ball trees: a node has a centroid c, a radius r that no document of it exceeds, and the
like for each term's own axis, c_t + r_t, the term's largest number below the node. So no score below it exceeds
q.c + |q| r, nor the sum of q_t (c_t + r_t); the smaller is its bound. In long sparse vectors the first prunes
little, as its radius holds all terms that the item does not ask for; the second asks only for the item's. Radius
and bound are rounded upward by more than any error of floating sums (the second is a whole number), so a subtree
is left out only if it cannot hold one of the item's k best. A tree is searched best-first;
documents at the leaves are scored in 64-bit integers. What an item has found so far is carried from tree to
tree of a task, which gives k rows an item; these lists are merged in two steps.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.cluster import stage_table
from gridlake.llm.shared import LOWER, blocks, word_hashes, words

ITEMS_AT_ONCE = 2000               # items whose terms are looked up in one pass over the texts
TREE_DOCS, TREE_TERMS = 8192, 2_000_000
LEAF_DOCS = 24
CENTROID_BYTES = 64 << 20          # of a tree's centroids and largest numbers
LISTS = 64                         # lists that a task's results are merged into first

# Bytes of terms: all but 00-2F, 3A-40, 5B-60 and 7B-7F, that is digits, letters and what lies beyond ASCII.
TERM = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    TERM[_low:_high + 1] = False

COUNTS = "doc_id {kind}, n long, terms array<int>, counts array<int>"


class Vocabulary:
    """The terms of a block of items, found by hash and then compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        starts = ends - [len(t) for t in terms]
        hashes = word_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        if (np.diff(hashes[order]) == 0).any():
            raise ValueError("two terms of the items have one hash")
        self.order, self.hashes, self.data, self.starts, self.ends = order, hashes[order], data, starts, ends

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, terms) of the words that are terms."""
        if not len(self.order) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        term = self.order[at]
        size = ends - starts
        place = np.flatnonzero((self.hashes[at] == h) & (self.ends[term] - self.starts[term] == size))
        term, size = term[place], size[place]
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        same = LOWER[data[np.repeat(starts[place], size) + step]] == self.data[np.repeat(self.starts[term], size) + step]
        right = np.logical_and.reduceat(same, first) if len(first) else np.zeros(0, bool)
        return place[right], term[right]


def split_terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts, ends, first term of each text) of runs of whole texts."""
    for i, j, data, off in blocks(texts):
        starts, ends, first = words(data, off, TERM)
        yield i, j, data, starts, ends, first


def count_terms(docs: DataFrame, vocabulary: Vocabulary, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts): each document's number of terms, and how often it holds which of the vocabulary."""
    size = max(1, len(vocabulary.order))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, starts, ends, first in split_terms(batch.column(1)):
                place, term = vocabulary.find(data, starts, ends)
                row = np.searchsorted(first, place, "right") - 1
                key, times = np.unique(row * size + term, return_counts=True)
                bounds = np.searchsorted(key, np.arange(j - i + 1) * size).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(bounds, (key % size).astype(np.int32)),
                    pa.ListArray.from_arrays(bounds, times.astype(np.int32))], names=["doc_id", "n", "terms", "counts"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(count, COUNTS.format(kind=kind))


class Tree:
    """A ball tree over rows of whole numbers (``ptr``, ``idx``, ``val``), none of them empty."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, idx: np.ndarray, val: np.ndarray, dims: int):
        self.dims, leaf = dims, max(LEAF_DOCS, -(-len(ids) * dims * 32 // CENTROID_BYTES))
        self.ids, self.ptr, self.idx, self.val = ids, ptr, idx, val
        self.low, self.high, self.child, centroids, largest, self.radius = [], [], [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.low)
            if parent is not None:
                self.child[parent].append(node)
            p = self.ptr[low:high + 1]
            terms, numbers, starts = self.idx[p[0]:p[-1]], self.val[p[0]:p[-1]].astype(np.float64), p[:-1] - p[0]
            c = np.bincount(terms, numbers, dims) / (high - low)
            square = np.add.reduceat(numbers * numbers, starts)
            away = square - 2 * np.add.reduceat(numbers * c[terms], starts) + c @ c
            slack = 1e-10 * (square + c @ c)               # more than the sums' rounding errors
            self.low.append(low)
            self.high.append(high)
            self.child.append([])
            centroids.append(c)
            largest.append(np.zeros(dims, np.int64))
            np.maximum.at(largest[-1], terms, self.val[p[0]:p[-1]])
            self.radius.append(math.sqrt(np.max(np.maximum(away, 0) + slack)))
            if high - low > leaf:
                a = self._dense(low + int(np.argmax(away)))
                to_a = square - 2 * np.add.reduceat(numbers * a[terms], starts)
                b = self._dense(low + int(np.argmax(to_a)))
                order = np.argsort(np.add.reduceat(numbers * (a - b)[terms], starts), kind="stable")
                self._arrange(low, high, order)
                middle = (low + high) // 2
                todo += [(low, middle, node), (middle, high, node)]
        self.centroids, self.largest, self.radius = np.array(centroids), np.array(largest), np.array(self.radius)

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.dims)
        out[self.idx[self.ptr[row]:self.ptr[row + 1]]] = self.val[self.ptr[row]:self.ptr[row + 1]]
        return out

    def _arrange(self, low: int, high: int, order: np.ndarray) -> None:
        p = self.ptr[low:high + 1]
        size = np.diff(p)[order]
        ends = np.cumsum(size)
        take = np.arange(p[0], p[-1]) - np.repeat(p[0] + ends - size, size) + np.repeat(p[:-1][order], size)
        self.idx[p[0]:p[-1]], self.val[p[0]:p[-1]] = self.idx[take], self.val[take]
        self.ids[low:high] = self.ids[low:high][order]
        self.ptr[low + 1:high + 1] = p[0] + ends

    def search(self, terms: np.ndarray, counts: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int
               ) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The k best (scores, ids) of ``best`` and the tree, and how many documents were scored."""
        bound = self.centroids[:, terms] @ counts + math.sqrt(float(counts @ counts)) * self.radius
        bound = bound * (1 + 1e-9) + 1                     # upward, by more than any rounding error
        bound = np.minimum(bound, self.largest[:, terms] @ counts)
        q = np.zeros(self.dims, np.int64)
        q[terms] = counts
        scores, ids = best
        floor, scored = (scores[-1] if len(scores) == k else 1), 0
        heap = [(-bound[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            if -b < floor:
                break
            for child in self.child[node]:
                heapq.heappush(heap, (-bound[child], child))
            if not self.child[node]:
                low, high = self.low[node], self.high[node]
                p = self.ptr[low:high + 1]
                score = np.add.reduceat(q[self.idx[p[0]:p[-1]]] * self.val[p[0]:p[-1]], p[:-1] - p[0])
                scored += high - low
                good = np.flatnonzero(score >= floor)
                if len(good):
                    scores, ids = np.concatenate([scores, score[good]]), np.concatenate([ids, self.ids[low:high][good]])
                    order = np.lexsort((ids, -scores))[:k]
                    scores, ids = scores[order], ids[order]
                    floor = scores[-1] if len(scores) == k else 1
        return (scores, ids), scored


def _runs(terms: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows that make a tree each."""
    off = terms.offsets.to_numpy()
    i = 0
    while i < len(terms):
        j = min(len(terms), i + TREE_DOCS, max(i + 1, int(np.searchsorted(off, off[i] + TREE_TERMS, "right")) - 1))
        yield i, j
        i = j


def term_numbers(weights: np.ndarray, terms: np.ndarray, tf: np.ndarray, n: np.ndarray, total: int, with_terms: int) -> np.ndarray:
    """What a term adds to a document's score for each time an item holds it."""
    m = 25 + (75 * n * with_terms) // total
    return weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _search_block(docs: DataFrame, texts: list[str | None], k: int, doc_id: str, text: str) -> DataFrame:
    """(item, doc_id, score): the k best of each text, by its place in the list."""
    spark, index, items = docs.sparkSession, {}, []
    for _, _, data, starts, ends, first in split_terms(pa.array(texts, pa.string())):
        low = LOWER[data].tobytes()
        found = [index.setdefault(low[a:b], len(index)) for a, b in zip(starts, ends)]
        items += [np.unique(np.array(found[a:b], np.int64), return_counts=True) for a, b in itertools.pairwise(first)]
    vocabulary = Vocabulary(list(index))
    counted = stage_table(count_terms(docs, vocabulary, doc_id, text), "term-counts")
    n_docs, total = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = np.zeros(len(index), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        for batch in batches:
            for i, j in _runs(batch.column(2)):
                part = batch.slice(i, j - i)
                ptr = part.column(2).offsets.to_numpy().astype(np.int64)
                idx, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                ptr = ptr - ptr[0]
                n = np.repeat(part.column(1).to_numpy(), np.diff(ptr))
                tree = Tree(part.column(0).to_numpy().copy(), ptr, idx, term_numbers(weights, idx, tf, n, total, n_docs), len(index))
                for r, (terms, counts) in enumerate(items):
                    if len(terms):
                        best[r], _ = tree.search(terms, counts, best[r], k)
        rows = np.repeat(np.arange(len(items), dtype=np.int32), [len(s) for s, _ in best])
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate([d for _, d in best])),
                                              pa.array(np.concatenate([s for s, _ in best]))], names=["item", "doc_id", "score"])

    rows = counted.filter((F.size("terms") > 0) & F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
    lists = rows.mapInArrow(search, "item int, doc_id long, score long").withColumn("list", F.pmod(F.spark_partition_id(), F.lit(LISTS)))
    return _best(_best(lists, ["item", "list"], k).drop("rank", "list"), ["item"], k)


def _best(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0, equal ones by ascending id.

    A document without a term, or with null or empty text, is never found and counts for nothing. Every row is a
    document of its own, also if ids repeat; rows with a null id count in the statistics and are not listed.
    Every row of ``items`` is an item of its own; one without a term, or none that a document holds, has no
    rows. Empty tables give no rows. Other columns are not read, so they cannot clash. Items are taken in blocks
    of ITEMS_AT_ONCE, each a pass over the documents; blocks do not change results.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text"))
    shape = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", asked.schema["item_id"].dataType)])
    out = spark.createDataFrame([], T.StructType([shape["item_id"], *T.StructType.fromDDL("rank int, doc_id long, score long")]))
    every = asked.toLocalIterator()
    while block := list(itertools.islice(every, ITEMS_AT_ONCE)):
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(block)], shape)
        found = _search_block(docs, [row["item_text"] for row in block], k, doc_id, text)
        out = out.union(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
