"""Near-duplicate groups: fast similarity sketches, banding, exact verification, connected components.

A text is the set of its distinct 5-word shingles (words between white space, A-Z lower-cased). Texts with
the same set are one node. A node's fast similarity sketch has n numbers: in round i every shingle
is thrown into one place by the i-th hash and leaves (i, hash) there if that is smaller; rounds go on until
no place is empty, and from round n on round i throws everything into place i - n, so that
all places do fill. Two sketches agree in a place with probability equal to the sets' similarity, and the
share of agreeing places is as concentrated as for independent hashes, at the cost of a few rounds only.

Some places make a band; nodes with an equal band share a bucket. The threshold is a parameter, from which
the bands are derived (``Likeness``): at it two sets share no bucket with probability MISS at most. At
similarity 0.85 that are 28 bands of 6 places, at 0.80 34 bands of 5. Links are confirmed on the full sets, in two
steps that never pair up a whole bucket:

1. Every bucket has a pivot, the member that shares buckets with most others. Its pairs with the other
   members are verified, and the links give preliminary components.
2. Buckets that still hold several components are searched in tiles of two blocks of members, of which one at
   least lies outside the bucket's largest component. Pairs of different components whose sketches agree well enough, each in one of its buckets, are verified where the
   tile's texts have been brought together, so that a text travels once for a tile and not for each pair.

A pair inside one component needs no test: its link would change nothing.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from gridlake.cluster import stage_table
from gridlake.llm.shared import blocks, mix, word_hashes, words

SHINGLE_WORDS = 5
PERCENT = 85               # link from 100 * intersection >= PERCENT * union on, unless told otherwise
MISS = 2e-6                # probability that a pair at the threshold shares no band, at most
MOST_PLACES = 176          # of a sketch
SALT_ROWS = 512            # members of a bucket that meet what is known of it in one place, about
BLOCK_NODES = 128          # a tile compares so many members of a bucket with as many others, about

_SHINGLE = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
_ROUND = mix(np.arange(1000, 1000 + 2 * MOST_PLACES, dtype=np.uint64))
_BAND = mix(np.arange(5000, 5000 + MOST_PLACES, dtype=np.uint64))
_ROW = mix(np.arange(7000, 7000 + MOST_PLACES, dtype=np.uint64)) | np.uint64(1)


@dataclass(frozen=True)
class Likeness:
    """The similarity in per cent from which on texts are linked, and the sketch that finds such pairs."""

    percent: int = PERCENT

    def __post_init__(self):
        if not 10 <= self.percent <= 100:
            raise ValueError(f"percent must lie between 10 and 100, not {self.percent}")

    @functools.cached_property
    def shape(self) -> tuple[int, int]:
        """(bands, rows): the longest bands of which as many as MISS asks for make MOST_PLACES at most."""
        for rows in range(MOST_PLACES, 0, -1):
            apart = 1 - (self.percent / 100) ** rows
            bands = math.ceil(math.log(MISS) / math.log(apart)) if 0 < apart < 1 else (1 if apart == 0 else MOST_PLACES + 1)
            if bands * rows <= MOST_PLACES:
                return bands, rows
        raise AssertionError(self.percent)

    @functools.cached_property
    def places(self) -> int:
        return self.shape[0] * self.shape[1]

    @functools.cached_property
    def least_agree(self) -> int:
        """Six deviations below the mean number of places in which sketches of a pair at the threshold agree."""
        share = self.percent / 100
        return int(self.places * (share - 6 * math.sqrt(share * (1 - share) / self.places)))


_EMPTY = np.uint64((1 << 64) - 1)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a block's texts, one after another, and each text's bounds."""
    starts, ends, first = words(data, off)
    h = word_hashes(data, starts, ends)
    n = len(h)
    s = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        s[:n - k] += h[k:] * _SHINGLE[k]
    s = mix(s)
    sets, bounds = [], np.zeros(len(off), np.int64)
    for k in range(len(off) - 1):
        a, b = first[k], first[k + 1]
        if b - a >= SHINGLE_WORDS:
            own = np.sort(s[a:b - SHINGLE_WORDS + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = mix((h[a:b] * _SHINGLE[:b - a]).sum(keepdims=True) ^ np.uint64(b - a))
        else:
            own = h[:0]
        sets.append(own)
        bounds[k + 1] = bounds[k] + len(own)
    return (np.concatenate(sets) if sets else h[:0]), bounds


def sketch(values: np.ndarray, bounds: np.ndarray, size: int = Likeness().places) -> np.ndarray:
    """Fast similarity sketch of each set; a row of all-ones for an empty set."""
    n = len(bounds) - 1
    out = np.full(n * size, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    x = values
    for i in range(2 * size):
        if not len(x):
            break
        h = mix(x ^ _ROUND[i])
        value = (np.uint64(i) << np.uint64(54)) | (h & np.uint64((1 << 54) - 1))
        if i < size:
            place = (((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        else:
            place = i - size
        np.minimum.at(out, owner * size + place, value)
        open_ = (out.reshape(n, size) == _EMPTY).any(axis=1)
        stay = open_[owner]
        if not stay.all():
            x, owner = x[stay], owner[stay]
    return out.reshape(n, size)


def band_hashes(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band and sketch, different between bands."""
    parts = sketches.reshape(len(sketches), bands, rows)
    return mix((mix(parts) * _ROW[:rows]).sum(axis=2) ^ _BAND[:bands])


def _sketch_batches(batches: Iterator[pa.RecordBatch], like: Likeness = Likeness()) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in blocks(batch.column(1)):
            values, bounds = shingle_sets(data, off)
            got = sketch(values, bounds, like.places)
            size = np.diff(bounds)
            sums = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(mix(values), out=sums[0, 1:])
            np.cumsum(mix(values ^ _ROUND[0]), out=sums[1, 1:])
            prints = (sums[:, bounds[1:]] - sums[:, bounds[:-1]]).view(np.int64)
            bands = band_hashes(got, *like.shape).view(np.int64).ravel()
            marks = mix(got).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(size), pa.array(prints[0]), pa.array(prints[1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(bands) + 1, like.shape[0], dtype=np.int32)), pa.array(bands)),
                 pa.array([m.tobytes() for m in marks], pa.binary())],
                names=["id", "n", "print_a", "print_b", "bands", "marks"])


def _agree(a: pa.Array, b: pa.Array, places: int) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, places) for v in (a, b))
    return (x == y).sum(axis=1)


def sketches_agree(like: Likeness, one: str, two: str) -> Column:
    @F.arrow_udf(BooleanType())
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(_agree(a, b, like.places) >= like.least_agree)

    return agree(one, two)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are at least ``percent`` alike."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def texts_linked(like: Likeness, one: str, two: str) -> Column:
    """Exact check on the full shingle sets of two texts."""
    @F.arrow_udf(BooleanType())
    def check(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(a), 256):
            sides = []
            for arr in (a.slice(k, 256), b.slice(k, 256)):
                mine = []
                for _, _, data, off in blocks(arr):
                    values, bounds = shingle_sets(data, off)
                    mine += [values[p:q] for p, q in zip(bounds[:-1], bounds[1:])]
                sides.append(mine)
            out += [linked(x, y, like.percent) for x, y in zip(*sides)]
        return pa.array(out, pa.bool_())

    return check(one, two)


def _verified(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are linked; ``texts`` has (node, text)."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.hint("merge").join(one, "a").hint("merge").join(two, "b").filter(
        texts_linked(like, "text_a", "text_b")).select("a", "b")


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of the runs with equal ``key``) with whole runs only; rows come sorted by the key."""
    rest: pa.Table | None = None

    def bounds_of(t: pa.Table) -> np.ndarray:
        k = np.stack([t.column(c).to_numpy() for c in key])
        return np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [t.num_rows]]).astype(np.int64)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        bounds = bounds_of(t)
        rest = t.slice(bounds[-2])
        if len(bounds) > 2:
            yield t.slice(0, bounds[-2]).combine_chunks(), bounds[:-1]
    if rest is not None:
        yield rest.combine_chunks(), bounds_of(rest)


_TILE = ("bucket", "i", "j")


def _close_in_tiles(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    """Each tile's members that have a close one of another component in it, with those after them.

    A pair is given in one of the buckets it shares, the one with the least hash.
    """
    for t, bounds in _runs(batches, _TILE):
        bucket, i, j = (t.column(c).to_numpy() for c in _TILE)
        node, label, block = (t.column(c).to_numpy() for c in ("node", "label", "block"))
        marks = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint8).reshape(-1, like.places)
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, like.shape[0])
        at, partners = [], []
        for p, q in zip(bounds[:-1], bounds[1:]):
            met: dict[int, list[int]] = {}
            for r in range(p, q - 1):
                other = np.flatnonzero(label[r + 1:q] != label[r]) + r + 1
                if i[p] != j[p]:
                    other = other[block[other] != block[r]]
                if not len(other):
                    continue
                other = other[(marks[other] == marks[r]).sum(axis=1) >= like.least_agree]
                if len(other):
                    common = np.where(bands[other] == bands[r], bands[other], np.iinfo(np.int64).max).min(axis=1)
                    other = other[common == bucket[p]]
                if len(other):
                    met[r] = node[other].tolist()
                    for o in other.tolist():
                        met.setdefault(o, [])
            at += met
            partners += met.values()
        rows = np.array(at, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v[rows]) for v in (bucket, i, j, node, label)] + [pa.array(partners, pa.list_(pa.int64()))],
            names=[*_TILE, "node", "label", "partners"])


def _linked_in_tiles(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a tile that join components; a pair that earlier links have joined is not tested."""
    for t, bounds in _runs(batches, _TILE):
        node, label = t.column("node").to_numpy(), t.column("label").to_numpy()
        partners = t.column("partners").to_pylist()
        texts = t.column("text").combine_chunks()
        found = []
        for p, q in zip(bounds[:-1], bounds[1:]):
            sets = []
            for _, _, data, off in blocks(texts.slice(p, q - p)):
                values, cut = shingle_sets(data, off)
                sets += [values[x:y] for x, y in zip(cut[:-1], cut[1:])]
            place = {n: k for k, n in enumerate(node[p:q].tolist())}
            up = {x: x for x in label[p:q].tolist()}

            def top(x: int) -> int:
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            for k, mine in enumerate(partners[p:q]):
                for n in mine:
                    x, y = top(int(label[p + k])), top(int(label[p + place[n]]))
                    if x != y and linked(sets[k], sets[place[n]], like.percent):
                        up[max(x, y)] = min(x, y)
                        found.append((int(node[p + k]), n))
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) with the smallest node reachable, for every node of ``links`` (a, b).

    Alternating large-star and small-star rounds: each node points its larger neighbours, then its smaller
    ones, to the least neighbour, until nothing changes. Every round is written to the shared folder.
    """
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "near-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stage_table(
            small.select(F.col("u"), F.col("m").alias("v"))
            .unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(),
            "near-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def _labelled(nodes: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``nodes`` with ``label``: that of ``labels``, else the node itself."""
    return nodes.join(labels.withColumnRenamed("node", column), column, "left").withColumn(
        "label", F.coalesce("label", F.col(column)))


def _salted(rows: DataFrame) -> DataFrame:
    """Rows (bucket, size, node) with ``salt``: a bucket has one for every SALT_ROWS members, about."""
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SALT_ROWS)))


def _for_salts(buckets: DataFrame) -> DataFrame:
    """Rows (bucket, size) once for each salt of the bucket."""
    return buckets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / SALT_ROWS) - 1)))


def _links_between(shared: DataFrame, nodes: DataFrame, texts: DataFrame, labels: DataFrame, like: Likeness) -> DataFrame:
    """All links (a, b) that are needed to join the components of nodes that share buckets."""
    known = _labelled(shared, labels, "node")
    counts = known.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("bucket").agg(
        F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("most"), F.sum("n").alias("size"), F.count("*").alias("labels"),
    ).filter("labels > 1")
    # The largest component of a bucket is compared with the others, not with itself.
    tiles = lambda n: F.ceil(n / BLOCK_NODES).cast("int")                                 # noqa: E731
    mixed = _for_salts(mixed).select("bucket", "salt", (-F.col("most.minus")).alias("largest"), tiles(F.col("most.n")).alias("inner"),
                                     tiles(F.col("size") - F.col("most.n")).alias("outer"))
    largest = F.col("label") == F.col("largest")
    spread = lambda n: F.pmod(F.xxhash64("node"), n.cast("long")).cast("int")             # noqa: E731
    members = (_salted(known).join(mixed, ["bucket", "salt"])
               .withColumn("block", F.when(largest, F.col("outer") + spread(F.col("inner"))).otherwise(spread(F.col("outer"))))
               .join(nodes.select("node", "bands", "marks"), "node")
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(largest, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)))
               .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                       "block", "node", "label", "bands", "marks"))
    close = members.repartition(*_TILE).sortWithinPartitions(*_TILE).mapInArrow(
        functools.partial(_close_in_tiles, like=like), "bucket long, i int, j int, node long, label long, partners array<long>")
    return (stage_table(close, "near-close").hint("merge").join(texts, "node")
            .repartition(*_TILE).sortWithinPartitions(*_TILE)
            .select(*_TILE, "node", "label", "partners", "text").mapInArrow(
                functools.partial(_linked_in_tiles, like=like), "a long, b long"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links between nodes, as (node, label); nodes without a label have their own."""
    ends = links
    for side in ("a", "b"):
        ends = _labelled(ends, labels, side).drop(side).withColumnRenamed("label", side)
    upper = components(ends).toDF("low", "label")
    low = labels.toDF("node", "low").unionByName(upper.select(F.col("low").alias("node"), "low")).distinct()
    return stage_table(_labelled(low, upper, "low").select("node", "label").groupBy("node").agg(
        F.min("label").alias("label")), "near-labels")


def find_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the smallest id that links lead to.

    Texts are linked whose sets are ``percent`` alike or more.

    The id must be an integer and is taken as unique; repeated rows (equal id and text) get equal results.
    Texts without words, null ones included, have n_shingles 0 and are linked with nothing. Rows with a null
    id stay out of all groups: their component is null and they are kept.
    """
    like = Likeness(percent)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = stage_table(rows.mapInArrow(
        functools.partial(_sketch_batches, like=like), "id long, n long, print_a long, print_b long, bands array<long>, marks binary"), "near-sketches")
    same = ["print_a", "print_b", "n"]
    nodes = stage_table(sketches.filter("n > 0 and id is not null").groupBy(*same).agg(
        F.min("id").alias("node"), F.first("bands").alias("bands"), F.first("marks").alias("marks")), "near-nodes")

    member = nodes.select("node", F.explode("bands").alias("bucket"))
    full = stage_table(member.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "near-sizes")
    shared = stage_table(member.join(full, "bucket"), "near-buckets")
    needed = shared.select("node").distinct()
    texts = rows.join(needed.hint("merge"), rows["id"] == needed["node"]).select("node", "text")
    if _repeats(sketches):
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    texts = stage_table(texts, "near-texts")
    marks = nodes.select("node", "marks")

    weight = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    pivots = shared.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("best"), F.max("size").alias("size"))
    star = _salted(shared).join(_for_salts(pivots).drop("size"), ["bucket", "salt"]).select("node", (-F.col("best.minus")).alias("pivot")).filter("node <> pivot")
    star = star.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    likely = stage_table(star.join(marks.toDF("a", "marks_a"), "a").join(marks.toDF("b", "marks_b"), "b").filter(
        sketches_agree(like, "marks_a", "marks_b")).select("a", "b"), "near-pairs")
    labels = components(_verified(likely, texts, like))
    labels = _joined(labels, _links_between(shared, nodes, texts, labels, like))

    group = _labelled(nodes.select(*same, "node"), labels, "node").select(*same, F.col("label").alias("component"))
    row = sketches.select("id", *same)
    out = row.filter("n > 0").join(group, same, "left").unionByName(
        row.filter("n = 0").withColumn("component", F.lit(None).cast("long")))
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.coalesce("component", "id"))).alias("kept"))


def _repeats(sketches: DataFrame) -> bool:
    """Whether any id occurs more than once."""
    return bool(sketches.filter("id is not null").groupBy("id").count().filter("count > 1").limit(1).count())


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id. Rows with a null id all stay."""
    groups = stage_table(find_groups(docs, text, doc_id, percent), "near-groups")
    gone = groups.filter(~F.col("kept")).select(F.col(doc_id).alias("_gone")).distinct()
    left = docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
    if groups.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).count().filter("count > 1").limit(1).count():
        named = left.filter(F.col(doc_id).isNotNull()).dropDuplicates([doc_id])
        left = named.unionByName(left.filter(F.col(doc_id).isNull()))
    return left
