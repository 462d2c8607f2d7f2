import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import near_dedup as nd
from llm.samples import invented

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def edited(text, n, seed):
    w, r = text.split(), random.Random(seed)
    for _ in range(n):
        w[r.randrange(len(w))] = invented(r.random(), 1)
    return " ".join(w)


def groups(spark, docs, rows):
    got = nd.find_groups(docs(rows)).collect()
    assert len(got) == len(rows)
    assert got == [] or got[0].asDict().keys() == {"doc_id", "n_shingles", "component_id", "kept"}
    return got


def family(base, count, first, most):
    text = invented(base, 150)
    return [(first + k, edited(text, k % most, (base, k).__hash__()), "en", "s") for k in range(count)]


def test_families_chains_and_edges(spark, docs):
    rows = family(1, 40, 100, 6) + family(2, 30, 300, 9) + [(k, invented(k, 80 + k % 60), "en", "s") for k in range(500, 560)]
    chain = [invented(77, 200)]
    for k in range(8):
        chain.append(edited(chain[-1], 2, k))
    rows += [(700 - k, t, "en", "s") for k, t in enumerate(chain)]
    rows += [(1, None, "", ""), (2, "", "", ""), (3, " \t\n", "", ""), (4, "one two", "", ""), (5, "One TWO", "", ""), (6, "one two three", "", ""),
             (7, "É b c d e f", "", ""), (8, "é b c d e f", "", ""), (9, "a a a a a a a a a", "", ""), (10, "a a a a a", "", ""),
             (11, invented(5, 20_000), "", ""), (12, edited(invented(5, 20_000), 300, 1), "", "")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in groups(spark, docs, rows)}
    want = brute(rows)
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_large_group_in_several_tiles(spark, docs, monkeypatch):
    """Near copies that the pivot alone does not join: every tile of a bucket has to be searched."""
    monkeypatch.setattr(nd, "BLOCK_NODES", 8)
    rows = family(4, 90, 0, 8) + [(1000 + k, invented(4, 150), "en", "s") for k in range(50)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in groups(spark, docs, rows)}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_the_filter(spark, docs):
    text = invented(8, 60)
    rows = [(5, text, "en", "s"), (5, text, "en", "s"), (9, text, "en", "s"), (None, text, "en", "s"), (7, "other words here", "en", "s")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in groups(spark, docs, rows)), key=repr)
    assert got == sorted([(5, 5, True), (5, 5, True), (9, 5, False), (None, None, True), (7, 7, True)], key=repr)
    left = nd.drop_near_copies(docs(rows))
    assert left.columns == docs(rows).columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == [5, 7, None]


def test_empty_table(spark, docs):
    assert groups(spark, docs, []) == []
    assert nd.drop_near_copies(docs([])).collect() == []


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85])
def test_sketches_estimate_similarity(share):
    r = np.random.default_rng(1)
    pairs, sizes = [], [1, 2, 7, 40, 300, 3000]
    for n in sizes * 20:
        both = int(round(n * 2 * share / (1 + share)))
        x = r.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        pairs.append((np.sort(x[:n]), np.sort(x[n - both:])))
    flat = [s for p in pairs for s in p]
    bounds = np.cumsum([0] + [len(s) for s in flat])
    got = nd.sketch(np.concatenate(flat), bounds)
    assert (got != nd._EMPTY).all()                                  # every place is filled
    agree = (got[::2] == got[1::2]).mean(axis=1)
    true = np.array([len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in pairs])
    assert np.abs(agree - true).mean() < 0.04 and np.abs(agree - true).max() < 0.2


def test_blocks_do_not_matter():
    texts = pa.array([invented(k, 50) for k in range(9)] + [None, ""])
    batch = pa.RecordBatch.from_arrays([pa.array(range(11), pa.int64()), texts], names=["id", "text"])
    whole = pa.Table.from_batches(nd._sketch_batches([batch])).to_pylist()
    single = [r for k in range(11) for r in pa.Table.from_batches(nd._sketch_batches([batch.slice(k, 1)])).to_pylist()]
    assert whole == single


def test_percent_is_a_parameter(spark, docs):
    """Against brute force at 80, on pairs of every likeness from 0.7 on."""
    rows = []
    for k in range(60):
        text = invented(3000 + k, 200)
        rows += [(10 * k, text, "en", "s"), (10 * k + 1, edited(text, k % 9, k), "en", "s")]
    shares = [len(shingles(rows[k][1]) & shingles(rows[k + 1][1])) / len(shingles(rows[k][1]) | shingles(rows[k + 1][1]))
              for k in range(0, len(rows), 2)]
    between = sum(0.8 <= v < 0.85 for v in shares)
    apart = sum(v < 0.8 for v in shares)
    assert between >= 5 and apart >= 5
    left = {p: {r["doc_id"] for r in nd.drop_near_copies(docs(rows), percent=p).collect()} for p in (80, 85)}
    assert len(left[80]) == 60 + apart and len(left[85]) == 60 + apart + between and left[80] < left[85]


def test_bands_follow_from_the_percentage():
    assert nd.Likeness(85).shape == (28, 6) and nd.Likeness(85).least_agree == 115
    for percent in range(10, 101):
        like = nd.Likeness(percent)
        bands, rows = like.shape
        assert (1 - (percent / 100) ** rows) ** bands <= nd.MISS and like.places <= nd.MOST_PLACES
        assert like.least_agree < percent / 100 * like.places or percent == 100


def test_a_hot_bucket_of_two_components_makes_few_copies(spark):
    # 20,000 nodes share a bucket; all but three are known to belong together.
    n = 20_000
    shared = spark.range(n).select(F.col("id").alias("node"), F.lit(7).cast("long").alias("bucket"), F.lit(n).cast("long").alias("size"))
    labels = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") < 3, F.lit(0)).otherwise(F.lit(3)).cast("long").alias("label"))
    like = nd.Likeness()
    nodes = spark.range(n).select(F.col("id").alias("node"), F.array_repeat(F.lit(7).cast("long"), like.shape[0]).alias("bands"),
                                  F.expr(f"cast(repeat(chr(int(id % 90 + 33)), {like.places}) as binary)").alias("marks"))
    texts = spark.range(n).select(F.col("id").alias("node"), F.concat(F.lit("one two three four five six "), (F.col("id") % 90).cast("string")).alias("text"))
    copies = []
    plain = type(shared).mapInArrow

    def counted(self, *args, **kwargs):
        if "marks" in self.columns:
            copies.append(self.count())
        return plain(self, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(shared), "mapInArrow", counted)
        nd._links_between(shared, nodes, texts, labels, like).count()
    # Each of the many goes to one tile, the three to as many as there are blocks: not 20,000 x 79.
    assert copies and copies[0] <= n + 3 * (n // nd.BLOCK_NODES + 2)
    salted = nd._salted(shared).groupBy("bucket", "salt").count()
    assert salted.agg(F.max("count")).first()[0] < 2 * nd.SALT_ROWS
