import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridlake.llm import ball_tree
from tests.llm.samples import invented

TERMS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            if bag and i is not None:
                m = 100 - 75 + 75 * sum(bag.values()) * n_docs // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in terms(text))
                scores += [(-s, i)] if s > 0 else []
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, item_id string, score int").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    got = ball_tree.search(d, b, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("at_once", [2000, 7])
def test_against_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(ball_tree, "ITEMS_AT_ONCE", at_once)
    r = random.Random(2)
    docs = [(i, invented(i, r.randint(1, 120))) for i in range(700)]
    docs += [(1000 + i, docs[i % 5][1].upper() + " Été.x") for i in range(150)]        # copies, ties
    items = [(f"q{i}", docs[i * 30][1][:200] + " ra ra unheard") for i in range(20)] + [("e", "Ra. to,mi É été")]
    assert found(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "alpha Beta"), (5, "alpha beta"), (5, "alpha beta"), (None, "alpha"),
            (6, "gamma\x7falpha_7"), (7, "alpha " * 40_000), (8, "日本 alpha")]
    items = [("a", "ALPHA alpha"), ("b", None), ("c", ""), ("d", "nowhere"), (None, "gamma 7"), ("j", "日本"), ("a", "beta")]
    assert found(spark, docs, items, 3) == brute(docs, items, 3)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []


def test_bounds_prune_and_lose_nothing():
    r = np.random.default_rng(3)
    rows = [np.unique(r.integers(0, 40, 12) + 40 * (i % 8)) for i in range(2000)]
    ptr = np.cumsum([0] + [len(x) for x in rows])
    idx, val = np.concatenate(rows), r.integers(1, 10 ** 9, ptr[-1])
    dense = np.zeros((2000, 320), np.int64)
    dense[np.repeat(np.arange(2000), np.diff(ptr)), idx] = val
    tree = ball_tree.Tree(np.arange(2000), ptr.copy(), idx.copy(), val.copy(), 320)
    for i in range(len(tree.low)):
        inside = dense[tree.ids[tree.low[i]:tree.high[i]]]
        assert (np.linalg.norm(inside - tree.centroids[i], axis=1) <= tree.radius[i]).all()
        assert (inside <= tree.largest[i]).all()
    q = np.arange(10)
    (scores, ids), scored = tree.search(q, np.ones(10, np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 10)
    all_ = dense[:, q].sum(axis=1)
    order = np.lexsort((np.arange(2000), -all_))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == all_[order].tolist()
    assert scored < 500
