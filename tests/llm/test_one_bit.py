import numpy as np
from pyspark.sql import functions as F

from gridlake.llm import one_bit

SHAPE = "vec_id long, embedding array<float>, rank int, score double"


def brute(rows, k=20):
    good = [(i, np.array(e, np.float32).astype(float)) for i, e in rows
            if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    out = {}
    for q, a in good:
        if q % 20 == 0:
            out.setdefault(q, []).extend((-float(a @ b), i) for i, b in good if i != q and len(a) == len(b))
    return {q: [(i, -s) for s, i in sorted(found)[:k]] for q, found in out.items()}


def found(spark, rows, k=20):
    df = spark.createDataFrame([(i, e, 1, 2.0) for i, e in rows], SHAPE).repartition(4)
    got = one_bit.nearest(df, F.col("vec_id") % 20 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in sorted(tuple(r) for r in got.collect()):
        out.setdefault(r[0], []).append(r[1:])
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in v] for q, v in out.items()}


def recall(got, want):
    return (sum(len({i for i, _ in got[q]} & {i for i, _ in found}) for q, found in want.items())
            / sum(map(len, want.values())))


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(one_bit, "LEAST_ROWS", 500)
    monkeypatch.setattr(one_bit, "FAN", 2)                       # a tree of several levels
    r = np.random.default_rng(5)
    x = r.standard_normal((6000, 64)) + 0.3
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7000 + i, x[7].tolist()) for i in range(900)]
    got, want = found(spark, rows), brute(rows)
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in got)
    assert recall(got, want) >= 0.98
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, list_ in got.items():
        assert all(abs(s - exact[q] @ exact[i]) < 1e-12 for i, s in list_)
        assert list_ == sorted(list_, key=lambda p: (-p[1], p[0]))


def test_bounds_hold_and_spare_work():
    r = np.random.default_rng(1)
    x, q = r.standard_normal((20_000, 64)), r.standard_normal((50, 64))
    coded = one_bit.encode(x)
    guess, error = one_bit.estimate(q, *coded)
    assert (np.abs(guess - q @ x.T) > error).mean() < 0.02
    assert coded[1].nbytes * 16 == x.nbytes
    *_, tried = one_bit.nearest_of_block(np.arange(50) - 50, q, np.arange(20_000), x, coded, 20)
    assert tried < 0.1 * 50 * 20_000


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (20, [1.0, -1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0]),
            (40, [2.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [0.5, 0.5]), (60, []), (11, []),
            (80, [0.0, 0.0]), (12, [0.0, 0.0])]
    got, want = found(spark, rows), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert found(spark, []) == {}
    assert found(spark, [(0, [1.0])]) == {}
    assert [i for i, _ in found(spark, [(0, [1.0]), (2, [3.0]), (1, [3.0]), (5, [-1.0])], 2)[0]] == [1, 2]
