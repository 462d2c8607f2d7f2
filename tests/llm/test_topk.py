import math
import random

from pyspark.sql import functions as F

from gridlake.llm import topk

SHAPE = "vec_id long, embedding array<float>, rank int, score long"


def brute(rows, k=5):
    good = [(i, tuple(math.floor(256 * x) for x in e)) for i, e in rows
            if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    found = {}
    for q, a in good:
        if q % 50 == 0:
            found.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
    return sorted((q, r + 1, i, -s) for q, all_ in found.items() for r, (s, i) in enumerate(sorted(all_)[:k]))


def top(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SHAPE).repartition(4)
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 6 * 20)       # many tiles, and a tree of two levels
    monkeypatch.setattr(topk, "FAN", 4)
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.25, 0.125, 0.3]) for _ in range(6)]) for i in range(420)]
    rows += [(500 + i, [0.25] * 6) for i in range(150)]       # one very common vector
    assert top(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(0, [0.1, 0.2]), (50, [1.0, -1.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
            (7, [1.0]), (100, [2.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [0.5, 0.5]), (150, []), (11, [])]
    assert top(spark, rows) == brute(rows)
    assert top(spark, []) == []
    assert top(spark, [(0, [1.0])]) == []


def test_scores_beyond_doubles(spark):
    rows = [(0, [1.0e7, 1.0]), (1, [1.0e7, 1.0]), (2, [1.0e7, 0.00390625])]
    assert top(spark, rows) == brute(rows)


def test_repeated_rows_are_candidates_each(spark, tmp_path):
    import duckdb

    from gridlake.llm.queries import ORACLES

    rows = [(50, [0.5, 0.5]), (1, [0.9, 0.9]), (1, [0.9, 0.9]), (2, [0.8, 0.7]), (100, [0.1, 0.2]), (100, [0.1, 0.2]), (3, [0.0, 0.0])]
    got = top(spark, rows)
    assert got == brute(rows)
    assert [i for q, _, i, _ in got if q == 50] == [1, 1, 2, 100, 100]
    spark.createDataFrame([(i, e, 0) for i, e in rows], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    assert sorted(con.execute(ORACLES["op4_top_k"]).fetchall()) == got
