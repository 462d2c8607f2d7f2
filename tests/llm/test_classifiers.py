import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridlake.llm import quality, toxicity
from llm.samples import invented


def junk(k):
    w = invented(k, 40).split()
    return [" | ".join(w), " ".join(x + "###" for x in w), " ".join(w[k % 9] for _ in range(60))][k % 3]


def labelled(spark, marks, name):
    return spark.createDataFrame([(i, m, "z") for i, m in marks], f"doc_id long, {name} int, text string")


def quality_rows():
    return [(k, junk(k) if k % 4 == 0 else ". ".join(invented(k * 7 + j, 12).capitalize() for j in range(5)) + ".", "en", "s")
            for k in range(400)] + [(900, None, "en", "s"), (901, "", "en", "s"), (902, junk(4) * 500, "en", "s"), (None, "a b", "en", "s")]


def test_quality_on_held_out_texts(spark, docs):
    rows = quality_rows()
    marks = labelled(spark, [(i, int(i % 4 != 0)) for i, *_ in rows if i is not None and i < 300] + [(5, 1), (6, None)], "quality")
    learn = F.col("doc_id") < 200
    model = quality.fit(docs(rows), marks, learn)
    assert 0.6 < model.prior < 0.85
    got = quality.score(docs(rows), model, keep={"doc_id": F.col("doc_id")}).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["doc_id"] is not None and 200 <= r["doc_id"] < 400]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 != 0) for r in held]) > 0.95
    assert {r["doc_id"]: r["predicted"] for r in got}[902] == 0
    kept = docs(rows).filter(quality.accepted(model)).count()
    assert kept == sum(r["predicted"] for r in got)


def test_risk_is_held_at_zero_by_steps_back():
    r = np.random.default_rng(0)
    good, bad = r.normal(1, 0.5, (300, 16)).astype(np.float32), r.normal(-1, 0.5, (60, 16)).astype(np.float32)
    web = np.concatenate([r.normal(1, 0.5, (240, 16)), r.normal(-1, 0.5, (60, 16))]).astype(np.float32)
    model = quality.minimise_risk(good, web, 0.8)
    assert (model.decision(good) > 0).mean() > 0.95 and (model.decision(bad) > 0).mean() < 0.05


def test_quality_without_labels_or_rows(spark, docs):
    none = labelled(spark, [], "quality")
    model = quality.fit(docs([]), none, F.lit(True))
    assert quality.score(docs([]), model).collect() == []
    assert [tuple(r) for r in quality.score(docs([(1, None, "en", "s")]), model).collect()] == [(1, 0.5, 1)]


def test_measures_of_a_text_stand_alone():
    texts = pa.array(["a a b", None, "", "Ab|c 12", "x" * 3_000_000, "\n"])
    alone = np.concatenate([quality.measure(texts.slice(k, 1)) for k in range(len(texts))])
    assert np.array_equal(quality.measure(texts), alone) and not alone[1].any()


INSULTS = ("bragnok", "zulfrit", "mokdrep")


def toxic_rows(n=300):
    out = []
    for k in range(n):
        w = invented(k, 60).split()
        if k % 3 == 0:
            r = random.Random(k)
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(INSULTS))
        out.append((k, ". ".join(" ".join(w[a:a + 10]) for a in range(0, len(w), 10)), "en", "s"))
    return out


def test_toxicity_held_out_and_disguised(spark, docs):
    rows = toxic_rows() + [(900, None, "en", "s"), (901, "", "en", "s"), (902, " ".join(invented(5, 30_000).split()), "en", "s")]
    hidden = ["bra.gnok", "zul-frit", "moxkdrep", "b r a g n o k", "ZULFRIT!!", "mo_kd_rep"]
    rows += [(1000 + k, f"{invented(k, 20)} {h} {invented(k + 50, 20)} {h}", "en", "s") for k, h in enumerate(hidden)]
    rows += [(1100 + k, invented(2000 + k, 40), "en", "s") for k in range(30)]
    marks = labelled(spark, [(i, int(i % 3 == 0)) for i, *_ in toxic_rows()] + [(3, 1)], "toxic")
    model = toxicity.fit(docs(rows), marks, F.col("doc_id") % 5 != 0)
    assert set(INSULTS) <= set(model.landmarks)
    got = {r["doc_id"]: r for r in toxicity.score(docs(rows), model).collect()}
    held = [k for k in range(300) if k % 5 == 0]
    assert np.mean([got[k]["predicted"] == (k % 3 == 0) for k in held]) > 0.95
    assert sum(got[1000 + k]["predicted"] for k in range(len(hidden))) >= 5
    assert sum(got[1100 + k]["predicted"] for k in range(30)) == 0
    assert got[900]["score"] == got[901]["score"] < 0.5 and got[902]["predicted"] == 0


def test_rare_insults_are_trained_on_and_clean_words_alone_are_capped(spark, docs, monkeypatch):
    """Rare words that pass the toxic test are kept, however many clean words are more frequent."""
    for name in ("MOST_CLEAN", "MOST_STRINGS"):
        monkeypatch.setattr(toxicity, name, 50, raising=False)
    seen, train = [], toxicity.train_machine
    monkeypatch.setattr(toxicity, "train_machine", lambda strings, *a, **k: seen.extend(strings) or train(strings, *a, **k))
    rows = []
    for k in range(240):
        w = invented(k, 60).split()
        if k % 8 == 0:
            w[20] = "vexmurd" if k % 48 == 0 else "bragnok"
        rows.append((k, ". ".join(" ".join(w[a:a + 10]) for a in range(0, len(w), 10)), "en", "s"))
    model = toxicity.fit(docs(rows), labelled(spark, [(i, int(i % 8 == 0)) for i, *_ in rows], "toxic"), F.lit(True))
    assert {"vexmurd", "bragnok"} <= set(seen) and len(seen) == 52
    got = toxicity.score(docs([(1, f"{invented(900, 20)} vexmurd {invented(901, 20)}", "en", "s"), (2, invented(902, 40), "en", "s")]), model)
    assert {r["doc_id"]: r["predicted"] for r in got.collect()} == {1: 1, 2: 0}


def test_table_gives_the_machine_s_own_decisions():
    words = ["bragnok", "zulfrit", "ratomi", "lekosun", "tomira", "unosle"]
    toxic, clean = np.array([30.0, 20, 1, 0, 1, 0]), np.array([0.0, 0, 60, 50, 40, 70])
    table, bias, marks = toxicity.train_machine(words, toxic, clean, landmarks=6)
    model = toxicity.ToxicModel(table, bias, (), marks)
    row, code, value = toxicity.subsequences(words)
    direct = np.bincount(row, value * table[code], len(words)) + bias
    (_, _, data, off), = toxicity.blocks(pa.array(words))
    decided, first = model.word_decisions(data, off)
    assert np.allclose(decided, direct, atol=1e-5) and (decided[:2] > 0).all() and (decided[2:] < 0).all()


def test_toxicity_without_labels_or_rows(spark, docs):
    model = toxicity.fit(docs([]), labelled(spark, [(1, 0), (2, 0)], "toxic"), F.lit(True))
    assert toxicity.score(docs([]), model).collect() == []
    assert toxicity.score(docs([(1, "a", "en", "s")]), model).first()["score"] < 0.5
