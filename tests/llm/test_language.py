import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridlake.llm import language
from llm.samples import invented

KINDS = {"aa": ("ra", "to", "mi", "lek"), "bb": ("schi", "und", "ver", "keit"), "cc": ("ção", "ñu", "dor", "que")}


def rows():
    out = [(k, invented(k, 60 + 10 * (k % 5), KINDS[lang]), lang, "s") for k, lang in enumerate(list(KINDS) * 20)]
    return out + [(100, None, "aa", "s"), (101, "", "bb", "s"), (102, "12 !! …—", "cc", "s"), (103, "x", None, "s"),
                  (104, invented(9, 20_000, KINDS["bb"]), None, "s"), (1, out[1][1], "bb", "s"), (None, out[2][1], None, "s")]


def plain(text, profiles):
    """The same distance, told in dictionaries."""
    raw = bytes((text or "").encode())
    s = [b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in raw]
    line = [0]
    for b in s + [0]:
        if b or line[-1]:
            line.append(b)
    count = {}
    for n in (1, 2, 3):
        for k in range(len(line) - n + 1):
            g = line[k:k + n]
            if n == 1 and not g[0] or n == 2 and not any(g) or n == 3 and not (g[1] and (g[0] or g[2])):
                continue
            code = [(g[0]), (1 << 24) | (g[0] << 8) | g[-1], (2 << 24) | (g[0] << 16) | (g[n // 2] << 8) | g[-1]][n - 1]
            count[code] = count.get(code, 0) + 1
    mine = sorted(count, key=lambda c: (-count[c], c))[:profiles.length]
    if not any(ch.isalpha() for ch in text or ""):
        return "und", 0.0
    dist = []
    for row in profiles.ranks:
        known = {int(g): int(r) for g, r in zip(profiles.grams, row) if r < profiles.length}
        dist.append(sum(abs(known[c] - k) if c in known else profiles.length for k, c in enumerate(mine)))
    best = int(np.argmin(dist))
    return profiles.names[best], 1 - dist[best] / (profiles.length * len(mine))


def test_predictions_match_a_plain_version(spark, docs):
    df = docs(rows())
    profiles = language.fit(df, F.coalesce(F.col("doc_id") % 7 != 1, F.lit(False)), length=80)
    assert profiles.names == ("aa", "bb", "cc")
    got = language.identify(df, profiles, keep={"doc_id": F.col("doc_id")}).collect()
    assert len(got) == len(rows())
    texts = {i: t for i, t, *_ in rows()}
    right = 0
    for r in got:
        name, score = plain(texts[r["doc_id"]], profiles)
        assert (r["lang_pred"], round(r["score"], 9)) == (name, round(score, 9)), r["doc_id"]
        right += r["doc_id"] is not None and r["doc_id"] < 60 and list(KINDS)[r["doc_id"] % 3] == r["lang_pred"]
    assert right == 61
    kept = {r["doc_id"] for r in df.filter(language.accepted(profiles)).collect()}
    # 103 shares no n-gram with any profile
    assert {100, 101, 102, 103} & kept == set() and {104, None} <= kept and len(kept) == 62


def test_nothing_to_learn_from(spark, docs):
    profiles = language.fit(docs([]), F.lit(True))
    assert profiles.names == ()
    got = language.identify(docs([(1, "abc", None, "s")]), profiles).collect()
    assert [tuple(r) for r in got] == [(1, "und", 0.0)]
    assert language.identify(docs([]), profiles).collect() == []


def test_batches_do_not_matter():
    texts = pa.array(["abc def", None, "Zzz", ""] * 50)
    profiles = language.Profiles.of({"a": [97, 98], "b": [122]})
    assert language.predict_texts(texts, profiles)[0] == ["a", "und", "b", "und"] * 50
    assert language.predict_texts(texts.slice(1, 3), profiles)[0] == ["und", "b", "und"]
