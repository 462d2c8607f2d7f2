"""Language identification by rank-order profiles of n-grams.

A language's profile lists its most frequent n-grams (one to three bytes of UTF-8, A-Z lower-cased,
runs of other ASCII as one blank) in order. A document's own list is compared with each profile by
the out-of-place distance: for every n-gram of the document the difference of the two ranks, or the
full list length where the profile lacks it. The nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from gridlake.llm.shared import blocks, bounded_sample

PROFILE_LENGTH = 300
SAMPLE_PER_LANGUAGE = 4000   # learn documents per language that a profile is counted on, about

_LETTER = np.zeros(256, np.uint8)           # 0 for what is no letter: ASCII other than A-Z, a-z
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _gram_codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a block as integers, text after text, and the bounds of each text's run."""
    s = _LETTER[data]
    s = np.insert(s, off, 0)                              # a blank before each text and at the end
    bound = off + np.arange(len(off))
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    keep[bound] = True
    at = np.zeros(len(s) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    s, bound = s[keep].astype(np.uint32), at[bound]
    n = len(s)
    b = np.append(s[1:], [np.uint32(0)])
    c = np.append(b[1:], [np.uint32(0)])
    grams = np.empty((n, 3), np.uint32)
    grams[:, 0] = s
    grams[:, 1] = (1 << 24) | (s << 8) | b
    grams[:, 2] = (2 << 24) | (s << 16) | (b << 8) | c
    ok = np.empty((n, 3), bool)
    ok[:, 0] = s != 0
    ok[:, 1] = ok[:, 0] | (b != 0)
    ok[:, 2] = b != 0                                     # no blank inside
    ok[:, 2] &= ok[:, 0] | (c != 0)
    # the last blank only ends the last text; no other n-gram reaches across texts, as none has a blank inside
    ok[bound[-1]:] = False
    count = np.zeros(n + 1, np.int64)
    np.cumsum(ok.sum(axis=1), out=count[1:])
    return grams[ok], count[bound]


def _ranked(codes: np.ndarray, length: int) -> np.ndarray:
    """The most frequent codes in order; ties go to the smaller code."""
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.append(at, len(codes)))
    key = (counts.astype(np.int64) << 32) | (0xFFFFFFFF - codes[at].astype(np.int64))
    if len(key) > length:
        key = np.partition(key, len(key) - length)[-length:]
    key = np.sort(key)[::-1]
    return (0xFFFFFFFF - (key & 0xFFFFFFFF)).astype(np.uint32)


@dataclass(frozen=True)
class Profiles:
    """Names in order, all n-grams of the profiles in order, and each profile's rank for them."""

    names: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    length: int

    @classmethod
    def of(cls, ranked: dict[str, list[int]], length: int = PROFILE_LENGTH) -> Profiles:
        names = tuple(sorted(ranked))
        grams = np.array(sorted({g for v in ranked.values() for g in v}), np.uint32)
        ranks = np.full((len(names), len(grams)), length, np.int64)
        for i, name in enumerate(names):
            ranks[i, np.searchsorted(grams, np.array(ranked[name], np.uint32))] = np.arange(len(ranked[name]))
        return cls(names, grams, ranks, length)

    def nearest(self, codes: np.ndarray) -> tuple[int, float]:
        """Index of the nearest profile, and one minus its distance as a share of the largest."""
        mine = _ranked(codes, self.length)
        place = np.searchsorted(self.grams, mine)
        place[place == len(self.grams)] = 0
        known = self.grams[place] == mine
        apart = np.abs(self.ranks[:, place] - np.arange(len(mine)))
        apart[:, ~known] = self.length
        apart[self.ranks[:, place] == self.length] = self.length
        total = apart.sum(axis=1)
        best = int(total.argmin())                        # names are in order: ties go to the first
        return best, 1.0 - total[best] / (self.length * len(mine))


def _has_letter(data: np.ndarray) -> bool:
    letters = _LETTER[data]
    if ((letters > 0) & (letters < 128)).any():
        return True
    return any(ch.isalpha() for ch in bytes(data[data > 127]).decode("utf-8", "replace"))


def predict_texts(texts: pa.Array, profiles: Profiles) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for _, _, data, off in blocks(texts):
        codes, at = _gram_codes(data, off)
        for k in range(len(off) - 1):
            own = codes[at[k]:at[k + 1]]
            if not len(own) or not profiles.names or not _has_letter(data[off[k]:off[k + 1]]):
                names.append("und")
                scores.append(0.0)
            else:
                best, score = profiles.nearest(own)
                names.append(profiles.names[best])
                scores.append(score)
    return names, scores


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        length: int = PROFILE_LENGTH, sample: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Profiles of the languages named in ``lang``, from rows where ``learn`` holds and neither is null.

    The n-grams are counted in Spark over about ``sample`` documents of each language; only the profiles
    come to the driver. Languages are an inventory: their number does not grow with the documents.
    """
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).count().collect()}
    if not sizes:
        return Profiles.of({}, length)
    share = F.create_map(*[x for k, v in sizes.items()
                           for x in (F.lit(k), F.lit(min(1_000_000, int(1e6 * sample / v))))])
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    picked = rows.filter(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1_000_000)) < share[F.col(lang)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for name in set(langs):
                for _, _, data, off in blocks(batch.column(1).filter(pa.array(langs == name))):
                    grams, n = np.unique(_gram_codes(data, off)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)),
                         pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counts = (picked.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
              .mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= length)
    ranked: dict[str, list[tuple[int, int]]] = {}
    for r in top.collect():
        ranked.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return Profiles.of({k: [g for _, g in sorted(v)] for k, v in ranked.items()}, length)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``lang_pred`` and ``score`` (one minus the relative distance) of every whole text.

    ``keep`` names the further columns of the result; other columns are not read. Null texts and texts
    without a letter get ``und`` and 0; so do all if no language was learned. Equal distances go to the
    first name in order; repeated rows each get a row.
    """
    keep = keep or {"doc_id": F.col("doc_id")}
    names_out = [*keep, "lang_pred", "score"]
    rows = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(keep.values())], F.col(text).alias("text"))
    types = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]
    schema = ", ".join([f"`{n}` {t}" for n, t in zip(keep, types)] + ["lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict_texts(batch.column(batch.num_columns - 1), profiles)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=names_out)

    return rows.mapInArrow(run, schema)


def accepted(profiles: Profiles, text: str = "text", least: float = 0.0) -> Column:
    """Whether a text has a recognised language: not ``und`` and a score above ``least``."""
    @F.arrow_udf(BooleanType())
    def known(texts: pa.Array) -> pa.Array:
        names, scores = predict_texts(texts, profiles)
        return pa.array([n != "und" and s > least for n, s in zip(names, scores)], pa.bool_())

    return known(F.col(text))
