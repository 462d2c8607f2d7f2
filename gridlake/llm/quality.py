"""Text quality by positive-unlabelled learning.

The classifier sees trusted good texts (positives), web text of which nobody said anything (unlabelled)
and an estimate of the share of good texts among it, the class prior p. It minimises the non-negative
unbiased risk

    p * E_pos[l(f)] + max(0, E_unlab[l(-f)] - p * E_pos[l(-f)])

with the logistic loss l. The second term is the risk on bad texts, worked out from the other two means;
when it would turn negative the model has begun to learn single texts, and the step goes the other way.
At last the constant is set so that the share of unlabelled texts called good is p. f is additive: each
measure of a text (repetition, symbols, word lengths, ...) is cut at quantiles, and every interval has its
own weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from gridlake.llm.shared import SPACE, blocks, bounded_sample, per_text, word_hashes, words

SAMPLE = 20_000          # at most about so many positives, and as many unlabelled texts, are learned from
INTERVALS = 24           # per measure
STEPS = 600
RATE = 0.05
SHRINK = 1e-4

MEASURES = (
    "bytes", "words", "word_length", "long_words", "one_letter_words", "repeats_last_word", "distinct_words",
    "upper", "digits", "points", "symbols", "bars", "line_breaks", "marked_words", "symbol_ends", "other_bytes",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, bool)
_POINT[list(b".,;:!?'\"()-")] = True
_SYMBOL = ~(_LETTER | _DIGIT | _POINT | SPACE)


def measure(texts: pa.Array) -> np.ndarray:
    """One row of measures per text; all are 0 for an empty text."""
    out = np.zeros((len(texts), len(MEASURES)), np.float32)
    for i, j, data, off in blocks(texts):
        starts, ends, first = words(data, off)
        hashes = word_hashes(data, starts, ends)
        n_bytes = np.diff(off).astype(np.float64)
        n_words = np.diff(first).astype(np.float64)
        per_byte = 1.0 / np.maximum(n_bytes, 1)
        per_word = 1.0 / np.maximum(n_words, 1)
        length = (ends - starts).astype(np.float64)
        same = np.zeros(len(hashes), bool)
        same[1:] = hashes[1:] == hashes[:-1]
        same[first[:-1][n_words > 0]] = False
        distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])], np.float64)
        last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        head = data[starts] if len(starts) else np.zeros(0, np.uint8)
        bytes_of = lambda table: per_text(table[data], off) * per_byte
        words_of = lambda which: per_text(which, first) * per_word      # noqa: E731
        columns = (
            np.log1p(n_bytes), np.log1p(n_words), per_text(length, first) * per_word, words_of(length > 18),
            words_of(length == 1), words_of(same), distinct * per_word, bytes_of(_UPPER), bytes_of(_DIGIT),
            bytes_of(_POINT), bytes_of(_SYMBOL), per_text(data == ord("|"), off) * per_word,
            per_text(data == ord("\n"), off) * per_word, words_of(_UPPER[head]), words_of(_SYMBOL[last]),
            per_text(data > 127, off) * per_byte,
        )
        out[i:j] = np.stack(columns, axis=1)
    return out


@dataclass(frozen=True)
class QualityModel:
    """Cuts of each measure, a weight for each interval, and the class prior the fit used."""

    cuts: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]
    bias: float
    prior: float

    def decision(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.bias)
        for k, (cuts, weights) in enumerate(zip(self.cuts, self.weights)):
            f += weights[np.searchsorted(cuts, x[:, k], "right")]
        return f

    def score(self, texts: pa.Array) -> np.ndarray:
        """Estimated probability that a text is good."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.decision(measure(texts)), -30, 30)))


def minimise_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, intervals: int = INTERVALS,
                  steps: int = STEPS, rate: float = RATE, shrink: float = SHRINK) -> QualityModel:
    """Fit the additive model by Adam on the non-negative risk, over two matrices of measures."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    cuts = tuple(np.unique(np.quantile(both[:, k], np.linspace(0, 1, intervals + 1)[1:-1])) if len(both) else
                 np.zeros(0) for k in range(both.shape[1]))
    base = np.cumsum([0] + [len(c) + 1 for c in cuts])
    place = lambda x: np.stack([base[k] + np.searchsorted(c, x[:, k], "right")
                                for k, c in enumerate(cuts)], axis=1)
    at_p, at_u = place(positive.astype(np.float64)), place(unlabelled.astype(np.float64))
    w, bias = np.zeros(base[-1]), float(np.log(prior / (1 - prior)))
    grow = lambda at, g: np.bincount(at.ravel(), np.repeat(g, at.shape[1]), base[-1])
    sig = lambda v: 1.0 / (1.0 + np.exp(-np.clip(v, -30, 30)))                        # noqa: E731
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    mean, spread = np.zeros(len(w)), 0
    for t in range(1, steps + 1):
        fp, fu = w[at_p].sum(axis=1) + bias, w[at_u].sum(axis=1) + bias
        bad = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gu, gp = sig(fu) / len(fu), -prior * sig(fp) / len(fp)       # of the risk on bad texts
        good = -prior * (1 - sig(fp)) / len(fp)
        g_p, g_u = (good + gp, gu) if bad >= 0 else (-gp, -gu)
        g = np.append(grow(at_p, g_p) + grow(at_u, g_u) + shrink * w, g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
        if t > steps // 2:                                           # the mean of the later steps
            mean, spread = mean + np.append(w, bias)[:-1], spread + 1
    if spread:
        w = mean / spread
    f = w[at_u].sum(axis=1)                                           # the share of good texts is the prior
    bias = -float(np.quantile(f, 1 - prior)) if len(f) else bias
    parts = tuple(w[base[k]:base[k + 1]] for k in range(len(cuts)))
    return QualityModel(cuts, parts, bias, prior)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id",
        label: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Learn from labelled rows where ``learn`` (over the id) holds.

    Positives are texts labelled 1. The class prior is the share of label 1 among all labelled learn rows.
    The unlabelled texts are drawn from ``docs`` without looking at labels. About ``sample`` of either are
    drawn by the hash of the id; only their measures come to the driver (16 numbers each). Without any
    positive label the model says one half everywhere.
    """
    marks = (labels.filter(learn & F.col(label).isin(0, 1))
             .groupBy(F.col(doc_id)).agg(F.max(F.col(label)).alias("mark")))
    tally = {r["mark"]: r["count"] for r in marks.groupBy("mark").count().collect()}
    n_good, n_bad = tally.get(1, 0), tally.get(0, 0)
    if not n_good:
        empty = tuple(np.zeros(0) for _ in MEASURES)
        return QualityModel(empty, tuple(np.zeros(1) for _ in MEASURES), 0.0, 0.5)
    prior = (n_good + 1) / (n_good + n_bad + 2)
    good = bounded_sample(marks.filter("mark = 1"), F.col(doc_id), sample, n_good).select(
        F.col(doc_id).alias("id"), F.lit(1).alias("good"))        # two numbers for each of about ``sample`` documents
    n_docs = docs.filter(learn).count()
    some = bounded_sample(docs.filter(learn), F.coalesce(F.col(doc_id), F.lit(-1)), sample, n_docs, seed=13).select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.lit(0).alias("good"))
    trusted = docs.filter(learn).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(good), "id").select("id", "text", "good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = measure(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["good", "x"])

    got = trusted.unionByName(some).select("text", "good").mapInArrow(run, "good int, x binary").toArrow()
    kind = np.array(got.column("good").to_pylist())
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(len(kind), len(MEASURES))
    order = np.lexsort((*x.T, kind))                                 # independent of the order of arrival
    kind, x = kind[order], x[order]
    return minimise_risk(x[kind == 1], x[kind == 0], prior)


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``score`` (probability of a good text) and ``predicted`` (1 from 0.5 on) of every whole text.

    ``keep`` names the further columns of the result; other columns are not read. Null and empty texts
    are scored as texts with all measures 0. Repeated rows each get a row.
    """
    keep = keep or {"doc_id": F.col("doc_id")}
    names = [*keep, "score", "predicted"]
    rows = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(keep.values())], F.col(text).alias("text"))
    types = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]
    schema = ", ".join([f"`{n}` {t}" for n, t in zip(keep, types)] + ["score double", "predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)

    return rows.mapInArrow(run, schema)


def accepted(model: QualityModel, text: str = "text", least: float = 0.5) -> Column:
    """Whether a text scores at least ``least``."""
    @F.arrow_udf(BooleanType())
    def good(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts) >= least)

    return good(F.col(text))
