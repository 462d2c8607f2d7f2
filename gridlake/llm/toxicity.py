"""Toxicity by a support vector machine over a subsequence string kernel.

Two strings are alike as far as they share subsequences of four letters; a shared subsequence counts by
DECAY to the power of the span it takes in each string, and spans of up to SPAN symbols count, so that
letters left out or put in between only weaken a match. Words are the strings; signs in them are left out. The kernel is
used through Nystroem landmarks: chosen words z, the features K(z, z)^(-1/2) k(z, x), and a linear machine
with squared hinge loss on them. As the kernel is an inner product over subsequences, the machine's decision for a
word is again a weighted sum over the word's subsequences: the landmarks' weights are added up once into a
table, and a text is read once, whatever the number of landmarks.

The machine is trained on sentences with the label of their document: a word stands for the sentences it
occurs in, toxic and clean. A document's score comes from its words' decisions (the largest one, and how
many are toxic) by logistic regression on the same documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.llm.shared import SPACE, blocks, bounded_sample

SAMPLE = 6000             # documents of either label that are learned from, about
LANDMARKS = 160
LEAST_SENTENCES = 6       # a word that is not toxic is a training string from so many sentences on
MOST_CLEAN = 12_000       # and so many of those at most are trained on, the most frequent ones; toxic ones all are
LEAST_LIFT = 1.5          # a toxic string is in e**1.5 times as large a share of toxic as of clean sentences,
LEAST_SURE = 4.0          # by four standard deviations
CLEAN_WEIGHT = 4.0        # of all clean strings against all toxic ones
SPAN = 7
DECAY = 0.75
SYMBOLS = 32              # 0 for what is no letter, 1-26 letters, 27 the start of a word, 28-31 accented letters

# Letters of U+00C0-U+00FF, by the second byte of their UTF-8 form (which is C3 and that byte): the accents
# tell words apart, so they are four further symbols. Digits stand for the letters they look like.
_ACCENTS = {28: "éÉ", 29: "èêëÈÊË", 30: "àáâãäåæìíîïòóôõöøùúûüýÿÀÁÂÃÄÅÆÌÍÎÏÒÓÔÕÖØÙÚÛÜÝ", 31: "çðñþßÇÐÑÞ"}
_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


def _fold_table() -> np.ndarray:
    fold = np.zeros(256, np.int32)
    for k in range(26):
        fold[97 + k] = fold[65 + k] = k + 1
    for digit, letter in _LOOKALIKES.items():
        fold[ord(digit)] = ord(letter) - 96
    for symbol, letters in _ACCENTS.items():
        for ch in letters:
            fold[ch.encode()[1]] = symbol
    return fold


_FOLD = _fold_table()
# (b, [(a1, a2), ...]): the inner places of four letters whose last stands b after the first
_PLACES = [(b, [(i, j) for i in range(1, b - 1) for j in range(i + 1, b)]) for b in range(3, SPAN)]


def _symbols(data: np.ndarray, off: np.ndarray):
    """(symbols, word number of each, first word of each text, word lengths) of a block.

    Every word begins with the start symbol. Words of one letter that follow each other are one word, so
    that spaced-out letters come together.
    """
    n = len(data)
    mute = _FOLD[data] == 0            # signs between letters, and first bytes of longer characters, are left out
    space = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    begins = ~space & np.concatenate([[True], space[:-1]])
    begins |= ~space & edge[:n]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(off), np.int64), np.zeros(0, np.int64)
    first_byte = np.searchsorted(starts, off)
    plain = np.zeros(n + 1, np.int64)
    np.cumsum(~space & ~mute, out=plain[1:])
    size = np.diff(np.append(plain[starts], plain[n]))
    joins = np.zeros(len(starts), bool)
    joins[1:] = (size[1:] == 1) & (size[:-1] == 1)
    joins[first_byte[:-1][np.diff(first_byte) > 0]] = False
    keep = ~space & ~mute
    sym = _FOLD[data[keep]]
    heads = plain[starts][~joins]
    sym = np.insert(sym, heads, 27)
    number = np.zeros(len(sym), np.int64)
    number[heads + np.arange(len(heads))] = 1
    word = np.cumsum(number) - 1
    first = np.searchsorted(heads, plain[off])
    return sym, word, first, np.bincount(word, minlength=len(heads))


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string number, code, value) of every way to pick four symbols of a string within SPAN.

    Values are scaled by the root of the sum of squares of a string's picks. Strings hold no white space.
    """
    (_, _, data, off), = blocks(pa.array(strings, pa.string()), limit=1 << 40)
    sym, word, _, sizes = _symbols(data, off)
    rows, codes, values = [], [], []
    for b, inner in _PLACES:
        m = max(0, len(sym) - b)
        at = np.flatnonzero((word[:m] == word[b:]) & (sym[:m] > 0) & (sym[b:] > 0))
        ends = (sym[at] << 15) | sym[at + b]
        for i, j in inner:
            p, q = sym[at + i], sym[at + j]
            ok = (p > 0) & (q > 0)
            rows.append(word[at[ok]])
            codes.append((ends | (p << 10) | (q << 5))[ok])
            values.append(np.full(len(rows[-1]), DECAY ** (b + 1)))
    row, code, value = np.concatenate(rows), np.concatenate(codes), np.concatenate(values)
    norm = np.sqrt(np.bincount(row, value * value, len(sizes)))
    return row, code, value / norm[row]


def _dense(row: np.ndarray, code: np.ndarray, value: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """The part of the sparse rows that lies in ``columns`` (sorted codes), as a matrix."""
    out = np.zeros((n, len(columns)), np.float32)
    place = np.minimum(np.searchsorted(columns, code), len(columns) - 1)
    ok = columns[place] == code
    np.add.at(out, (row[ok], place[ok]), value[ok])
    return out


@dataclass(frozen=True)
class ToxicModel:
    """Weight of each subsequence, the machine's bias, and the document's logistic weights."""

    table: np.ndarray
    bias: float
    document: tuple[float, ...]
    landmarks: tuple[str, ...]

    def word_decisions(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sym, word, first, sizes = _symbols(data, off)
        total = np.zeros(len(sizes))
        norm = np.zeros(len(sizes))
        for b, inner in _PLACES:
            m = len(sym) - b
            if m <= 0:
                break
            at = np.flatnonzero((word[:m] == word[b:]) & (sym[:m] > 0) & (sym[b:] > 0))
            ends = (sym[at] << 15) | sym[at + b]
            got, n = np.zeros(len(at), np.float32), np.zeros(len(at), np.float32)
            for i, j in inner:
                p, q = sym[at + i], sym[at + j]
                value = self.table[ends | (p << 10) | (q << 5)]
                real = (p > 0) & (q > 0)
                got += value * real
                n += real
            number = word[at]
            total += DECAY ** (b + 1) * np.bincount(number, got, len(sizes))
            norm += DECAY ** (2 * b + 2) * np.bincount(number, n, len(sizes))
        out = np.full(len(sizes), self.bias)
        np.divide(total, np.sqrt(norm), out=total, where=norm > 0)
        return out + total, first

    def describe(self, texts: pa.Array) -> np.ndarray:
        """The largest decision of each text's words (at least -1), and log(1 + words) above 0 and above 1/2."""
        out = np.zeros((len(texts), 3))
        out[:, 0] = -1
        for i, j, data, off in blocks(texts):
            f, first = self.word_decisions(data, off)
            has = np.flatnonzero(np.diff(first) > 0)
            if len(has):
                out[i + has, 0] = np.clip(np.maximum.reduceat(f, first[has]), -1, 3)
                for k, level in ((1, 0.0), (2, 0.5)):
                    hits = np.concatenate([[0], np.cumsum(f > level)])
                    out[i:j, k] = np.log1p(hits[first[1:]] - hits[first[:-1]])
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """Estimated probability that a text is toxic."""
        f = self.describe(texts) @ np.array(self.document[:-1]) + self.document[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(f, -30, 30)))


def _likelihood_ratio(toxic: np.ndarray, clean: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Twice the gain in log-likelihood of a rate for each label over one rate for both, per string."""
    all_t, all_c = totals[0] + 1, totals[1] + 1
    rate = (toxic + clean) / (all_t + all_c)
    out = np.zeros(len(toxic))
    for seen, n in ((toxic, all_t), (clean, all_c)):
        for part, expect in ((seen, n * rate), (n - seen, n * (1 - rate))):
            out += np.where(part > 0, part * np.log(np.maximum(part, 1e-9) / np.maximum(expect, 1e-9)), 0.0)
    return np.maximum(2 * out, 0.0)


def _toxic_test(toxic: np.ndarray, clean: np.ndarray, totals: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each string counts as toxic, and how sure that is, in standard deviations (below 0: clean)."""
    share_t, share_c = (toxic + 0.5) / (totals[0] + 1), (clean + 0.5) / (totals[1] + 1)
    lift = np.log(share_t / share_c)
    sure = np.sign(lift) * np.sqrt(_likelihood_ratio(toxic, clean, totals))
    return (lift > LEAST_LIFT) & (sure > LEAST_SURE), sure


def train_machine(strings: list[str], toxic: np.ndarray, clean: np.ndarray, landmarks: int = LANDMARKS,
                  passes: int = 40, penalty: float = 1e-3, totals: tuple[float, float] | None = None) -> tuple[np.ndarray, float, tuple[str, ...]]:
    """Landmarks, Nystroem features and the linear machine; returns the subsequence table, bias, landmarks.

    ``toxic`` and ``clean`` count the sentences of either label that hold a string. Landmarks are the strings
    that tell the labels apart best, and as many frequent ones that do not. ``totals`` are the sums of both
    counts over all words, if the strings are not all.
    """
    passed, sure = _toxic_test(toxic, clean, totals or (toxic.sum(), clean.sum()))
    y = np.where(passed, 1.0, -1.0)
    if not (y > 0).any():
        y[np.argmax(sure)] = 1.0
    order = [k for k in np.argsort(-sure, kind="stable") if y[k] > 0]
    frequent = [k for k in np.argsort(-(toxic + clean), kind="stable") if y[k] < 0]
    chosen = [*order[:landmarks // 2], *frequent[:landmarks - landmarks // 2]]
    row, code, value = subsequences(strings)
    by_row = np.argsort(row, kind="stable")
    row, code, value = row[by_row], code[by_row], value[by_row]
    bound = np.searchsorted(row, np.arange(len(strings) + 1))
    runs = [slice(bound[k], bound[k + 1]) for k in chosen]
    columns = np.unique(np.concatenate([code[r] for r in runs]))
    z = np.concatenate([_dense(row[r] * 0, code[r], value[r], columns, 1) for r in runs])
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    near = []
    for a in range(0, len(strings), 512):
        e = min(len(strings), a + 512)
        r = slice(bound[a], bound[e])
        near.append(_dense(row[r] - a, code[r], value[r], columns, e - a) @ z.T)
    x = np.concatenate(near) @ root
    known = (y > 0) | (sure < 2)                                       # leave out what may be either
    weight = np.where(known, np.sqrt(toxic + clean), 0.0)
    weight[y > 0] /= max(weight[y > 0].sum(), 1e-9)
    weight[y < 0] *= CLEAN_WEIGHT / max(weight[y < 0].sum(), 1e-9)
    design = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    ridge = np.append(np.full(len(chosen), penalty), 0.0)
    w = np.zeros(len(chosen) + 1)
    for _ in range(passes):                                            # Newton's method on the squared hinge
        wrong = (y * (design @ w) < 1) * weight
        new = np.linalg.solve((design * wrong[:, None]).T @ design + np.diag(ridge + 1e-9), design.T @ (wrong * y))
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    alpha = root @ w[:-1]
    table = np.zeros(SYMBOLS ** 4, np.float32)
    table[columns] = alpha @ z
    return table, float(w[-1]), tuple(strings[k] for k in chosen)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton's method with a small ridge; the last weight is the constant's."""
    design = np.column_stack([x, np.ones(len(x))])
    ridge = len(x) * np.append(np.full(x.shape[1], 1e-5), 1e-7)
    w = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        w = w + np.linalg.solve(h, design.T @ (y - p) - ridge * w)
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id",
        label: str = "toxic", sample: int = SAMPLE) -> ToxicModel:
    """Learn from labelled rows where ``learn`` (over the id) holds, about ``sample`` of either label.

    Spark counts in how many toxic and clean sentences each word stands, and tests every word; all toxic ones
    and the MOST_CLEAN most frequent others are trained on. With only one label present the score is that label's share everywhere.
    """
    marks = labels.filter(learn & F.col(label).isin(0, 1)).groupBy(F.col(doc_id)).agg(F.max(F.col(label)).alias("mark"))
    tally = {r["mark"]: r["count"] for r in marks.groupBy("mark").count().collect()}
    n_toxic, n_clean = tally.get(1, 0), tally.get(0, 0)
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return ToxicModel(np.zeros(SYMBOLS ** 4, np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))), ())
    key = F.col(doc_id)
    picked = bounded_sample(marks.filter("mark = 1"), key, sample, n_toxic).unionByName(
        bounded_sample(marks.filter("mark = 0"), key, sample, n_clean)).select(key.alias("id"), "mark")
    rows = docs.filter(learn).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(picked), "id")                       # two numbers for each of about 2 * sample documents
    rows = rows.select("mark", F.coalesce("text", F.lit("")).alias("text"))

    def sentence_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, strip = re.compile(r"[.!?]+\s|\n"), ".,;:!?\"'()|#*$%&"
        for batch in batches:
            marks, found = batch.column(0).to_pylist(), {}
            for mark, body in zip(marks, batch.column(1).to_pylist()):
                for sentence in cut.split(body.lower()):
                    for w in {w.strip(strip) for w in sentence.split()}:
                        if 4 <= len(w) <= 24:
                            found.setdefault(w, [0, 0])[mark] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array([v[1] for v in found.values()], pa.int64()),
                 pa.array([v[0] for v in found.values()], pa.int64())], names=["w", "toxic", "clean"])

    counts = stage_table(rows.mapInArrow(sentence_words, "w string, toxic long, clean long").groupBy("w")
                         .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-words")
    totals = tuple(float(v or 0) for v in counts.agg(F.sum("toxic"), F.sum("clean")).first())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed, _ = _toxic_test(*(batch.column(k).to_numpy().astype(float) for k in (1, 2)), totals)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(passed)], names=["w", "toxic", "clean", "passed"])

    judged = counts.mapInArrow(judge, "w string, toxic long, clean long, passed boolean")
    number = F.col("toxic") + F.col("clean")
    kept = [judged.filter("passed").orderBy(F.desc(number), "w").toArrow(),
            judged.filter(~F.col("passed") & (number >= LEAST_SENTENCES)).orderBy(F.desc(number), "w").limit(MOST_CLEAN).toArrow()]
    counts = pa.concat_tables(kept)
    strings = counts.column("w").to_pylist()
    if not strings:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return ToxicModel(np.zeros(SYMBOLS ** 4, np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))), ())
    table, bias, chosen = train_machine(strings, counts.column("toxic").to_numpy().astype(float),
                                        counts.column("clean").to_numpy().astype(float), totals=totals)
    machine = ToxicModel(table, bias, (), chosen)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shared.value.describe(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k].copy()) for k in range(3))],
                                             names=["mark", "top", "hits", "strong"])

    seen = rows.mapInArrow(describe, "mark int, top double, hits double, strong double").toArrow()
    x = np.column_stack([seen.column(k).to_numpy() for k in ("top", "hits", "strong")])
    y = seen.column("mark").to_numpy().astype(float)
    *slopes, constant = _logistic(x, y)
    drawn = (y.mean() / (1 - y.mean())) if 0 < y.mean() < 1 else 1.0
    constant += float(np.log((n_toxic / n_clean) / drawn))           # back to the labels' own shares
    return ToxicModel(table, bias, (*slopes, constant), chosen)


def score(docs: DataFrame, model: ToxicModel, text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``score`` (probability of a toxic text) and ``predicted`` (1 from 0.5 on) of every whole text.

    ``keep`` names the further columns of the result; other columns are not read. Null and empty texts get
    the score of a text without toxic words. Repeated rows each get a row. The model (4 MB, whatever it was
    learned from) is broadcast.
    """
    keep = keep or {"doc_id": F.col("doc_id")}
    names = [*keep, "score", "predicted"]
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(keep.values())], F.col(text).alias("text"))
    types = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]
    schema = ", ".join([f"`{n}` {t}" for n, t in zip(keep, types)] + ["score double", "predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)

    return rows.mapInArrow(run, schema)
