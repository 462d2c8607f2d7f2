"""Packing documents into training sequences whose mixture of sources is held to target proportions.

Each source is a queue of tokens. The output is a line of windows of WINDOW tokens; by deficit round-robin
every window adds to each source's credit its share of the window, takes whole tokens up to the credit from
the queue, and leaves what is left (less than a token) as deficit for the next window. When a queue is empty
its share goes to the others, in proportion to their targets. Targets are weights that the caller gives, or else
the sources' tokens to the power TEMPER. The windows, one after another, are cut into sequences.

What a source has given after w windows is floor(credit(w)), and credit is a straight line between the
points where a queue runs dry. So no state has to be handed from window to window, or from partition to
partition: a document's place in its queue (a sum over partitions, then within its own) tells its windows,
its places there and its sequences. Nothing is shuffled but these sums.

The stream is cut at every ``length`` tokens; what remains at the end is cut into powers of two, so that no
sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.llm.tokens import encoded

LENGTH = 4096
WINDOW_SEQUENCES = 64
TEMPER = 0.7               # the power of a source's tokens that is its weight, unless targets are given


def tempered(totals: dict[str, int], power: float = TEMPER) -> dict[str, float]:
    """Target weights of sources: their tokens to a power below 1, so that small sources are seen more often early on."""
    return {name: float(n) ** power for name, n in totals.items()}


@dataclass(frozen=True)
class Mixture:
    """How much each source has given after w windows, for w of any size."""

    names: tuple[str, ...]
    totals: np.ndarray          # tokens of each queue
    window: int
    times: np.ndarray           # in windows: where a phase begins, and the end
    credit: np.ndarray          # of each source at these times
    rate: np.ndarray            # of each source in each phase, tokens a window

    @classmethod
    def of(cls, totals: dict[str, int], targets: dict[str, float] | None = None, window: int = LENGTH * WINDOW_SEQUENCES):
        """``targets`` are relative weights of sources, by default ``tempered``; sources without one come last."""
        names = tuple(sorted(totals))
        amount = np.array([totals[n] for n in names], np.float64)
        targets = tempered(totals) if targets is None else targets
        weight = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
        now, given = 0.0, np.zeros(len(names))
        times, credit, rate = [0.0], [given.copy()], []
        while (left := amount - given).max(initial=0) > 0:
            live = np.where(left > 0, weight, 0.0)
            if not live.any():
                live = left.copy()                  # only sources without a target remain
            speed = live / live.sum() * window
            need = np.where(speed > 0, left / np.where(speed > 0, speed, 1), np.inf)
            step = need.min()
            done = need <= step * (1 + 1e-12)
            given = np.where(done, amount, given + speed * step)
            now += step
            rate.append(speed)
            times.append(now)
            credit.append(given.copy())
        return cls(names, amount.astype(np.int64), window, np.array(times), np.stack(credit),
                   np.stack(rate) if rate else np.zeros((0, len(names))))

    @property
    def tokens(self) -> int:
        return int(self.totals.sum())

    def given(self, w: int) -> np.ndarray:
        """Tokens that each source has given after w windows."""
        if w >= self.times[-1]:
            return self.totals
        k = int(np.searchsorted(self.times, w, "right")) - 1
        return np.minimum(np.floor(self.credit[k] + self.rate[k] * (w - self.times[k])).astype(np.int64), self.totals)

    def window_of(self, source: int, place: int) -> int:
        """The window that takes the token at ``place`` of the source's queue."""
        k = max(0, int(np.searchsorted(self.credit[:, source], place, "right")) - 1)
        k = min(k, len(self.rate) - 1)
        while k + 1 < len(self.rate) and self.rate[k, source] == 0:
            k += 1
        w = int(self.times[k] + (place - self.credit[k, source]) / self.rate[k, source])
        while w > 0 and self.given(w)[source] > place:
            w -= 1
        while self.given(w + 1)[source] <= place:
            w += 1
        return w


def sequence_of(place: int, tokens: int, length: int) -> tuple[int, int, int]:
    """(sequence, place in it, its size) of a place in the stream of ``tokens``."""
    full = tokens // length
    if place < full * length:
        return place // length, place % length, length
    rest, at, number = tokens - full * length, place - full * length, full
    while True:
        size = 1 << (rest.bit_length() - 1)
        if at < size:
            return number, at, size
        rest, at, number = rest - size, at - size, number + 1


def tokenise(docs: DataFrame, path: str, end_id: int, text: str, doc_id: str, source: str) -> DataFrame:
    """Stage (id, source, part, before, n, ids): a document's ids and its place in its source's queue of a partition."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                piece = batch.slice(k, 1000)
                sources, before, sizes, ids = piece.column(1).to_pylist(), [], [], []
                for name, got in zip(sources, encoded(piece.column(2), path, end_id)):
                    before.append(so_far.get(name, 0))
                    so_far[name] = before[-1] + len(got)
                    sizes.append(len(got))
                    ids.append(got.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(sources, pa.string()), pa.array([part] * len(ids), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=["id", "source", "part", "before", "n", "ids"])

    return stage_table(rows.mapInArrow(
        run, f"id {kind}, source string, part int, before long, n long, ids binary"), "pack-tokens")


def pack(docs: DataFrame, path: str, end_id: int, targets: dict[str, float] | None = None, length: int = LENGTH,
         window: int = LENGTH * WINDOW_SEQUENCES, text: str = "text", doc_id: str = "doc_id", source: str = "source",
         with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and (``with_ids``) ids.

    A document's ids end with ``end_id``; a null or empty text is that id alone. A null source counts as an
    empty name. ``targets`` are relative weights of sources (``Mixture.of``). Sources are an inventory: their token totals (one row each) come to the driver, and each
    window looks at all of them. Repeated rows are packed as often as they occur; null ids stay null.
    ``ids`` are little-endian, two bytes each where the vocabulary allows, else four.
    """
    staged = tokenise(docs, path, end_id, text, doc_id, source)
    kind = staged.schema["id"].dataType.simpleString()
    sums = stage_table(staged.groupBy("part", "source").agg(F.sum("n").alias("n")), "pack-sums")
    totals = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    mixture = Mixture.of(totals, targets, window)
    number = {name: k for k, name in enumerate(mixture.names)}
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage_table(sums.select("part", "source", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")), "pack-bases")
    rows = staged.join(bases, ["part", "source"]).select(
        "id", "source", (F.col("base") + F.col("before")).alias("place"), "n", "ids")
    fields = ["start long", "length long", "ids_crc32 long", "doc_tokens long", "sequence_id long", "offset long"]
    names = [doc_id, *[f.split()[0] for f in fields], *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = lru_cache(4096)(mixture.given)
        starts = lru_cache(4096)(lambda w: (int(given(w).sum()), np.cumsum(np.append(0, given(w + 1) - given(w)))))
        for batch in batches:
            owner, out, bodies = [], [], []
            for k, (name, place, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                raw = batch.column(4)[k].as_py()
                width = len(raw) // n
                ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4")
                s, at = number[name], 0
                w = mixture.window_of(s, place)
                while at < n:
                    first, before = starts(w)
                    stop = min(n, int(given(w + 1)[s]) - place)
                    base = first + int(before[s]) - int(given(w)[s]) + place
                    while at < stop:
                        seq, offset, size = sequence_of(base + at, mixture.tokens, length)
                        end = min(stop, at + size - offset)
                        body = ids[at:end]
                        owner.append(k)
                        out.append((at, end - at, zlib.crc32(body.astype("<u4").tobytes()), n, seq, offset))
                        if with_ids:
                            bodies.append(body.tobytes())
                        at = end
                    w += 1
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 6
            if with_ids:
                columns.append(pa.array(bodies, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *columns], names=names)

    return rows.mapInArrow(run, f"`{doc_id}` {kind}, " + ", ".join(fields) + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): each sequence's ids, and the lengths of the documents' pieces in it, in order."""
    one = F.struct("offset", "length", "ids")
    got = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(one)).alias("p"))
    return got.select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
                      F.transform("p", lambda p: p["length"]).alias("lengths"))
