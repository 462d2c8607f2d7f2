"""Token ids as Arrow files of equal-length sequences.

A shard is an Arrow stream with a footer (the IPC file format). Its record batches have two columns of
fixed-size lists, ``ids`` and ``mask``: sequence k lies at a place that follows from k, and a memory-mapped
reader gets it, and its mask, without a copy. The last sequence of a shard is filled up with zeros whose mask
is false. Beside each shard lies an index with one row per document: id, start in the shard, number of ids.

Documents are dealt to partitions by ranges of their id and sorted there, so shards in order are documents in
order. A task writes to names of its own and reports them; what a lost or repeated task has left behind is on
no list and never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.cluster import scratch_path, stage_table
from gridlake.llm.tokens import encoded, encoder

LENGTH = 2048
BATCH_SEQUENCES = 64
SHARD_IDS = 1 << 27


class _Shard:
    """One shard and its index while they are written."""

    def __init__(self, files: fs.FileSystem, folder: str, part: int, dtype: np.dtype, length: int):
        self.name = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        self.length, self.dtype = length, dtype
        kinds = pa.list_(pa.from_numpy_dtype(dtype), length), pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("ids", kinds[0]), ("mask", kinds[1])])
        self.file = files.open_output_stream(f"{self.name}.arrow")
        self.writer = ipc.new_file(self.file, self.schema)
        self.docs_file = files.open_output_stream(f"{self.name}.docs.arrow")
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.docs_writer = ipc.new_file(self.docs_file, self.docs_schema)
        self.waiting: list[np.ndarray] = []
        self.held, self.ids, self.docs, self.rows = 0, 0, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.ids, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        self.docs += 1
        if self.held >= self.length * BATCH_SEQUENCES:
            self._write(False)
        if len(self.rows) >= 10_000:
            self._write_docs()

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        # all batches but the last are full, so that a sequence's batch follows from its number
        step = self.length if last else self.length * BATCH_SEQUENCES
        whole = len(flat) // step * step
        real = len(flat) if last else whole
        if last and real > whole:
            whole += self.length
            flat = np.concatenate([flat, np.zeros(whole - real, self.dtype)])
        if whole:
            ids = pa.FixedSizeListArray.from_arrays(pa.array(flat[:whole]), self.length)
            mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(whole) < real), self.length)
            for k in range(0, len(ids), BATCH_SEQUENCES):
                self.writer.write_batch(pa.record_batch(
                    [ids.slice(k, BATCH_SEQUENCES), mask.slice(k, BATCH_SEQUENCES)], schema=self.schema))
        self.waiting = [] if last else [flat[whole:].copy()]
        self.held = 0 if last else len(flat) - whole

    def _write_docs(self) -> None:
        columns = list(zip(*self.rows)) or [[], [], []]
        self.docs_writer.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=self.docs_schema))
        self.rows = []

    def close(self) -> tuple[str, int, int]:
        self._write(True)
        self._write_docs()
        for x in (self.writer, self.file, self.docs_writer, self.docs_file):
            x.close()
        return self.name, self.docs, self.ids


def write_shards(docs: DataFrame, path: str, end_id: int, folder: str, length: int = LENGTH, text: str = "text",
                 doc_id: str = "doc_id", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards under ``folder`` (shared by all executors); returns their list, in a staged table.

    Columns: part, number (shards in order of these two), shard, n_docs, n_ids, base (ids in all shards before).
    Ids that are equal lie side by side in no defined order; null ids come first. The id is an integer.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(parts, F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, done = TaskContext.get().partitionId(), None, []
        files, base = fs.FileSystem.from_uri(folder)
        dtype = encoder(path).dtype
        files.create_dir(base, recursive=True)
        for batch in batches:
            for one, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, end_id)):
                if shard is not None and shard.ids >= shard_ids:
                    done.append(shard.close())
                    shard = None
                if shard is None:
                    shard = _Shard(files, base, part, dtype, length)
                shard.add(one, ids)
        if shard is not None:
            done.append(shard.close())
        names, n_docs, n_ids = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32()),
             pa.array([f"{folder}/{n.rpartition('/')[2]}" for n in names], pa.string()),
             pa.array(n_docs, pa.int64()), pa.array(n_ids, pa.int64())],
            names=["part", "number", "shard", "n_docs", "n_ids"])

    made = stage_table(rows.mapInArrow(run, "part int, number int, shard string, n_docs long, n_ids long"), "token-shards")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)   # a row for each shard only
    return stage_table(made.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-shards")


def _open(uri: str):
    files, path = fs.FileSystem.from_uri(uri)
    return ipc.open_file(pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path))


def read_sequence(shard: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence k of a shard."""
    batch = _open(f"{shard}.arrow").get_batch(k // BATCH_SEQUENCES)
    row = batch.slice(k % BATCH_SEQUENCES, 1)
    return row.column("ids").flatten().to_numpy(), row.column("mask").flatten().to_numpy(zero_copy_only=False)


def documents_of(shard: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, start, ids) of a shard's documents, read batch by batch."""
    tokens, docs = _open(f"{shard}.arrow"), _open(f"{shard}.docs.arrow")
    number, first, flat = -1, 0, np.zeros(0, np.uint16)
    for b in range(docs.num_record_batches):
        index = docs.get_batch(b)
        for one, start, n in zip(*(index.column(c).to_pylist() for c in range(3))):
            parts, at = [], start
            while at < start + n:
                while at >= first + len(flat):
                    number, first = number + 1, first + len(flat)
                    flat = tokens.get_batch(number).column("ids").flatten().to_numpy()
                end = min(start + n, first + len(flat))
                parts.append(flat[at - first:end - first])
                at = end
            yield one, start, (parts[0] if len(parts) == 1 else np.concatenate(parts))


def read_documents(shards: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files; ``start`` counts over all shards."""
    rows = shards.select("shard", "base").repartition(max(1, shards.count()))
    names = [doc_id, "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = []
                for one, start, ids in documents_of(shard):
                    out.append((one, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return rows.mapInArrow(run, f"`{doc_id}` long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, path: str, end_id: int, folder: str | None = None, length: int = LENGTH,
                     text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the shards (to a new folder of the shared one by default) and read the documents back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_shards(docs, path, end_id, folder, length, text, doc_id), doc_id)
