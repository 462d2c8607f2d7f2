"""WARC archives: writing, normalising monolithic gzip, reading by offset.

An archive that was compressed as a whole must be inflated from its start to reach any record. The normaliser
reads such a file once, as a stream, finds the record bounds in it, writes every record as a gzip member of
its own, and beside the archive an index with each record's offset and length. Readers then inflate single
members. Neither a file nor a record is ever held whole: bodies pass through in pieces.

Tasks write to names of their own and report them; files of lost or repeated tasks are on no list.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import scratch_path, stage_table

ARCHIVE_BYTES = 64 << 20       # of records before compression, in one archive
REVISIT_BYTES = 1000           # shorter payloads are stored each time
LEVEL = 6
PIECE = 1 << 20
DATE = "2024-01-01T00:00:00Z"  # of all records; the pages carry no time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31                     # zlib's window bits for gzip


def record_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, payload, digest, original): ``original`` is the page that a revisit refers to, else null.

    Of equal payloads of at least REVISIT_BYTES the largest id is stored, the others refer to it.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = (rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.max("id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    joined = rows.hint("merge").join(copies, "digest", "left")
    return joined.withColumn("original", F.when(~F.col("original").eqNullSafe(F.col("id")), F.col("original")))


def record(one: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if original is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {_urn(one)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=-._~%')}")
    if original is not None:
        head += [f"WARC-Refers-To: {_urn(original)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _urn(one: int | None) -> str:
    return f"<urn:page:{'' if one is None else quote(str(one))}>"


def _of_urn(text: str) -> int | None:
    name = unquote(text.strip("<>").rpartition(":")[2])
    return int(name) if name else None


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``record_types`` as archives that are one gzip stream each; returns their list (path)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        part, out, packer, size, done = TaskContext.get().partitionId(), None, None, 0, []
        for batch in batches:
            for one, url, payload, digest, original in zip(*(c for c in batch.columns)):
                if out is not None and size >= archive_bytes:
                    out.write(packer.flush())
                    out.close()
                    out = None
                if out is None:
                    done.append(f"{part:06d}-{uuid.uuid4().hex}.warc.gz")
                    out, size = files.open_output_stream(f"{base}/{done[-1]}", compression=None), 0
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
                data = record(one.as_py(), url.as_py(), payload.as_py(), digest.as_py(), original.as_py())
                size += len(data)
                out.write(packer.compress(data))
        if out is not None:
            out.write(packer.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in done], pa.string())], names=["path"])

    rows = records.select("id", "url", "payload", "digest", "original")
    return stage_table(rows.mapInArrow(run, "path string"), "warc-archives")


class _Inflated:
    """The content of a gzip file, members one after another, read in pieces."""

    def __init__(self, file):
        self.file, self.buffer, self.at, self.ended = file, bytearray(), 0, False
        self.unpack = zlib.decompressobj(_GZIP)

    def _more(self) -> bool:
        while not self.ended:
            raw = self.unpack.unconsumed_tail or self.unpack.unused_data
            if self.unpack.eof:
                raw = self.unpack.unused_data or self.file.read(PIECE)
                if not raw:
                    self.ended = True
                    break
                self.unpack = zlib.decompressobj(_GZIP)
            elif not raw:
                raw = self.file.read(PIECE)
                if not raw:
                    raise ValueError(f"gzip stream ends early, after {self.at} bytes of content")
            got = self.unpack.decompress(raw, PIECE)
            if got:
                self.buffer += got
                return True
        return False

    def head(self) -> bytes | None:
        """The next record's head up to its empty line; None at the end."""
        while True:
            while self.buffer[:2] == b"\r\n":
                self._drop(2)
            cut = self.buffer.find(b"\r\n\r\n")
            if cut >= 0 and self.buffer[:2] != b"\r\n":
                return bytes(self._drop(cut + 4))
            if not self._more():
                if bytes(self.buffer).strip():
                    raise ValueError(f"record head ends early, after {self.at} bytes of content")
                return None

    def body(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError(f"record body ends early, after {self.at} bytes of content")
            got = bytes(self._drop(min(n, len(self.buffer))))
            n -= len(got)
            yield got

    def _drop(self, n: int) -> bytearray:
        out = self.buffer[:n]
        del self.buffer[:n]
        self.at += n
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise_file(source: str, target: str) -> int:
    """Rewrite one archive with a member for each record, and ``target``.idx beside it; returns the records."""
    (files, path), (out_files, out_path) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
    n = offset = 0
    with files.open_input_stream(path, compression=None) as raw, \
            out_files.open_output_stream(out_path, compression=None) as out, \
            out_files.open_output_stream(f"{out_path}.idx", compression=None) as index:
        content = _Inflated(raw)
        while (head := content.head()) is not None:
            fields = _fields(head)
            packer, size = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP), 0

            def put(data: bytes) -> int:
                out.write(data)
                return len(data)

            size += put(packer.compress(head))
            for piece in content.body(int(fields.get("content-length", 0))):
                size += put(packer.compress(piece))
            size += put(packer.compress(b"\r\n\r\n") + packer.flush())
            row = {"offset": offset, "length": size, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"),
                   "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest")}
            index.write((json.dumps(row) + "\n").encode())
            offset += size
            n += 1
    return n


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise all archives (path), each in one task; returns the list of new ones (path, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = source.rpartition("/")[2].removesuffix(".gz").removesuffix(".warc")
                target = f"{folder}/{name}-{uuid.uuid4().hex[:8]}.warc.gz"
                n = normalise_file(source, target)
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], names=["path", "records"])

    rows = archives.select("path").repartition(max(1, archives.count()))
    return stage_table(rows.mapInArrow(run, "path string, records long"), "warc-normal")


def read_records(path: str, pieces: int = 8 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head, body) of a normalised archive's records, each inflated alone at its indexed place."""
    files, at = fs.FileSystem.from_uri(path)
    with files.open_input_file(at) as data, files.open_input_stream(f"{at}.idx", compression=None) as raw:
        rest = b""
        while True:
            chunk = raw.read(pieces)
            lines = (rest + chunk).split(b"\n")
            rest = lines.pop()
            for line in lines:
                row = json.loads(line)
                member = zlib.decompress(data.read_at(row["length"], row["offset"]), _GZIP)
                cut = member.index(b"\r\n\r\n") + 4
                yield _fields(member[:cut]), member[cut:-4]
            if not chunk:
                return


def read_pages(archives: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every record of normalised archives.

    A response's payload is measured and hashed anew and held against the digest in its head; a revisit's
    length is the one its stored HTTP head names, its digest that of the record's head.
    """
    names = [page_id, "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                out = []
                for head, body in read_records(path):
                    cut = body.index(b"\r\n\r\n") + 4
                    stated = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if head["warc-type"] == "response":
                        n, digest, refers = len(body) - cut, hashlib.sha1(body[cut:]).hexdigest(), None
                        if digest != stated:
                            raise ValueError(f"{path}: payload of {head['warc-record-id']} doesn't match its digest")
                    else:
                        http = dict(x.lower().split(b": ", 1) for x in body[:cut - 4].split(b"\r\n")[1:])
                        n, digest, refers = int(http[b"content-length"]), stated, _of_urn(head["warc-refers-to"])
                    out.append((_of_urn(head["warc-record-id"]), n, digest, head["warc-type"], refers))
                ids, sizes, digests, types, refs = zip(*out) if out else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                     pa.array(types, pa.string()), pa.array(refs, pa.int64())], names=names)

    rows = archives.select("path").repartition(max(1, archives.count()))
    return rows.mapInArrow(run, f"`{page_id}` long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
                  html: str = "html") -> DataFrame:
    """Write pages as monolithic archives, normalise these, and read the records back.

    Ids are integers. Null html is an empty payload; a null url leaves the target out; null ids give records
    without a number. Rows that repeat the largest id of a group of copies are all responses.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    made = write_archives(record_types(pages, page_id, url, html), f"{folder}/whole")
    return read_pages(normalise(made, f"{folder}/members"), page_id)
