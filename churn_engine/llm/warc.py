"""WARC archives compressed record by record with a dictionary that stands in a leading skippable frame.

Each archive trains a Zstandard dictionary from records of its own, writes it as a skippable frame, and then one frame
per record, so any record can be read alone and other readers of dictionary-compressed WARC can open the file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.llm.common import in_slices, shared_folder, small_batches, store

#: Fixed value: the frame number that marks a dictionary in dictionary-compressed WARC.
DICTIONARY_FRAME = 0x184D2A5D
#: Bytes of payload in an archive, of records that the dictionary is built from, and of the dictionary.
ARCHIVE_BYTES, TRAINING_BYTES, DICTIONARY_BYTES = 64 << 20, 1 << 20, 32 << 10
#: Smaller payloads are never revisits.
LEAST_REVISIT = 1000
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, kind: str, size: int) -> bytes:
    """A revisit has no payload of its own, but the digest and ``size`` of the one it repeats."""
    body = HTTP + payload if kind == "response" else HTTP
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest} {kind}')}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": _clean(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": str(size),
        "X-Page": "" if page is None else str(page),
        **({"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page": str(refers_to)} if kind == "revisit" else {}),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; of too few or too equal ones to learn from, the last bytes are the dictionary as they are."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 4))
    for steps in ({"k": 256, "d": 8}, {"k": 64, "d": 6}):
        try:
            return zstandard.train_dictionary(size, samples, **steps)
        except zstandard.ZstdError:
            continue
    return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    def __init__(self, path: str):
        self.path = path
        self.files, self.inner = fs.FileSystem.from_uri(path)
        self.out = None
        self.waiting: list[bytes] = []
        self.records = self.payload = self.held = 0

    def add(self, raw: bytes) -> None:
        self.records += 1
        self.payload += len(raw)
        if self.out is None:
            self.waiting.append(raw)
            self.held += len(raw)
            if self.held >= TRAINING_BYTES:
                self._begin()
        else:
            self.out.write(self.squeeze.compress(raw))

    def _begin(self) -> None:
        learned = dictionary(self.waiting)
        self.out = self.files.open_output_stream(self.inner, compression=None)
        raw = learned.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        self.squeeze = zstandard.ZstdCompressor(level=3, dict_data=learned, write_checksum=True)
        for raw in self.waiting:
            self.out.write(self.squeeze.compress(raw))
        self.waiting = []

    def close(self) -> tuple[str, int]:
        if self.out is None:
            self._begin()
        self.out.close()
        return self.path, self.records


def read_archive(path: str) -> Iterator[bytes]:
    """The records of an archive, read piece by piece."""
    files, inner = fs.FileSystem.from_uri(path)
    with files.open_input_stream(inner, compression=None) as source:
        data = source.read(8)
        learned = None
        if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
            raw = b""
            size = struct.unpack("<I", data[4:])[0]
            while len(raw) < size:
                raw += source.read(size - len(raw))
            learned, data = zstandard.ZstdCompressionDict(raw), b""
        expand = zstandard.ZstdDecompressor(dict_data=learned)
        reader, parts = expand.decompressobj(), []
        while True:
            if not data:
                data = source.read(1 << 20)
                if not data:
                    break
            parts.append(reader.decompress(data))
            data = b""
            if reader.eof:
                data = reader.unused_data
                yield b"".join(parts)
                reader, parts = expand.decompressobj(), []


def _written(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each attempt writes files of its own; only those of the attempt that succeeds are in the returned list.
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        writer, done = None, []
        for batch in in_slices(batches, "html"):
            columns = {c: batch.column(c).to_pylist() for c in ("page", "url", "html", "digest", "refers_to", "kind", "size")}
            for page, url, html, digest, refers_to, kind, size in zip(*columns.values(), strict=True):
                if writer is None:
                    writer = ArchiveWriter(f"{name}-{len(done):04d}.warc.zst")
                writer.add(record(page, url, (html or "").encode(), digest, refers_to, kind, size))
                if writer.payload >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["archive", "records"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row below ``folder`` and return the list of archives: ``archive, records``.

    Of records with equal payloads of at least 1000 bytes, that with the largest page id holds the payload, the others
    are revisits without one. Payloads are compared by SHA-256 and length; the groups are formed on digests, and rows
    find theirs by a join Spark can split, so a payload that a third of all pages share is no single task.

    Defined cases: null html is an empty payload; null urls are written empty; a null id is smaller than any other; rows that repeat the
    group's largest id all hold the payload; an empty table writes nothing; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.sha1(body).alias("digest"), F.sha2(body, 256).alias("own")
    )
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= LEAST_REVISIT
    groups = rows.where(large).groupBy("own").agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    told = rows.join(groups, "own", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page").eqNullSafe(F.col("refers_to"))
    told = told.withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
    files, inner = fs.FileSystem.from_uri(folder)
    files.create_dir(inner, recursive=True)
    size = F.octet_length(F.coalesce("html", F.lit(""))).alias("size")
    own = F.when(F.col("kind") == "response", F.col("html")).alias("html")
    told = told.select("page", "url", own, "digest", "refers_to", "kind", size)
    return store(told.mapInArrow(_written(folder, archive_bytes), "archive string, records long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            rows: list[dict] = []
            for raw in read_archive(path):
                rows.append(_told(*parse(raw)))
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROW)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_ROW)


_ROW = pa.schema(
    [("page", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _told(fields: dict[str, str], block: bytes) -> dict:
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if kind == "response":
        payload = block[len(HTTP) :]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record of page {fields['X-Page']} does not hold what its header says")
    return {
        "page": int(fields["X-Page"]) if fields["X-Page"] else None,
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["X-Refers-To-Page"]) if kind == "revisit" else None,
    }


def read_archives(archives: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per record of the listed archives: ``id_col, payload_bytes, payload_digest, record_type, refers_to, url``. Payloads are checked
    against their digests."""
    listed = archives.select("archive")
    # A row of the list is a few bytes and an archive many: as many tasks as archives, which no coalescing joins.
    told = listed.repartition(max(1, listed.count()), "archive")
    schema = "page long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return told.mapInArrow(_read, schema).select(F.col("page").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def archive_and_read(pages: DataFrame) -> DataFrame:
    return read_archives(write_archives(pages, shared_folder(pages.sparkSession)))
