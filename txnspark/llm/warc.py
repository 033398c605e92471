"""WARC archives written and read as chunks.

``write_archives`` writes one record per page to gzip archives, a gzip member for each record, into
the shared folder; tasks stream a payload into its record piece by piece. Of equal payloads of at
least ``MIN_REVISIT`` bytes, one is a response and the others are revisit records without payload.
Each task names its archives after itself and its attempt; the manifest, written by Spark, lists
those of the attempts that count, so files that a lost executor leaves behind are never read.

``chunk_table`` reads archives into rows of record and chunk number. A task holds one buffer of the
compressed file and one chunk, whatever the length of a record; each row carries the number of
bytes and the SHA-256 of the payload up to and with its chunk, the last one those of all of it.

Defined results: a null html is an empty payload; a null url is left out of the record. Of equal
payloads the smallest page_id is the response, rows that repeat it with it; rows without page_id
are responses only where no row of their payload has one. Other columns are not looked at. No pages
give no archives and no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import new_folder, written

MIN_REVISIT = 100
CHUNK_BYTES = 64 * 1024
ARCHIVE_BYTES = 512 * 1024 * 1024
BATCH_BYTES = 1024 * 1024
GZIP_LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, records long"
CHUNKS = pa.schema(
    [
        ("archive", pa.string()),
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("stated_digest", pa.string()),
        ("chunk_no", pa.int32()),
        ("chunk", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("is_last", pa.bool_()),
    ]
)
CHUNKS_DDL = (
    "archive string, record_id string, page_id long, record_type string, refers_to long, "
    "stated_digest string, chunk_no int, chunk binary, payload_bytes long, payload_digest string, "
    "is_last boolean"
)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(number) if number else None


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


class _Archive:
    """Writes records to one file, each in a gzip member of its own."""

    def __init__(self, folder: str, name: str):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.path, self.records, self.bytes = f"{folder}/{name}", 0, 0
        self.out = system.open_output_stream(f"{path}/{name}", compression=None)
        info = b"format: WARC File Format 1.1\r\n"
        head = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", DATE),
            ("Content-Type", "application/warc-fields"),
            ("Content-Length", str(len(info))),
        ]
        self._member([_head(head), info, END])

    def _member(self, parts) -> None:
        gz = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        for part in parts:
            for at in range(0, len(part), CHUNK_BYTES):
                piece = part[at : at + CHUNK_BYTES]
                self.out.write(gz.compress(piece))
                self.bytes += len(piece)
        self.out.write(gz.flush())

    def add(self, page_id, url, payload: memoryview, digest: str, refers_to) -> None:
        revisit = refers_to is not None
        http = (
            "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n"
        ).encode()
        size = len(http) + (0 if revisit else len(payload))
        head = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", DATE),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(size)),
        ]
        if url is not None:
            head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
        if revisit:
            head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
        self._member([_head(head), http, *([] if revisit else [payload]), END])
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.out.close()
        return self.path, self.records


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, done = TaskContext.get(), None, []
        for batch in batches:
            ids, urls, digests, refers = (
                batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")
            )
            payloads = batch.column("payload")
            for k in range(batch.num_rows):
                if archive is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    archive = _Archive(folder, name)
                archive.add(ids[k], urls[k], memoryview(payloads[k].as_buffer()), digests[k], refers[k])
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        paths, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"]
        )

    return write


def write_archives(
    pages: DataFrame, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html); the manifest: archive, records."""
    rows = pages.select(
        F.col("page_id").cast("long"),
        "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).select("*", F.sha2("payload", 256).alias("digest"))
    large = rows.filter(F.length("payload") >= min_revisit)
    repeated = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "first_id")
    )
    # written and merged at every size: repeated payloads grow with the input
    repeated = written(repeated, "repeated-payloads")
    again = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    planned = rows.join(repeated.hint("merge"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("first_id")).alias("refers_to")
    )
    folder = new_folder(pages.sparkSession, "archives")
    return written(planned.mapInArrow(_writer(folder, archive_bytes), MANIFEST), "archive-manifest")


class _Stream:
    """Bytes of a gzip file, taken as they are asked for."""

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_stream(inner, compression=None)
        self.gz, self.held, self.at, self.rest = zlib.decompressobj(31), b"", 0, b""

    def _more(self) -> bool:
        """Whether there is a byte to take."""
        while self.at == len(self.held):
            if self.gz.eof:
                self.rest, self.gz = self.gz.unused_data, zlib.decompressobj(31)
            if not self.rest:
                self.rest = self.file.read(CHUNK_BYTES)
                if not self.rest:
                    return False
            self.held, self.at = self.gz.decompress(self.rest, CHUNK_BYTES), 0
            self.rest = self.gz.unconsumed_tail
        return True

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes; nothing at the end."""
        if not self._more():
            return b""
        out = self.held[self.at : self.at + most]
        self.at += len(out)
        return out

    def exactly(self, size: int) -> bytes:
        parts = []
        while size:
            if not (part := self.take(size)):
                raise EOFError("the archive ends within a record")
            parts.append(part)
            size -= len(part)
        return b"".join(parts)

    def head(self) -> tuple[str, dict[str, str], int] | None:
        """First line, fields and length of a header block; None at the end."""
        out = bytearray()
        while not out.endswith(END):
            if not self._more():
                if out:
                    raise EOFError("the archive ends within a header")
                return None
            # up to the line end that may close the block
            cut = self.held.find(b"\n", self.at)
            out += self.take((cut if cut >= 0 else len(self.held)) + 1 - self.at)
        first, *lines = out[: -len(END)].decode().split("\r\n")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        return first, fields, len(out)


def _records(path: str) -> Iterator[dict]:
    """Chunk rows of one archive."""
    stream = _Stream(path)
    while (found := stream.head()) is not None:
        fields = found[1]
        left = int(fields["content-length"])
        if fields["warc-type"] not in ("response", "revisit"):
            stream.exactly(left + len(END))
            continue
        left -= stream.head()[2]
        row = {
            "archive": path,
            "record_id": fields["warc-record-id"],
            "page_id": _page(fields["warc-record-id"]),
            "record_type": fields["warc-type"],
            "refers_to": _page(fields.get("warc-refers-to")),
            "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
        }
        digest, size, number = sha256(), 0, 0
        while True:
            chunk = stream.exactly(min(left, CHUNK_BYTES))
            left -= len(chunk)
            size += len(chunk)
            digest.update(chunk)
            yield row | {
                "chunk_no": number,
                "chunk": chunk,
                "payload_bytes": size,
                "payload_digest": digest.hexdigest(),
                "is_last": not left,
            }
            number += 1
            if not left:
                break
        stream.exactly(len(END))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            for row in _records(path):
                held.append(row)
                size += len(row["chunk"]) + 200
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, CHUNKS)
                    held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, CHUNKS)


def chunk_table(manifest: DataFrame) -> DataFrame:
    """Rows of record and chunk number from the archives of a manifest."""
    paths = manifest.select("archive")
    # one archive a task
    spread = paths.repartition(max(1, paths.count()), "archive")
    return spread.mapInArrow(_read, CHUNKS_DDL)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A revisit has size and digest of the response that it refers to.
    """
    whole = chunks.filter("is_last").select(
        "page_id", "record_type", "refers_to", "stated_digest", "payload_bytes", "payload_digest"
    )
    whole = written(whole, "records")
    found = (
        whole.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated_digest"))
        .agg(F.max("payload_bytes").alias("first_bytes"))
    )
    revisit = F.col("record_type") == "revisit"
    return whole.join(found, ["refers_to", "stated_digest"], "left").select(
        "page_id",
        F.when(revisit, F.col("first_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        F.when(revisit, F.col("first_bytes").isNotNull())
        .otherwise(F.col("stated_digest") == F.col("payload_digest"))
        .alias("intact"),
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and read them back."""
    return records(chunk_table(write_archives(pages)))
