"""WARC archives as a chunked record table.

Archives are written by tasks into a shared folder through the file system of its address, and read
back as a stream: each payload becomes rows of (record, chunk number, bytes), with the digest of the
payload so far carried from chunk to chunk, so no record is ever held whole by the reader. The writer
slices the payload it is given without copying it.

A payload that occurs in several records of a set is stored once, by the record with the largest id;
the others are revisits that name it. Null payloads count as empty. Records of equal id and payload are
all responses if theirs is the largest id. A null id is smaller than any other.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import folder, stored

CHUNK = 256 * 1024
_ROLL = 256 * 1024 * 1024  # an archive that has grown beyond this is closed and a new one begun
_FILES = "path string, records bigint, bytes bigint"
_FILES_ARROW = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_CHUNKS = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_bytes bigint, payload_digest string, "
    "chunk int, data binary, digest_so_far string, last boolean"
)
_CHUNKS_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("digest_so_far", pa.string()), ("last", pa.bool_())]
)


def _base32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if urlsplit(path).scheme else (fs.LocalFileSystem(), path)


def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(id, url, payload) with ``refers_to``: the id of the record that stores the same payload, null where it is stored.

    Payloads are compared by SHA-1 and size, worked out where the rows are; partial maxima
    keep a payload that many rows share from meeting in one task. The table of revisits is
    written first, so that Spark knows its size: it is broadcast below Spark's threshold and
    joined by a shuffle beyond it.
    """
    body = F.coalesce(F.col("payload"), F.lit("").cast("binary"))
    keys = records.select("id", F.sha1(body).alias("digest"), F.octet_length(body).alias("size")).where(F.col("size") >= least_bytes)
    stores = keys.groupBy("digest", "size").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisits = stored(keys.join(stores, ["digest", "size"]).where("NOT id <=> refers_to").select(F.col("id").alias("visit"), "digest", "refers_to").distinct(), "revisits")
    # the digest tells apart rows that repeat an id with another payload
    matches = records["id"].eqNullSafe(revisits["visit"]) & (F.sha1(body) == revisits["digest"])
    return records.join(revisits, matches, "left").drop("visit", "digest")


class _Writer:
    """One archive: gzip members, one per record."""

    def __init__(self, target: str):
        self._name = f"{target}/{uuid.uuid4().hex}.warc.gz"
        self._fs, path = _opened(self._name)
        self._out = self._fs.open_output_stream(path, compression=None)
        self.records = self.size = 0

    def record(self, head: list[tuple[str, str]], block_head: bytes, payload: memoryview) -> None:
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        length = len(block_head) + len(payload)
        lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(length))])
        self._put(squeeze.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block_head))
        for at in range(0, len(payload), CHUNK):
            self._put(squeeze.compress(payload[at : at + CHUNK]))
        self._put(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self._out.close()
        return self._name, self.records, self.size


def write_archives(pages: DataFrame, target: str, record_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write every row as a record; returns the files (path, records, bytes) that hold them.

    File names are unique per attempt, and only files that a finished task returns are in the
    result, so a task that runs again leaves unread files but no double records.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            ids, urls, refers, bodies = batch.columns
            for i in range(batch.num_rows):
                if writer is None:
                    _opened(target)[0].create_dir(_opened(target)[1])
                    writer = _Writer(target)
                me, to, body = ids[i].as_py(), refers[i].as_py(), bodies[i].as_buffer()
                data = memoryview(body) if body is not None else memoryview(b"")
                head = [("WARC-Type", "response" if to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if me is None else me}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
                if (at := urls[i].as_py()) is not None:
                    head.append(("WARC-Target-URI", re.sub(r"[\r\n]+", " ", at)))
                head.append(("WARC-Payload-Digest", f"sha1:{_base32(hashlib.sha1(data))}"))
                if to is not None:
                    head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{to}>")]
                head.append(("Content-Type", "application/http;msgtype=response"))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode()
                writer.record(head, http, data if to is None else memoryview(b""))
                if writer.size > _ROLL:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _FILES_ARROW)] if done else [pa.array([], f.type) for f in _FILES_ARROW], schema=_FILES_ARROW)

    own = pages.select(F.col(record_id).alias("id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("binary").alias("payload"))
    rows = mark_revisits(own, least_bytes).select(F.col("id").cast("string"), "url", F.col("refers_to").cast("string"), "payload")
    return stored(rows.mapInArrow(write, _FILES), "archives")


class _Stream:
    """The bytes of an archive, inflated as they are asked for."""

    def __init__(self, path: str):
        where, name = _opened(path)
        self._in = where.open_input_stream(name, compression=None)
        self._inflate, self._left, self._have = zlib.decompressobj(31), b"", bytearray()

    def _more(self) -> bool:
        if self._inflate.eof:
            self._left = self._inflate.unused_data or self._left
            self._inflate = zlib.decompressobj(31)
        data = self._left or self._in.read(64 * 1024)
        if not data:
            return False
        self._have += self._inflate.decompress(data, CHUNK)
        self._left = self._inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is passed over; None at the end."""
        at = 0
        while (found := self._have.find(mark, at)) < 0:
            at = max(0, len(self._have) - len(mark))
            if not self._more():
                return None
        out = bytes(self._have[:found])
        del self._have[: found + len(mark)]
        return out

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes, none only at the end."""
        while not self._have:
            if not self._more():
                return b""
        out = bytes(self._have[:most])
        del self._have[:most]
        return out


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page(uri: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.*)>", uri or "", re.S)
    return found[1] or None if found else None


def records(stream: _Stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of one archive, in order. A revisit has one row, without data."""
    while (block := stream.until(b"\r\n\r\n")) is not None:
        head = _fields(block)
        left = int(head["content-length"])
        http = stream.until(b"\r\n\r\n")
        left -= len(http) + 4
        size = int(_fields(http)["content-length"])
        stated = head["warc-payload-digest"].partition(":")[2]
        common = (_page(head["warc-record-id"]), head["warc-type"], head.get("warc-target-uri"), _page(head.get("warc-refers-to")), size, stated)
        running, number = hashlib.sha1(), 0
        if head["warc-type"] == "revisit" or not left:
            yield (*common, 0, b"", stated if head["warc-type"] == "revisit" else _base32(running), True)
        while left:
            data = stream.take(min(chunk, left))
            if not data:
                raise ValueError(f"record {common[0]} ends {left} bytes early")
            left -= len(data)
            running.update(data)
            yield (*common, number, data, _base32(running), not left)
            number += 1
        stream.until(b"\r\n\r\n")
        if head["warc-type"] == "response" and _base32(running) != stated:
            raise ValueError(f"record {common[0]} does not have the digest it states")


def read_chunks(files: DataFrame, with_data: bool = True) -> DataFrame:
    """The record table of archives; ``with_data=False`` leaves out the bytes, not the digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in records(_Stream(path)):
                    rows.append(row if with_data else (*row[:7], None, *row[8:]))
                    held += len(row[7]) if with_data else 64
                    if held > 8 * CHUNK:
                        yield _to_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _to_batch(rows)

    # one file a task: a file is the unit that is read in sequence
    spread = files.select("path").repartition(max(1, files.count()))
    return spread.mapInArrow(read, _CHUNKS)


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNKS_ARROW)], schema=_CHUNKS_ARROW)


def round_trip(pages: DataFrame, record_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` and read the archives back: the last chunk row of every record, without data."""
    files = write_archives(pages, folder(pages.sparkSession, "warc"), record_id, url, payload, least_bytes)
    return read_chunks(files, with_data=False).where("last")
