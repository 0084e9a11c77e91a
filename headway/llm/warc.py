"""WARC archives with a two-level capture index.

Pages become WARC records, one gzip member each, in files below a shared folder. The index has two levels: lines sorted
by a URL key with the host reversed, in compressed blocks of ``BLOCK_LINES``; and for each index file a sparse directory
with the first key and the place of each block. A lookup bisects the files' first keys, then a directory, reads one block
by its range, bisects its lines, and the capture found there is read from its archive by its range.

Files are named after the task attempt that wrote them. Only those of attempts whose rows were committed are ever named in
a table, so a lost executor or a repeated task leaves no wrong entry behind.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Batches, stored
from headway.llm.url_filters import ascii_lower
from headway.session import fresh_dir

MIN_REVISIT_BYTES = 0
BLOCK_LINES = 512
FILE_BYTES = 1 << 28
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS_AT_ONCE = 2048
KEYS_PER_TASK = 1 << 17
BYTES_PER_TASK = 1 << 24  # compressed


# --- Files in the shared folder


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that every executor reaches, and the folder's path in it."""
    if ":/" in folder:
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


def _attempt_name(prefix: str, number: int, suffix: str) -> str:
    task = TaskContext.get()
    return f"{prefix}-{task.partitionId():06d}-{task.taskAttemptId()}-{number}{suffix}"


class RollingFile:
    """Appends compressed members; a new file is begun when one is full."""

    def __init__(self, folder: str, prefix: str, suffix: str):
        self.fs, self.folder = open_folder(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.prefix, self.suffix = prefix, suffix
        self.number, self.offset, self.name, self.stream = -1, 0, "", None

    def append(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.offset >= FILE_BYTES:
            self.close()
            self.number, self.offset = self.number + 1, 0
            self.name = _attempt_name(self.prefix, self.number, self.suffix)
            self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        at = self.offset
        self.stream.write(data)
        self.offset += len(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


class RangeReader:
    """Reads ranges of files, keeping the last file open."""

    def __init__(self, folder: str):
        self.fs, self.folder = open_folder(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.folder}/{name}")
        self.file.seek(offset)
        return self.file.read(length)


# --- Records


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _header_value(text: str) -> str:
    """Control characters, which would break the header, percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit has the headers of the full payload, not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": RECORD_DATE,
        "WARC-Target-URI": None if url is None else _header_value(url),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": _record_id(refers_to) if revisit else None,
        "X-Page-ID": page_id,
        "X-Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return gzip.compress(f"WARC/1.0\r\n{head}\r\n".encode() + block + b"\r\n\r\n", 6, mtime=0)


def read_record(member: bytes) -> dict:
    """The fields of a record; the digest of a response is computed from its payload and compared with the header's."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
    }


# --- Archives


def url_key(url: str | Column) -> Column:
    """``com,example,www)/path?query``: labels of the host reversed, so that a site's pages sort together."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.coalesce(url, F.lit("")))
    labels = F.split(ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), r"\.")
    return F.concat(F.array_join(F.reverse(labels), ","), F.lit(")"), F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record for each row and return the stored captures (url_key, page_id, file, offset, length).

    Of equal payloads of at least ``min_bytes``, that of the smallest ``page_id`` is a response and the others revisit
    it. Rows that repeat a page are responses alike. A row without an id revisits where another has one, and is a
    response otherwise. Null pages have an empty payload.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= min_bytes
    first = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"))
    refers = F.when(large & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    decided = rows.join(first, "digest", "left").select("page_id", "url", "html", url_key("url").alias("url_key"), refers.alias("refers_to"))

    def run(batches: Batches) -> Batches:
        archive = RollingFile(folder, "capture", ".warc.gz")
        for batch in batches:
            names = ["page_id", "url", "html", "refers_to"]
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            places = [archive.append(write_record(p, u, h.encode(), r)) for p, u, h, r in zip(*columns)]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in ("url_key", "page_id")]
            files, offsets, lengths = zip(*places) if places else ((), (), ())
            arrays = [*kept, pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["url_key", "page_id", "file", "offset", "length"])
        archive.close()

    schema = "url_key string, page_id bigint, file string, offset bigint, length bigint"
    return stored(decided.mapInArrow(run, schema), "captures")


# --- Index

Key = tuple[str, int, int]


def _key(url_key: str, page_id: int | None) -> Key:
    return url_key, 0 if page_id is None else 1, page_id or 0


def _line(url_key: str, page_id: int | None, file: str, offset: int, length: int) -> bytes:
    return json.dumps([url_key, page_id, file, offset, length], ensure_ascii=False, separators=(",", ":")).encode()


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[dict]:
    """Write the sorted index; returns its top level: for each index file its directory and its first key.

    The top level has one entry for each task of the sort, or more where a file would grow beyond its limit.
    """
    order = ["url_key", "page_id", "file", "offset"]
    placed = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Batches) -> Batches:
        blocks = RollingFile(folder, "index", ".cdx.gz")
        directory: list[list] = []
        pending: list[tuple[Key, bytes]] = []

        def flush(count: int) -> None:
            lines, first = pending[:count], pending[0][0]
            del pending[:count]
            directory.append([first, *blocks.append(gzip.compress(b"\n".join(line for _, line in lines), 6, mtime=0))])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                pending.append((_key(row[0], row[1]), _line(*row)))
                if len(pending) >= block_lines:
                    flush(block_lines)
        if pending:
            flush(len(pending))
        blocks.close()
        if directory:
            listing = RollingFile(folder, "directory", ".json.gz")
            name, _, _ = listing.append(gzip.compress(json.dumps(directory).encode(), 6, mtime=0))
            listing.close()
            arrays = [pa.array([name]), pa.array([json.dumps(directory[0][0])])]
            yield pa.RecordBatch.from_arrays(arrays, names=["directory", "first_key"])

    wanted = placed.select("url_key", "page_id", "file", "offset", "length")
    top = stored(wanted.mapInArrow(run, "directory string, first_key string"), "index-top")
    entries = [{"directory": row["directory"], "first": tuple(json.loads(row["first_key"]))} for row in top.collect()]
    return sorted(entries, key=lambda entry: (entry["first"], entry["directory"]))


class CaptureIndex:
    """Finds lines by key; holds one directory for each index file it has lately used, and one block."""

    def __init__(self, folder: str, top: list[dict]):
        self.reader, self.top = RangeReader(folder), top
        self.firsts = [entry["first"] for entry in top]
        self.directory = lru_cache(maxsize=4)(self._directory)
        self.block = lru_cache(maxsize=2)(self._block)

    def _directory(self, place: int) -> tuple[list[Key], list[list]]:
        fs, folder = self.reader.fs, self.reader.folder
        with fs.open_input_stream(f"{folder}/{self.top[place]['directory']}", compression=None) as stream:
            entries = json.loads(gzip.decompress(stream.read()))
        return [tuple(entry[0]) for entry in entries], entries

    def _block(self, name: str, offset: int, length: int) -> tuple[list[Key], list[list]]:
        lines = [json.loads(x) for x in gzip.decompress(self.reader.read(name, offset, length)).split(b"\n")]
        return [_key(line[0], line[1]) for line in lines], lines

    def find(self, url_key: str, page_id: int | None) -> Iterator[list]:
        """All lines of the key, over as many blocks and files as they run through."""
        key = _key(url_key, page_id)
        # The file and block before the first that begins at the key may already hold it.
        for place in range(max(bisect_left(self.firsts, key) - 1, 0), bisect_right(self.firsts, key)):
            firsts, entries = self.directory(place)
            for entry in entries[max(bisect_left(firsts, key) - 1, 0) : bisect_right(firsts, key)]:
                keys, lines = self.block(*entry[1:])
                yield from lines[bisect_left(keys, key) : bisect_right(keys, key)]


def look_up(keys: DataFrame, folder: str, top: list[dict]) -> DataFrame:
    """(page_id, file, offset, length) of all captures of distinct keys (url_key, page_id).

    A null key finds the captures of pages without a url; a null page_id those without one; keys that were never written
    find nothing; no keys give an empty table.
    """
    distinct = stored(keys.distinct(), "capture-keys")
    parts = max(1, -(-distinct.count() // KEYS_PER_TASK))
    placed = distinct.repartitionByRange(parts, "url_key", "page_id").sortWithinPartitions("url_key", "page_id")

    def run(batches: Batches) -> Batches:
        index = CaptureIndex(folder, top)
        found: list[list] = []

        def rows() -> pa.RecordBatch:
            kinds = pa.int64(), pa.string(), pa.int64(), pa.int64()
            arrays = [pa.array([line[i + 1] for line in found], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["page_id", "file", "offset", "length"])

        for batch in batches:
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for line in index.find(url, page):
                    found.append(line)
                    if len(found) >= ROWS_AT_ONCE:
                        yield rows()
                        found.clear()
        if found:
            yield rows()

    schema = "page_id bigint, file string, offset bigint, length bigint"
    return placed.select("url_key", "page_id").mapInArrow(run, schema)


def read_captures(places: DataFrame, folder: str) -> DataFrame:
    """The records at the given ranges, read in the order of the archives; payloads come as text."""
    # By the bytes that are to be read: the places themselves are tiny, and Spark would read them all in one task.
    total = places.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // BYTES_PER_TASK))
    placed = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    schema = (
        "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint"
    )
    kinds = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches: Batches) -> Batches:
        reader = RangeReader(folder)
        for batch in batches:
            ranges = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for start in range(0, len(ranges), 256):
                records = [read_record(reader.read(*place)) for place in ranges[start : start + 256]]
                for record in records:
                    record["payload"] = None if record["payload"] is None else record["payload"].decode()
                yield pa.RecordBatch.from_pylist(records, schema=kinds)

    return placed.select("file", "offset", "length").mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages to archives, index them, look every page up and return its record as read back.

    One row for each row of ``pages``; an empty table gives an empty one; other columns are ignored.
    """
    folder = fresh_dir(pages.sparkSession, "warc")
    captures = write_archives(pages, folder)
    top = write_index(captures, folder)
    keys = pages.select(url_key("url").alias("url_key"), F.col("page_id").cast("bigint").alias("page_id"))
    places = stored(look_up(keys, folder, top), "capture-places")
    return read_captures(places, folder)
