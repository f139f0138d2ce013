"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record, checked when read.

Writing: each task turns its rows into archives in the shared folder, named after its partition. It trains a dictionary on the first
records of each archive (at most SAMPLE_BYTES of them; none where that is fewer than 16 records), writes it as a compressed skippable frame, then one frame per record, under a
name of its own, and moves the finished file to its place: a task that is run again puts the same file there again. Of pages with
equal payloads of at least `revisit_bytes` bytes, the one with the largest id is a response record; the others are revisit records
that refer to it and hold only the HTTP headers. Equal payloads are found by digest on narrow rows; the pages are not shuffled.

Reading: tasks stream the files, load the dictionary, decode frame by frame and check for each record the version line, the mandatory
headers, that the length fits, that the record ends the frame, and the digest of a response's payload. A record that fails raises
ValueError with the file and the record's number.

Defined results: null html is an empty payload, a null url has no target header, a null page_id no id (read back as null). Rows that
share the largest id of a payload are all responses, as are equal payloads without any id. Extra columns are not read. Folders may
lie on any file system that pyarrow can open by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyline.llm.store import new_path, small_or_not, written

SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
REVISIT_BYTES, ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES, CHUNK = 1000, 256 << 20, 2 << 20, 64 << 10, 1 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest")


def _clean(value: str) -> str:
    """No control characters in headers; they are written as percent signs and two digits."""
    return "".join(c if c > "\x1f" and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit if refers_to is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    if refers_to is None:
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode(record: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, the payload's full length and the payload (empty for a revisit) of a checked record."""

    def check(good: bool, what: str) -> None:
        if not good:
            raise ValueError(what)

    def headers(part: bytes) -> dict[str, str]:
        pairs = [line.partition(b":") for line in part.split(b"\r\n")[1:]]
        check(all(sep for _, sep, _ in pairs), "header line without colon")
        return {k.decode().strip().lower(): v.decode().strip() for k, _, v in pairs}

    head, cut, rest = record.partition(b"\r\n\r\n")
    check(bool(cut) and head.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")), "no version line or end of headers")
    found = headers(head)
    check(all(found.get(k) for k in NEEDED), "mandatory header missing")
    check(found["content-length"].isdigit() and len(rest) == int(found["content-length"]) + 4, "content length does not fit")
    check(rest.endswith(b"\r\n\r\n"), "record does not end with two line ends")
    http, cut, payload = rest[:-4].partition(b"\r\n\r\n")
    check(bool(cut) and http.startswith(b"HTTP/"), "no HTTP headers")
    length = headers(http).get("content-length", "")
    check(length.isdigit(), "no payload length")
    kind = found["warc-type"]
    check(kind in ("response", "revisit"), "unknown record type")
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        check(len(payload) == int(length), "payload length does not fit")
        check(found["warc-payload-digest"] == f"sha1:{digest}", "payload digest does not fit")
    else:
        check(not payload and bool(found.get("warc-refers-to")), "revisit with payload or without reference")
    return found, int(length), payload


def _dictionary(sample: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample) if len(sample) >= 16 else None
    except zstandard.ZstdError:  # too little in the sample to learn from
        return None


def write_archive(out: pa.NativeFile, records: Iterable[bytes]) -> int:
    """Write one archive; the first records are held back until the dictionary is made. Returns the number of records."""
    held: list[bytes] = []
    size = n = 0
    pack = None

    def start() -> zstandard.ZstdCompressor:
        words = _dictionary(held)
        if words is None:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        packed = zstandard.compress(words.as_bytes())
        out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        words.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True)

    for record in records:
        n += 1
        if pack is None:
            held.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                pack = start()
                out.write(b"".join(pack.compress(r) for r in held))
                held = []
        else:
            out.write(pack.compress(record))
    if held:
        pack = start()
        out.write(b"".join(pack.compress(r) for r in held))
    return n


def read_archive(source: pa.NativeFile) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """The checked records of one archive, one after the other; only the current record is held."""
    held = source.read(8)
    words = None
    if len(held) == 8 and struct.unpack("<II", held)[0] == SKIPPABLE:
        size = struct.unpack("<II", held)[1]
        content = source.read(size)
        if len(content) != size:
            raise ValueError("dictionary frame cut off")
        try:
            words = zstandard.ZstdCompressionDict(zstandard.decompress(content) if content[:4] == FRAME else content)
        except zstandard.ZstdError as error:
            raise ValueError(f"dictionary frame: {error}") from error
        held = b""
    plain = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()
    n = 0
    while held or (held := source.read(CHUNK)):
        n += 1
        frame, parts = plain.decompressobj(), []
        while not frame.eof:
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as error:
                raise ValueError(f"record {n}: {error}") from error
            held = frame.unused_data if frame.eof else source.read(CHUNK)
            if not held and not frame.eof:
                raise ValueError(f"record {n}: frame cut off")
        try:
            yield decode(b"".join(parts))
        except ValueError as error:
            raise ValueError(f"record {n}: {error}") from error


def write_pages(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives into a folder; returns the written manifest (path, records)."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html"))
    long = pages.where(F.octet_length("html") >= revisit_bytes).select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest"))
    same = long.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null")
    same = written(same.select("digest", "kept"), "equal-payloads")
    keyed = pages.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).join(small_or_not(same), "digest", "left")
    other = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("kept")), F.col("kept"))
    rows = keyed.select("page_id", "url", "html", F.when(F.octet_length("html") >= revisit_bytes, other).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        rest = (
            encode(*row)
            for batch in batches
            for row in zip(
                batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), (h.encode() for h in batch.column("html").to_pylist()),
                batch.column("refers_to").to_pylist(), strict=True,
            )
        )

        def until_full(first: bytes) -> Iterator[bytes]:
            size = len(first)
            yield first
            while size < archive_bytes and (record := next(rest, None)) is not None:
                size += len(record)
                yield record

        number = 0
        while (first := next(rest, None)) is not None:
            name = f"{root}/pages-{part:06d}-{number:05d}.warc.zst"
            own = f"{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(own, compression=None) as out:
                n = write_archive(out, until_full(first))
            system.move(own, name)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name.rpartition('/')[2]}"], "records": [n]})
            number += 1

    return written(rows.mapInArrow(write, "path string, records long"), "manifest")


def read_pages(archives: DataFrame) -> DataFrame:
    """All records of the archives named in `path`: page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to and the
    payload (null for a revisit)."""

    def number(value: str) -> int | None:
        digits = value.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            system, name = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with system.open_input_stream(name, compression=None) as source:
                try:
                    for found, length, payload in read_archive(source):
                        digest = base64.b32decode(found["warc-payload-digest"].removeprefix("sha1:")).hex()
                        refers = number(found["warc-refers-to"]) if "warc-refers-to" in found else None
                        kind = found["warc-type"]
                        rows.append((number(found["warc-record-id"]), found.get("warc-target-uri"), length, digest, kind, refers, payload if kind == "response" else None))
                        size += len(payload)
                        if size > 8 * CHUNK or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)
                            rows, size = [], 0
                except ValueError as error:
                    raise ValueError(f"{path}: {error}") from error
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    paths = archives.select("path")
    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(read, fields)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives into the shared folder and read them back: one row per page, without the payloads."""
    folder = new_path(pages.sparkSession, "warc")
    return read_pages(write_pages(pages, folder)).drop("payload", "url")


def oracle(revisit_bytes: int = REVISIT_BYTES) -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
k AS (SELECT *, CASE WHEN payload_bytes >= {revisit_bytes} THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS kept FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM k"""
