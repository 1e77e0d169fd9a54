"""WARC records inside ZIP archives: written by tasks, found by central directory and index, read by range.

Each task writes archives of bounded size. An archive stores, uncompressed by
ZIP, a WARC file of gzip members, one a record, and an index with the place of
each record. Reading takes two steps that are spread separately: the tail and
central directory of an archive lead to its members, and its index to record
places; records are then read by range in runs that lie together. Nothing is
extracted. Archives and members over 4 GB or 65535 members use ZIP64 fields.

Paths go through the file system of their scheme, so a folder on any store
that Arrow knows works from every executor. Only archives of committed tasks
are in the manifest; a task that is run again writes new files.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.session import fresh_path

#: Payloads below this are never revisits; bytes of WARC data in an archive; records in a run of reads.
LEAST_PAYLOAD, ARCHIVE_BYTES, RUN_RECORDS = 1000, 64 << 20, 64
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = "2024-01-01T00:00:00Z"


def deduplicated(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to: the response that a row revisits, null for responses.

    Of rows with equal html of at least ``LEAST_PAYLOAD`` bytes those with the
    largest page_id are responses.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    long_ = F.octet_length("html") >= LEAST_PAYLOAD
    latest = own.where(long_).groupBy("digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = own.join(latest, "digest", "left")
    return met.select("page_id", "url", "html", "digest", F.when(F.col("page_id") != F.col("latest"), F.col("latest")).alias("refers_to"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the store that Spark would use for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit keeps the HTTP headers and leaves out the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {_EPOCH}"]
    head += [f"WARC-Target-URI: {target}"] if target else []
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"] if revisit else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Archive:
    """One ZIP file being written: the WARC member first, the index at the end."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, place = _open(self.path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.file = store.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.written = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.member.write(data)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.written, "length": len(data)}))
        self.written += len(data)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        self.file.close()
        return self.path, len(self.index)


def written(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes archives of the rows of ``deduplicated`` under ``folder``; their manifest (path, records).

    The manifest must be stored (pinned) before it is used, so that each archive is written once.
    """
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in stream:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                archive = archive or _Archive(folder)
                archive.add(page_id, gzip_member(record_bytes(page_id, url, html.encode("utf-8"), digest, refers_to)))
                if archive.written >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [(), ()], schema)], schema=schema)

    return rows.mapInArrow(batches, "path string, records long")


def members(file) -> dict[str, tuple[int, int]]:
    """Name to (offset of the data, length) of the stored members of a ZIP file, from its central directory."""
    size = file.size()
    tail_at = max(0, size - 65_557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, at = struct.unpack("<H2I", tail[end + 10 : end + 20])
    if 0xFFFF == entries or 0xFFFFFFFF in (length, at):
        locator = tail[end - 20 : end]
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        file.seek(struct.unpack("<Q", locator[8:16])[0])
        entries, length, at = struct.unpack("<3Q", file.read(56)[32:56])
    file.seek(at)
    directory, out, place = file.read(length), {}, 0
    for _ in range(entries):
        if directory[place : place + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, place + 10)
        packed, plain, names, extras, comments = struct.unpack_from("<2I3H", directory, place + 20)
        local, = struct.unpack_from("<I", directory, place + 42)
        name = directory[place + 46 : place + 46 + names].decode()
        extra = directory[place + 46 + names : place + 46 + names + extras]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<2H", extra)
            if kind == 1:  # 64-bit values for the fields that are full, in this order
                longs = list(struct.unpack(f"<{width // 8}Q", extra[4 : 4 + width // 8 * 8]))
                plain = longs.pop(0) if plain == 0xFFFFFFFF else plain
                packed = longs.pop(0) if packed == 0xFFFFFFFF else packed
                local = longs.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + width :]
        if method == 0:
            file.seek(local)
            head = file.read(30)
            out[name] = (local + 30 + sum(struct.unpack("<2H", head[26:30])), packed)
        place += 46 + names + extras + comments
    return out


def indexed(manifest: DataFrame, run_records: int = RUN_RECORDS) -> DataFrame:
    """(path, offset, lengths): runs of record places that lie together, from the indexes of the archives."""
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for path in batch.column(0).to_pylist():
                store, place = _open(path)
                with store.open_input_file(place) as file:
                    found = members(file)
                    base = found[DATA][0]
                    at, length = found[INDEX]
                    file.seek(at)
                    places = [json.loads(line) for line in file.read(length).decode().split("\n") if line]
                places.sort(key=lambda p: p["offset"])
                runs: list[tuple[str, int, list[int]]] = []
                for p in places:
                    offset = base + p["offset"]
                    if runs and len(runs[-1][2]) < run_records and runs[-1][1] + sum(runs[-1][2]) == offset:
                        runs[-1][2].append(p["length"])
                    else:
                        runs.append((path, offset, [p["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*runs)) or [()] * 3, schema)], schema=schema)

    return manifest.select("path").mapInArrow(batches, "path string, offset long, lengths array<long>")


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and block of a WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _number(uri: str) -> int | None:
    digits = uri.strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload string"


def records(runs: DataFrame, with_payload: bool = True) -> DataFrame:
    """``RECORDS`` read by range; the digest of a response is computed from its payload and compared with its header.

    A revisit has no payload; its size comes from the HTTP header that it keeps.
    """
    ddl = RECORDS if with_payload else RECORDS.removesuffix(", payload string")
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for path, offset, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = _open(path)
                rows = []
                with store.open_input_file(place) as file:
                    file.seek(offset)
                    for length in lengths:
                        headers, block = parsed(zlib.decompress(file.read(length), 31))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        told = headers["warc-payload-digest"].removeprefix("sha1:")
                        size = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
                        response = headers["warc-type"] == "response"
                        if response and (hashlib.sha1(payload).hexdigest() != told or len(payload) != size):
                            raise ValueError(f"{path}: payload at {offset} does not match its digest")
                        row = (_number(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"],
                               _number(headers["warc-refers-to"]) if not response else None, size, told)
                        rows.append((*row, payload.decode() if response else None) if with_payload else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema)], schema=schema)

    return runs.mapInArrow(batches, ddl)


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) and reads all back as ``RECORDS``.

    A null html is an empty payload. A null page_id or url leaves its field
    empty; a page with a null id is always a response. Characters of a url that
    a header cannot hold are percent-encoded. Repeated rows are records of
    their own; all with the largest page_id are responses. No pages, no rows.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = _qualified(pages.sparkSession, fresh_path(pages.sparkSession, "archives"))
    manifest = scratch.pin(written(deduplicated(pages), folder))
    runs = scratch.pin(indexed(manifest.repartition("path")))
    return records(runs, with_payload)
