"""WARC records in ZIP packages: written from pages, read back by range.

A package is a ZIP file of stored (uncompressed) members: archives
``archive/data-NNNNN.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one JSON line per record with its archive, offset and
length.  Because archives are stored, a record's place in the package is the
member's data offset plus the index's offset, and it is read alone, without
unpacking anything.

Packages are written and read by the tasks, through the file system that the
target folder's URI names; a task that is run again writes new files, and only
files whose row reached the stored list are read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import shared_dir, stored

REVISIT_BYTES = 1000
#: Sizes at which an archive member and a package are closed, and records read by one range.
MEMBER_BYTES, PACKAGE_BYTES, RANGE_RECORDS = 16 << 20, 1 << 30, 500
#: Stored bytes that a reading task has at least, and at most.
READ_BYTES = 1 << 20, 64 << 20
#: More groups of equal payloads than this are joined by shuffle, not broadcast.
BROADCAST_GROUPS = 100_000
INDEX = "indexes/index.cdxj"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder's URI (file, hdfs, s3, gs, ...)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


# ---------------------------------------------------------------- records

def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty), payload_digest, record_type, refers_to.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` the one with the
    largest page_id is a response and the others revisit it; all else are
    responses.  Rows that repeat that page_id are responses too.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    long = rows.where(F.octet_length("html") >= REVISIT_BYTES)
    groups = long.groupBy(F.col("payload_digest").alias("_d")).agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 AND _first IS NOT NULL")
    groups = stored(groups.select("_d", "_first"), "payloads")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, F.col("payload_digest") == F.col("_d"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.select("page_id", "url", "html", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("_first")).alias("refers_to"))


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record.  A revisit has the HTTP header of the whole payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(identifier: str | None) -> int | None:
    digits = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse_record(data: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes]:
    """page_id, url, payload bytes, payload digest, type, refers_to, payload of a record; a wrong digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    size = int(_headers(http)["content-length"])
    if warc["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{warc['warc-record-id']}: the payload does not match its digest")
    return _page(warc["warc-record-id"]), warc.get("warc-target-uri"), size, digest, warc["warc-type"], _page(warc.get("warc-refers-to")), payload


# ---------------------------------------------------------------- writing

class _Package:
    """One ZIP package under way: records gather in an archive member, members are stored as they fill."""

    def __init__(self, folder: fs.FileSystem, path: str):
        self.path, self.size, self.records = path, 0, 0
        self.stream = folder.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.members, self.index = io.BytesIO(), 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        data = gzip.compress(record, 4, mtime=0)
        name = f"archive/data-{self.members:05d}.warc.gz"
        self.index.append(json.dumps({"page": page_id, "filename": name, "offset": self.member.tell(), "length": len(data)}))
        self.member.write(data)
        self.records += 1
        self.size += len(data)
        if self.member.tell() >= MEMBER_BYTES:
            self._store()

    def _store(self) -> None:
        self.zip.writestr(zipfile.ZipInfo(f"archive/data-{self.members:05d}.warc.gz"), self.member.getvalue())
        self.member, self.members = io.BytesIO(), self.members + 1

    def close(self) -> tuple[str, int, int]:
        if self.member.tell():
            self._store()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index).encode())
        self.zip.close()
        self.stream.close()
        return self.path, self.size, self.records


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``with_record_types`` under ``folder`` (a URI all executors share); stored (path, bytes, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        package, done = None, []
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, html, digest, kind, refers_to = (x.as_py() for x in row)
                if package is None:
                    package = _Package(system, f"{root}/{uuid.uuid4().hex}.wacz")
                package.add(page_id, record_bytes(page_id, url, html.encode(), digest, kind, refers_to))
                if package.size >= PACKAGE_BYTES:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        if done:
            path, size, n = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(size, pa.int64()), pa.array(n, pa.int64())], names=["path", "bytes", "records"])

    return stored(records.mapInArrow(write, "path string, bytes long, records long"), "packages")


# ---------------------------------------------------------------- reading

def _at(f: BinaryIO, offset: int, size: int) -> bytes:
    f.seek(offset)
    data = f.read(size)
    if len(data) < size:
        raise ValueError("the package is shorter than its directory says")
    return data


def members(f: BinaryIO, size: int) -> dict[str, tuple[int, int]]:
    """Name to (data offset, length) of the stored members of a ZIP file, from its central directory (ZIP64 too)."""
    tail_at = max(0, size - (1 << 16) - 22)
    tail = _at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if locator >= 0 and (found := _at(f, locator, 20))[:4] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", found, 8)[0]
        if (record := _at(f, at, 56))[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = _at(f, start, length), 0, {}
    for _ in range(entries):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        offset = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n].decode()
        field, until = at + 46 + n, at + 46 + n + extra
        while field + 4 <= until:
            kind, width = struct.unpack_from("<HH", directory, field)
            if kind == 1:  # ZIP64: only the values that did not fit, in this order
                values = iter(struct.unpack_from(f"<{width // 8}Q", directory, field + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            field += 4 + width
        if method == 0:
            local = _at(f, offset, 30)
            out[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        at = until + comment
    return out


def index_ranges(f: BinaryIO, size: int) -> Iterator[tuple[list[int], list[int]]]:
    """Offsets in the package and lengths of the indexed records, in runs of neighbours in one archive."""
    held = members(f, size)
    offsets, lengths, name = [], [], None
    for line in filter(None, _at(f, *held[INDEX]).split(b"\n")):
        entry = json.loads(line)
        if offsets and (entry["filename"] != name or len(offsets) >= RANGE_RECORDS):
            yield offsets, lengths
            offsets, lengths = [], []
        name = entry["filename"]
        offsets.append(held[name][0] + entry["offset"])
        lengths.append(entry["length"])
    if offsets:
        yield offsets, lengths


def read_packages(packages: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of the packages at ``path``: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    One task lists a package's records; runs of ``RANGE_RECORDS`` are then dealt
    out evenly and each is read by one range.  ``payloads`` adds the payload
    (empty for revisits).
    """

    def list_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_file(path) as f:
                    runs = list(index_ranges(f, f.size()))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(runs), pa.string()), pa.array([o for o, _ in runs], longs), pa.array([n for _, n in runs], longs)],
                    names=["path", "offsets", "lengths"])

    def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")] + ["payload"] * payloads
        for batch in batches:
            for path, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_file(path) as f:
                    data = _at(f, offsets[0], offsets[-1] + lengths[-1] - offsets[0])
                rows = [parse_record(gzip.decompress(data[o - offsets[0]:o - offsets[0] + n]))[:len(types)] for o, n in zip(offsets, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    runs = packages.select("path").mapInArrow(list_records, "path string, offsets array<long>, lengths array<long>")
    # the runs are small whatever they point to: the number of tasks follows the stored bytes, and is given, or it would follow the runs'
    spread = runs.repartition(read_tasks(packages), F.xxhash64("path", F.get("offsets", F.lit(0))))
    return spread.mapInArrow(read_records, RECORD_SCHEMA + ", payload binary" * payloads)


def read_tasks(packages: DataFrame) -> int:
    """The tasks that read the records: four a core, but of ``READ_BYTES[0]`` stored bytes at least and ``READ_BYTES[1]`` at most."""
    size = packages.agg(F.sum("bytes")).first()[0] or 0
    cores = packages.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-size // READ_BYTES[0]), max(-(-size // READ_BYTES[1]), 4 * cores)))


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/packages-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` and read the packages back (columns of RECORD_SCHEMA).

    Null html is an empty payload, a null page_id or url stays null, rows that
    repeat a page_id give a record each, extra columns are not read, an empty
    table gives no rows.  A url's unprintable characters are percent-encoded.
    """
    folder = archive_folder(pages.sparkSession)
    return read_packages(write_packages(with_record_types(pages), folder), folder)
