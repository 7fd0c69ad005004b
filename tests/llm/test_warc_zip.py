import hashlib
import io
import struct
import zipfile

import pytest

from tallycast.llm import warc_zip as Z


def truth(rows):
    payload = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for page_id, data in payload:
        same = [p for p, d in payload if d == data and p is not None]
        first = max(same) if len(data) >= 1000 and same and len([1 for _, d in payload if d == data]) > 1 else None
        revisit = first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/x", "p" * 1000), (2, None, "p" * 1000), (3, "http://b\r\nX: y", "q" * 999), (4, "u", "q" * 999), (5, "u", None), (6, "u", ""), (None, "n", "p" * 1000),
        (7, "é", "ß" * 700 + "\r\n\r\n😀"), (8, "é", "ß" * 700 + "\r\n\r\n😀"), (8, "é", "ß" * 700 + "\r\n\r\n😀"), (9, "l", "long " * 500_000), (10, "z", "z" * 1000)]


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, payload_digest string, offset long").repartition(3)
    got = Z.round_trip(df).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == truth(ROWS)
    assert {r.url for r in got} >= {"http://b%0D%0AX: y", None, "é"}
    assert Z.round_trip(df.limit(0)).collect() == []


def test_packages_are_zip_files_of_warc_records(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    packages = Z.write_packages(Z.with_record_types(df), f"file://{tmp_path}")
    (path,) = [r.path for r in packages.collect()]
    with zipfile.ZipFile(path) as f:
        assert all(i.compress_type == zipfile.ZIP_STORED for i in f.infolist()) and f.testzip() is None
        import gzip
        records = gzip.decompress(f.read("archive/data-00000.warc.gz"))
        assert records.count(b"WARC/1.1\r\n") == len(ROWS)
        sizes = {i.filename: i.file_size for i in f.infolist()}
    with open(path, "rb") as f:
        size = f.seek(0, 2)
        assert {k: v[1] for k, v in Z.members(f, size).items()} == sizes
    rows = Z.read_packages(packages, f"file://{tmp_path}", payloads=True).collect()
    assert {bytes(r.payload) for r in rows if r.record_type == "response"} == {(h or "").encode() for _, _, h in ROWS}


def zip64(members):
    """A ZIP file whose sizes, offsets and directory are all in ZIP64 fields."""
    out, directory = io.BytesIO(), b""
    for name, data in members.items():
        at, n = out.tell(), name.encode()
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(n), 20) + n + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data)
        directory += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(n), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + n + extra
    start = out.tell()
    out.write(directory)
    end = out.tell()
    out.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, len(members), len(members), len(directory), start))
    out.write(struct.pack("<IIQI", 0x07064B50, 0, end, 1) + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
    return out.getvalue()


def test_reading_is_dealt_out_by_stored_bytes(spark, monkeypatch):
    """Also where adaptive execution would join the small table of ranges into one task."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(Z, "RANGE_RECORDS", 10)
    monkeypatch.setattr(Z, "READ_BYTES", (2_000, 1 << 20))
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.sha2(F.concat("id", i).cast("string"), 256))).alias("html"))
    out = Z.round_trip(pages)
    tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 300 and len(tasks) >= 4 and max(r["count"] for r in tasks) <= 150


def test_zip64_directory():
    data = {"archive/a.warc.gz": b"x" * 70_000, "b": b"", "c/ü": b"yz"}
    raw = zip64(data)
    places = Z.members(io.BytesIO(raw), len(raw))
    assert {k: raw[o:o + n] for k, (o, n) in places.items()} == data


def test_broken_files_are_errors():
    for raw in (b"", b"PK", zip64({"a": b"b"})[:-30]):
        with pytest.raises(ValueError):
            Z.members(io.BytesIO(raw), len(raw))
    record = Z.record_bytes(1, "u", b"payload", "0" * 40, "response", None)
    with pytest.raises(ValueError):
        Z.parse_record(record)
