import hashlib
import io
import struct
import zipfile
import zlib

import pytest

from threadlake.llm import warc_zip
from threadlake.llm.warc_zip import DATA, INDEX, data_start, read_directory, read_packages, write_packages


def test_round_trip_with_revisits(spark, tmp_path):
    long, other = "é" * 600, "x" * 999
    rows = [
        (1, "http://a/1\r\nX: y", long), (7, None, long), (7, "http://a/7", long), (3, "http://a/3", long),
        (4, "u", other), (5, "u", other), (6, "u", None), (8, "u", ""), (None, "u", long), (9, "u", "z" * 300_000),
    ]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, payload_bytes int").repartition(3)
    manifest = write_packages(df, str(tmp_path / "warc"), package_bytes=1000)
    assert manifest.selectExpr("sum(records)").first()[0] == len(rows)
    got = read_packages(manifest).collect()
    assert len(got) == len(rows)
    want = []
    for page, url, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        refers = max(same) if len(raw) >= 1000 and page != max(same) and rows.count((page, url, html)) else None
        url = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
        want.append((page, url, "revisit" if refers else "response", refers, b"" if refers else raw, len(raw), hashlib.sha1(raw).hexdigest()))
    assert sorted(((*r[:4], bytes(r[4]), *r[5:]) for r in got), key=repr) == sorted(want, key=repr)
    assert read_packages(write_packages(df.limit(0), str(tmp_path / "none"))).count() == 0


def test_packages_are_plain_zip_files_of_stored_members(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id long, url string, html string")
    path = write_packages(df.coalesce(1), str(tmp_path / "w")).first().path
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None
        assert {m.filename: m.compress_type for m in package.infolist()} == {DATA: 0, INDEX: 0}
        data = package.read(DATA)
    with open(path, "rb") as file:
        size = file.seek(0, 2)
        member = read_directory(file, size)[DATA]
        file.seek(data_start(file, member))
        assert file.read(member.size) == data
    assert zlib.decompress(data[: len(data)], 31).startswith(b"WARC/1.1\r\n")


def test_zip64_directories(monkeypatch):
    """A package that claims more than 32 bits can hold is found through its ZIP64 records."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        package.writestr("first", b"a" * 50)
        package.writestr("second", b"b" * 60)
        package.comment = b"PK a comment"
    raw = out.getvalue()
    assert b"PK\x06\x06" in raw and struct.pack("<I", 0xFFFFFFFF) in raw
    members = read_directory(io.BytesIO(raw), len(raw))
    for name, content in (("first", b"a" * 50), ("second", b"b" * 60)):
        file = io.BytesIO(raw)
        file.seek(data_start(file, members[name]))
        assert file.read(members[name].size) == content


def test_what_is_no_package_is_an_error():
    with pytest.raises(ValueError):
        read_directory(io.BytesIO(b"no zip at all"), 13)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("x", b"a" * 500)
    member = read_directory(out, len(out.getvalue()))["x"]
    with pytest.raises(ValueError):
        data_start(out, member)


def test_damage_is_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "digest": hashlib.sha1(b"abd").hexdigest(), "bytes": 3, "refers_to": None}
    with pytest.raises(ValueError):
        warc_zip.parse_record(zlib.decompress(warc_zip.record_bytes(row, "d"), 31))
