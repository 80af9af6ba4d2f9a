"""WARC records in ZIP packages, read by ranges without extracting anything.

A package holds two stored members: ``archive/data.warc.gz``, one gzip member per
record, and ``indexes/index.cdxj``, a line per record with its place. The reader parses the
end of the file, the ZIP64 records where there are any and the central directory, finds where
the stored members begin, and fetches runs of records by offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import written
from threadlake.session import shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DEDUP_BYTES = 1000
PACKAGE_BYTES = 1 << 28
RANGE_BYTES = 4 << 20
_KINDS = {"response": "application/http; msgtype=response", "revisit": "application/http; msgtype=response"}


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``uri`` and the path in it; a plain path is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class Member(NamedTuple):
    """A member of a package: where its local header stands, its size and its method."""

    header: int
    size: int
    method: int


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """Sizes and offset, with those marked as too large taken from the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            field = extra[at + 4 : at + 4 + length]
            numbers = iter(struct.unpack(f"<{length // 8}Q", field[: length // 8 * 8]))
            size = next(numbers) if size == 0xFFFFFFFF else size
            packed = next(numbers) if packed == 0xFFFFFFFF else packed
            header = next(numbers) if header == 0xFFFFFFFF else header
        at += 4 + length
    return size, packed, header


def read_directory(file: BinaryIO, size: int) -> dict[str, Member]:
    """The members of a package of ``size`` bytes, from its central directory."""
    tail_at = max(0, size - 65_557 - 20)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
        (record,) = struct.unpack_from("<Q", tail, locator + 8)
        file.seek(record)
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    file.seek(start)
    directory = file.read(length)
    members, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, full = struct.unpack_from("<II", directory, at + 20)
        name_n, extra_n, comment_n = struct.unpack_from("<HHH", directory, at + 28)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + name_n].decode("utf-8")
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        full, packed, header = _wide(extra, full, packed, header)
        members[name] = Member(header, packed, method)
        at += 46 + name_n + extra_n + comment_n
    return members


def data_start(file: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin: after its local header."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError("only stored members can be read by ranges")
    file.seek(member.header)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    name_n, extra_n = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + name_n + extra_n


def record_bytes(row: dict, date: str) -> bytes:
    """A WARC record of one page, as a gzip member of its own."""
    kind = "response" if row["refers_to"] is None else "revisit"
    body = HTTP_HEAD if kind == "revisit" else HTTP_HEAD + row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(row['page_id'])}",
        f"WARC-Date: {date}",
        f"Content-Type: {_KINDS[kind]}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if row["url"] is not None:
        target = "".join(c if c >= " " else f"%{ord(c):02X}" for c in row["url"])
        head.append(f"WARC-Target-URI: {target}")
    if kind == "revisit":
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(row['refers_to'])}",
            # An extension field: what a reader would otherwise need the response for.
            f"X-Payload-Length: {row['bytes']}",
        ]
    head.append(f"Content-Length: {len(body)}")
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    record_type: str
    refers_to: int | None
    payload: bytes
    payload_bytes: int
    payload_digest: str


def parse_record(raw: bytes) -> Record:
    """One record from its decompressed bytes; a response's payload is measured anew."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    kind = fields["WARC-Type"]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = len(payload)
    if kind == "revisit":
        size = int(fields["X-Payload-Length"])
    elif hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    refers = fields.get("WARC-Refers-To")
    return Record(
        page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind,
        page_of(refers) if refers else None, payload, size, digest,
    )


class Package:
    """A package being written to a stream; nothing but its index is held."""

    def __init__(self, folder: str, date: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, inner = filesystem(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.date, self.size, self.lines = date, 0, []

    def add(self, row: dict) -> None:
        raw = record_bytes(row, self.date)
        self.data.write(raw)
        self.lines.append(
            json.dumps({"id": record_id(row["page_id"]), "offset": self.size, "length": len(raw)})
        )
        self.size += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines), self.size


def with_revisits(
    df: DataFrame, id_column: str, url_column: str, html_column: str, least: int = DEDUP_BYTES
) -> DataFrame:
    """``page_id, url, payload, digest, bytes, refers_to``; the last is null for responses.

    Of rows with equal payloads of at least ``least`` bytes, those with the largest id are
    responses. Digests are grouped with a map-side maximum; the join of the rows with
    the repeated digests is one that can be split where a digest is hot.
    """
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    winners = (
        rows.where(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("_winner"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _winner IS NOT NULL")
        .select("digest", "_winner")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("_winner"))
    return rows.join(winners, "digest", "left").select(
        "page_id", "url",
        # What a revisit refers to is not stored again, nor sent to the writer.
        F.when(F.col("_winner").isNull() | ~revisit, F.col("payload")).alias("payload"),
        "digest", "bytes",
        F.when(F.col("_winner").isNotNull() & revisit, F.col("_winner")).alias("refers_to"),
    )


def write_packages(
    df: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    package_bytes: int = PACKAGE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for each row; returns the manifest ``path, records, bytes``.

    Every attempt of a task writes to names of its own, and the manifest, itself a
    committed table, lists those of the attempts that succeeded: a lost executor leaves
    files that nothing refers to. A null html is an empty payload, a null url has no
    target line, a null id is kept as such; repeated rows with the largest id are
    responses each; an empty table gives an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(n)[i].as_py() for n, name in enumerate(batch.schema.names)}
                package = package or Package(folder, date)
                package.add(row)
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            paths, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "records", "bytes"],
            )

    rows = with_revisits(df, id_column, url_column, html_column)
    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "packages")


def locate_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Runs of records of about ``range_bytes``: ``path, at, lengths``.

    Only the directory and the index of each package are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = filesystem(path)
                with system.open_input_file(inner) as file:
                    members = read_directory(file, file.size())
                    base = data_start(file, members[DATA])
                    file.seek(data_start(file, members[INDEX]))
                    lines = file.read(members[INDEX].size).decode().splitlines()
                runs: list[tuple[int, list[int]]] = []
                room = 0
                for entry in map(json.loads, lines):
                    if room <= 0:
                        runs.append((base + entry["offset"], []))
                        room = range_bytes
                    runs[-1][1].append(entry["length"])
                    room -= entry["length"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(runs)),
                        pa.array([r[0] for r in runs], pa.int64()),
                        pa.array([r[1] for r in runs], pa.list_(pa.int64())),
                    ],
                    names=["path", "at", "lengths"],
                )

    return manifest.select("path").mapInArrow(run, "path string, at long, lengths array<long>")


RECORD_FIELDS = (
    "page_id long, url string, record_type string, refers_to long, payload binary, "
    "payload_bytes long, payload_digest string"
)


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of all packages of ``manifest``, each run fetched by one ranged read."""
    names = [f.split()[0] for f in RECORD_FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, inner = filesystem(path)
                with system.open_input_file(inner) as file:
                    file.seek(at)
                    raw = file.read(sum(lengths))
                records, place = [], 0
                for length in lengths:
                    records.append(parse_record(zlib.decompress(raw[place : place + length], 31)))
                    place += length
                    if not with_payload:
                        records[-1] = records[-1]._replace(payload=b"")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in records], f.type) for i, f in enumerate(arrow)],
                    schema=arrow,
                )

    arrow = pa.schema(
        list(
            zip(
                names,
                (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()),
            )
        )
    )
    ranges = locate_ranges(manifest)
    rows = ranges.repartition(F.col("path"), F.col("at")).mapInArrow(run, RECORD_FIELDS)
    return rows if with_payload else rows.drop("payload")


def run_folder(spark) -> str:
    """A new folder for packages below the shared folder."""
    return f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}"
