"""WARC records in ZIP packages: written in bounded packages, read by range without extraction.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, which names each record's place in the archive.
A reader parses the end of the file, the ZIP64 end if there is one, and the central directory; it
then knows where in the file the members' bytes are and reads single records by offset and length.

Tasks write and read packages through ``pyarrow.fs``, so the folder is any that its file systems
reach from all executors: a shared mount, HDFS or an object store.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import own_shuffle
from cohortry.llm.common import pick, utf8
from cohortry.sources.results import Workspace

#: A package is closed once its records take so many bytes, so memory and tasks stay bounded.
PACKAGE_BYTES = 16 << 20
#: Tasks that read packages, for each shuffle partition of the session, at most.
TASKS_PER_PARTITION = 4
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORDS = (
    "record_id string, uri string, type string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)

# Fixed values of the ZIP format.
_END, _END64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ENTRY, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_END_BYTES, _LONGEST_COMMENT, _LOCAL_BYTES, _ENTRY_BYTES = 22, 65535, 30, 46
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_ZIP64_EXTRA = 1

# Fixed values of the WARC format.
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_ID = "<urn:page:{}>"


@dataclass(frozen=True)
class Member:
    """A stored member: where its bytes are in the package."""

    start: int
    size: int


def members(file: pa.NativeFile) -> dict[str, Member]:
    """The members of a ZIP file by name, from its central directory.

    Only directories are read: the end of the file and each member's local header. A compressed
    member is an error, as its bytes can't be read by range.
    """
    offset, size, count = _directory(file)
    data, at, found = _range(file, offset, size), 0, {}
    for _ in range(count):
        if data[at : at + 4] != _ENTRY:
            raise ValueError("not a central directory entry")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, full, names, extras, comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        flags = struct.unpack_from("<H", data, at + 8)[0]
        name = data[at + _ENTRY_BYTES : at + _ENTRY_BYTES + names]
        extra = data[at + _ENTRY_BYTES + names : at + _ENTRY_BYTES + names + extras]
        full, packed, header = _widened(extra, full, packed, header)
        text = name.decode("utf-8" if flags & 0x800 else "cp437")
        if not text.endswith("/"):
            if method != zipfile.ZIP_STORED or full != packed:
                raise ValueError(f"member {text} is compressed; only stored members can be read by range")
            local = _range(file, header, _LOCAL_BYTES)
            if local[:4] != _LOCAL:
                raise ValueError(f"no local header of {text}")
            # The local name and extra field may be longer than the directory's.
            own_name, own_extra = struct.unpack_from("<HH", local, 26)
            found[text] = Member(header + _LOCAL_BYTES + own_name + own_extra, full)
        at += _ENTRY_BYTES + names + extras + comment
    return found


def _directory(file: pa.NativeFile) -> tuple[int, int, int]:
    """Offset, size and number of entries of the central directory."""
    total = file.size()
    tail_at = max(0, total - _END_BYTES - _LONGEST_COMMENT)
    tail = _range(file, tail_at, total - tail_at)
    at = tail.rfind(_END)
    while at >= 0:  # a comment may hold the signature; the real end's comment reaches the file's end
        if at + _END_BYTES <= len(tail):
            comment = struct.unpack_from("<H", tail, at + 20)[0]
            if at + _END_BYTES + comment == len(tail):
                break
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory; not a ZIP file")
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    if _FULL16 != count and _FULL32 not in (size, offset):
        return offset, size, count
    where = tail_at + at - 20
    locator = _range(file, where, 20) if where >= 0 else b""
    if locator[:4] != _LOCATOR64:
        return offset, size, count  # the numbers happen to be the largest ones
    end_at = struct.unpack_from("<Q", locator, 8)[0]
    end = _range(file, end_at, 56)
    if end[:4] != _END64:
        raise ValueError("no ZIP64 end of central directory")
    count, size, offset = struct.unpack_from("<QQQ", end, 32)
    return offset, size, count


def _widened(extra: bytes, *numbers: int) -> list[int]:
    """Size, packed size and offset; those too large for 32 bits are in the ZIP64 extra field."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_EXTRA:
            wide = extra[at + 4 : at + 4 + length]
        at += 4 + length
    found, at = [], 0
    for number in numbers:
        if number == _FULL32 and at + 8 <= len(wide):
            number = struct.unpack_from("<Q", wide, at)[0]
            at += 8
        found.append(number)
    return found


def _range(file: pa.NativeFile, start: int, size: int) -> bytes:
    data = file.read_at(size, start)
    if len(data) != size:
        raise ValueError("the package ends too early")
    return data


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_bytes(id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; a revisit leaves the payload out and says how long it is."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _ID.format(id),
        "WARC-Date": _DATE,
        "WARC-Target-URI": url and url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": refers_to is not None and _REVISIT,
        "WARC-Refers-To": refers_to is not None and _ID.format(refers_to),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """A record's row. A response's payload is checked against the digest that it names."""
    fields, block = _headers(data)
    block = block[: int(fields["content-length"])]
    http, payload = _headers(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and base32(hashlib.sha1(payload).digest()) != digest:
        raise ValueError(f"record {fields['warc-record-id']} is damaged")
    return {
        "record_id": _named(fields["warc-record-id"]),
        "uri": fields.get("warc-target-uri"),
        "type": fields["warc-type"],
        "refers_to": _named(fields["warc-refers-to"]) if revisit else None,
        "payload_digest": digest,
        "payload_bytes": int(http["content-length"]) if revisit else len(payload),
        "payload": None if revisit else payload,
    }


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {n.lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}, rest


def _named(urn: str) -> str | None:
    prefix, suffix = _ID.split("{}")
    return urn.removeprefix(prefix).removesuffix(suffix) or None


def package(records: Iterable[tuple[str, bytes]]) -> bytes:
    """A package of ``(record id, record)``, with its index."""
    archive, index = io.BytesIO(), []
    for id, record in records:
        packed = gzip.compress(record, compresslevel=6, mtime=0)
        place = {"id": id, "offset": archive.tell(), "length": len(packed), "filename": ARCHIVE}
        index.append(f"{id} {_DATE} {json.dumps(place)}\n")
        archive.write(packed)
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w", zipfile.ZIP_STORED) as out:
        out.writestr(zipfile.ZipInfo(ARCHIVE), archive.getbuffer())
        out.writestr(zipfile.ZipInfo(INDEX), "".join(index).encode())
    return whole.getvalue()


def read_package(file: pa.NativeFile) -> Iterator[dict]:
    """The records that the package's indexes name, each read by its range."""
    found = members(file)
    for name, index in found.items():
        if not name.startswith("indexes/"):
            continue
        for line in _range(file, index.start, index.size).splitlines():
            place = json.loads(line.split(b" ", 2)[2])
            archive = found[place["filename"]]
            if place["offset"] + place["length"] > archive.size:
                raise ValueError("the index names a record beyond its archive")
            yield parse_record(gzip.decompress(_range(file, archive.start + place["offset"], place["length"])))


def references(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``(of, digest, refers_to)`` for the rows that repeat the payload of a larger id.

    Of equal payloads of at least ``min_bytes`` the largest id's is the response. Only ids and
    digests move here; a payload that very many pages share is reduced to one row per task before
    the shuffle, and its pages' rows meet the response in a join that can be split.
    """
    thin = pages.where(F.octet_length("payload") >= min_bytes).select("id", "digest").distinct()
    largest = thin.groupBy(F.col("digest").alias("same")).agg(F.max("id").alias("refers_to"))
    largest = largest.where("refers_to is not null").withColumn("place", F.xxhash64("same"))
    same = (F.xxhash64("digest") == F.col("place")) & (F.col("digest") == F.col("same"))
    repeats = thin.join(own_shuffle(largest, "place"), same)
    return repeats.where("id is null or id <> refers_to").select(
        F.col("id").alias("of"), F.col("digest").alias("its"), "refers_to"
    )


def known_uri(uri: str) -> str:
    """The URI by the one name that S3 has outside of Spark."""
    scheme, mark, rest = uri.partition("://")
    return f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI."""
    return fs.FileSystem.from_uri(known_uri(uri))


def write_packages(
    pages: DataFrame,
    work: Workspace,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Writes a record per row of ``pages`` and returns ``(package, records)`` of the packages
    written.

    Null html is an empty payload, a null URL is left out of its record. Rows without id get
    records without one, which refer to the largest id with their payload or, if there is none, are
    responses. Repeated rows of the largest id are all responses. Each task names its packages
    anew, and the returned table lists those of tasks that succeeded, so a repeated task leaves no
    record twice. An empty table writes nothing.
    """
    rows = pick(pages, id=id, url=url, html=html)
    rows = rows.select("id", "url", utf8("html").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    known = references(rows, min_bytes)
    joined = rows.join(
        known, F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("its")), "left"
    ).select(F.col("id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    folder = f"{work.root}/packages"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        store.create_dir(root)
        task, held, size, number = TaskContext.get(), [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number}.zip"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(package(held))
            return pa.record_batch([[f"{folder}/{name}"], [len(held)]], ["package", "records"])

        for batch in batches:
            for page, address, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = base32(hashlib.sha1(payload).digest())
                record = record_bytes(page or "", address, payload, digest, refers_to)
                held.append((page or "", record))
                size += len(record)
                if size >= PACKAGE_BYTES:
                    yield close()
                    held, size, number = [], 0, number + 1
        if held:
            yield close()

    return work.keep(joined.mapInArrow(run, "package string, records long"), "manifest")


def read_packages(packages: DataFrame) -> DataFrame:
    """The records of all packages that the column ``package`` names, one row each.

    Each task reads its packages one after the other, so memory doesn't grow with their number.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = store_of(path)
                with store.open_input_file(place) as file:
                    rows, size = [], 0
                    for row in read_package(file):
                        rows.append(row)
                        size += len(row["payload"] or b"")
                        if size >= PACKAGE_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    # Spark would put such few short rows into one task. Packages are of similar size, so dealing
    # them out by number is fair.
    partitions = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(packages.count(), TASKS_PER_PARTITION * partitions))
    return packages.select("package").repartition(tasks).mapInArrow(run, RECORDS)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    names = list(rows[0])
    return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)
