"""WARC records in ZIP packages: write, list and range-read without extraction.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.jsonl`` (a line per record with
offset and length inside the member), both stored, not deflated. The reader takes the end of the package, follows the
end-of-central-directory record or its ZIP64 form to the central directory, finds the stored members, and reads records by
byte range. Files are opened through ``pyarrow.fs``, so any store that it knows by its URI works.

A payload of at least ``least_bytes`` that several records share is stored once, with the record of the largest id; the
others become revisit records that name it.

Defined cases: a null payload counts as empty; a null id is the smallest; rows that repeat the largest id of a payload are
all responses; a package written by a task that was lost is never listed, since only the manifest names packages; an empty
table gives no package and no record.
"""

from __future__ import annotations

import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import partitions, stored, utf8
from pricewatch.session import new_dir

#: Payload bytes after which a task opens the next package.
PACKAGE_BYTES = 64 * 1024 * 1024
#: Bytes that one range read covers, unless a single record is longer.
RANGE_BYTES = 4 * 1024 * 1024
LEAST_REVISIT_BYTES = 1000

# Fixed values of the ZIP format: signatures and sizes of the records that are read.
END, END_SIZE = b"PK\x05\x06", 22
LOCATOR, LOCATOR_SIZE = b"PK\x06\x07", 20
END64, END64_SIZE = b"PK\x06\x06", 56
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
MANIFEST = "package string, records long, bytes long"
RANGE = "package string, start long, size long, records long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, intact boolean"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---- one record


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record, gzipped: the HTTP head, and the payload unless the record is a revisit."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", json.dumps(url)[1:-1]))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{refers_to}')}>"),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
    return deflate.compress(text.encode() + block + b"\r\n\r\n") + deflate.flush()


def parse_record(blob: bytes) -> dict:
    """The fields, HTTP head and payload of one gzipped record."""
    raw = zlib.decompress(blob, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return {"fields": fields, "payload": payload, "payload_bytes": lengths[0]}


# ---- one package


class _Package:
    """Writes one package: records as they come, the index at the end."""

    def __init__(self, folder: str, force_zip64: bool = False):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = open_fs(folder)
        store.create_dir(path, recursive=True)
        self.out = store.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}")
        self.zip64 = force_zip64
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at = self.payload = 0
        self.index: list[str] = []

    def add(self, page_id, url, payload, digest, refers_to) -> None:
        blob = record_bytes(page_id, url, payload, digest, refers_to)
        self.data.write(blob)
        self.index.append(json.dumps({"offset": self.at, "length": len(blob), "page_id": page_id, "digest": digest}))
        self.at += len(blob)
        self.payload += len(payload)

    def close(self) -> dict:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=self.zip64) as out:
            out.write("".join(f"{x}\n" for x in self.index).encode())
        self.zip.close()
        self.out.close()
        return {"package": self.uri, "records": len(self.index), "bytes": self.at}


def _at(file, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, local header offset, stored size) of the members, from the central directory."""
    tail_at = max(0, size - END_SIZE - FULL16)
    tail = _at(file, tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<10xHII", tail, end)
    locator = tail_at + end - LOCATOR_SIZE
    if FULL16 == count or FULL32 in (length, start):
        found = _at(file, locator, LOCATOR_SIZE)
        if found[:4] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = _at(file, struct.unpack_from("<8xQ", found)[0], END64_SIZE)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<32xQQQ", record)
    entries, at, out = _at(file, start, length), 0, {}
    for _ in range(count):
        if entries[at : at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        method, packed, plain, name_n, extra_n, note_n, offset = struct.unpack_from("<10xH8xIIHHH8xI", entries, at)
        name = entries[at + ENTRY_SIZE : at + ENTRY_SIZE + name_n].decode()
        extra = entries[at + ENTRY_SIZE + name_n :][:extra_n]
        wide = [plain == FULL32, packed == FULL32, offset == FULL32]
        if any(wide):
            plain, packed, offset = _wide(extra, wide, [plain, packed, offset])
        out[name] = (method, offset, packed)
        at += ENTRY_SIZE + name_n + extra_n + note_n
    return out


def _wide(extra: bytes, wide: list[bool], values: list[int]) -> list[int]:
    """The 64-bit forms, in the extra field of kind 1, of those values that are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            longs = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return [next(longs) if w else v for w, v in zip(wide, values, strict=True)]
        at += 4 + n
    raise ValueError("ZIP64 sizes are missing")


def member(file, entry: tuple[int, int, int]) -> tuple[int, int]:
    """Where a stored member's bytes begin in the package, and how many there are."""
    method, offset, size = entry
    if method != zipfile.ZIP_STORED:
        raise ValueError("only stored members can be read by range")
    head = _at(file, offset, LOCAL_SIZE)
    if head[:4] != LOCAL:
        raise ValueError("no local header")
    name_n, extra_n = struct.unpack_from("<26xHH", head)
    return offset + LOCAL_SIZE + name_n + extra_n, size


def package_ranges(uri: str, range_bytes: int = RANGE_BYTES) -> Iterator[tuple[int, int, int]]:
    """(start, size, records) of consecutive records, from the package's index."""
    store, path = open_fs(uri)
    size = store.get_file_info(path).size
    with store.open_input_file(path) as file:
        entries = directory(file, size)
        data, data_size = member(file, entries[DATA])
        index_at, index_size = member(file, entries[INDEX])
        first, last, n = None, 0, 0
        for line in _at(file, index_at, index_size).splitlines():
            x = json.loads(line)
            if x["offset"] + x["length"] > data_size:
                raise ValueError("the index reaches past its member")
            if n and last + x["length"] - first > range_bytes:
                yield data + first, last - first, n
                first, n = None, 0
            first = x["offset"] if first is None else first
            last, n = x["offset"] + x["length"], n + 1
        if n:
            yield data + first, last - first, n


def range_records(uri: str, start: int, size: int) -> Iterator[dict]:
    """The records in a byte range of a package."""
    store, path = open_fs(uri)
    with store.open_input_file(path) as file:
        blob = _at(file, start, size)
    while blob:
        inflate = zlib.decompressobj(31)
        inflate.decompress(blob)
        rest = inflate.unused_data
        yield parse_record(blob[: len(blob) - len(rest)])
        blob = rest


# ---- on Spark


def _sha1(payload: bytes) -> str:
    from hashlib import sha1

    return sha1(payload).hexdigest()


def write_packages(pages: DataFrame, folder: str, least_bytes: int = LEAST_REVISIT_BYTES, package_bytes: int = PACKAGE_BYTES, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write every row of ``pages`` as a record under ``folder``; the manifest: package, records, bytes."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), utf8(F.col(payload_col)).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    sums = stored(rows.select("page_id", "digest", F.length("payload").alias("n")), "payload-digests")
    shared = sums.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    revisits = sums.filter(F.col("n") >= least_bytes).join(shared, "digest").filter(~F.col("page_id").eqNullSafe(F.col("keep_id")))
    revisits = stored(revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "keep_id").distinct(), "revisits")
    marked = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "keep_id")), strict=True):
                package = package or _Package(folder)
                package.add(*(x.as_py() for x in row))
                if package.payload >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)

    out = marked.select("page_id", "url", "payload", "digest", "keep_id")
    return stored(out.mapInArrow(write, MANIFEST), "manifest")


def read_packages(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the listed packages: fields of :data:`RECORD`. ``intact`` compares a payload with its digest."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("package").to_pylist():
                found = [{"package": uri, "start": a, "size": b, "records": n} for a, b, n in package_ranges(uri, range_bytes)]
                yield pa.RecordBatch.from_pylist(found)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
            + [("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_())]
        )
        for batch in batches:
            for x in batch.to_pylist():
                rows = [_row(r) for r in range_records(x["package"], x["start"], x["size"])]
                if len(rows) != x["records"]:
                    raise ValueError("the range does not hold the records the index lists")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spark = manifest.sparkSession
    plan = manifest.select("package").repartition(partitions(spark, manifest.count(), 8)).mapInArrow(ranges, RANGE)
    return plan.repartition(partitions(spark, 1, 1)).mapInArrow(records, RECORD)


def _row(record: dict) -> dict:
    fields, payload = record["fields"], record["payload"]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": json.loads(f'"{fields["WARC-Target-URI"]}"') if "WARC-Target-URI" in fields else None,
        "payload_bytes": record["payload_bytes"],
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": None if revisit else payload,
        "intact": None if revisit else _sha1(payload) == digest and len(payload) == record["payload_bytes"],
    }


def package_folder(spark) -> str:
    return new_dir(spark, "wacz")
