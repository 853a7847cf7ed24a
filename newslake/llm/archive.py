"""WARC records in ZIP packages: a writer, and a reader that finds records by the ZIP directory and reads ranges.

A package holds members that are stored, not compressed: one archive of gzip members, one for each WARC record, and an
index with a line for each record. The reader reads the end of the file, the central directory with its 64-bit fields,
the index, and then one range for each record; nothing is extracted. Packages live in the shared folder.
"""

import base64
import gzip
import hashlib
import io
import json
import os
import struct
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm import common  # noqa: F401  ships this package with its tasks
from newslake.session import scratch_path, staged
from newslake.sources.stores import open_store

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_VERSION = b"WARC/1.1\r\n"
_EPOCH = "1970-01-01T00:00:00Z"


# ---- records

def digest_header(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def warc_record(page_id, url, kind: str, payload: bytes, sha1_hex: str, size: int, refers_to) -> bytes:
    """A response with its payload, or a revisit that names the response with the same payload."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{json.dumps(page_id)}>"), ("WARC-Date", _EPOCH),
              ("WARC-Target-URI", " ".join((url or "about:blank").split()) or "about:blank"),
              ("WARC-Payload-Digest", digest_header(sha1_hex)), ("X-Payload-Length", str(size))]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{json.dumps(refers_to)}>")]
        payload = b""
    block = head + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes):
    """Header fields (lower case) and payload of a WARC record."""
    if not data.startswith(_VERSION):
        raise ValueError("no WARC record")
    head, gap, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head[len(_VERSION):].decode().split("\r\n"))
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, block.partition(b"\r\n\r\n")[2]


def _page(urn: str):
    return json.loads(urn[len("<urn:page:"):-1])


# ---- ZIP packages

class PackageWriter:
    """One package: records go to a spool, the members are written at the end."""

    def __init__(self):
        self.archive, self.index = io.BytesIO(), []

    def add(self, page_id, record: bytes):
        at = self.archive.tell()
        self.archive.write(gzip.compress(record, 4, mtime=0))
        self.index.append(f"{json.dumps(page_id)} {json.dumps({'offset': at, 'length': self.archive.tell() - at})}\n")

    @property
    def size(self):
        return self.archive.tell()

    def write(self, sink):
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            for name, data in ((ARCHIVE, self.archive.getbuffer()), (INDEX, "".join(self.index).encode())):
                info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
                with package.open(info, "w", force_zip64=True) as member:
                    member.write(data)


class Package:
    """Random access to the stored members of a ZIP file with ``size()``, ``seek`` and ``read``; ZIP64 included."""

    def __init__(self, file):
        self.file = file
        self.members = {name: place for name, place in self._directory()}

    def _range(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the package is cut short")
        return data

    def _directory(self):
        size = self.file.size()
        tail_at = max(0, size - 22 - 65_535)
        tail = self._range(tail_at, size - tail_at)
        # A comment may hold the mark; the true end is the last whose comment reaches the end of the file.
        end = len(tail)
        while (end := tail.rfind(b"PK\x05\x06", 0, end + 3 if end < len(tail) else None)) >= 0:
            if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
                break
            end -= 1
        if end < 0:
            raise ValueError("no ZIP directory")
        count, length, at = struct.unpack_from("<HII", tail, end + 10)
        locator = tail_at + end - 20
        if locator >= 0 and (0xFFFF == count or 0xFFFFFFFF in (length, at)):
            mark, _, where, _ = struct.unpack("<4sIQI", self._range(locator, 20))
            if mark != b"PK\x06\x07":
                raise ValueError("the 64-bit directory is missing")
            record = self._range(where, 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the 64-bit directory is damaged")
            count, length, at = struct.unpack_from("<QQQ", record, 32)
        data, place = self._range(at, length), 0
        for _ in range(count):
            if data[place:place + 4] != b"PK\x01\x02":
                raise ValueError("the directory is damaged")
            flags, method = struct.unpack_from("<HH", data, place + 8)
            packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, place + 20)
            offset, = struct.unpack_from("<I", data, place + 42)
            name = data[place + 46:place + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[place + 46 + n_name:place + 46 + n_name + n_extra]
            packed, offset = self._wide(extra, plain, packed, offset)
            yield name, (method, offset, packed)
            place += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, plain: int, packed: int, offset: int):
        """Sizes and offset, from the 64-bit extra field where the plain ones are full."""
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
                if plain == 0xFFFFFFFF:
                    next(values)
                if packed == 0xFFFFFFFF:
                    packed = next(values)
                if offset == 0xFFFFFFFF:
                    offset = next(values)
            at += 4 + length
        return packed, offset

    def locate(self, name: str):
        """Where a stored member's data begins, and its length."""
        method, offset, length = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed, so it has no ranges to read")
        header = self._range(offset, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no header")
        n_name, n_extra = struct.unpack_from("<HH", header, 26)
        return offset + 30 + n_name + n_extra, length

    def records(self, archive: str = ARCHIVE, index: str = INDEX):
        """``(key, record)`` for each line of the index, one range read for each."""
        at, length = self.locate(archive)
        index_at, index_length = self.locate(index)
        for line in self._range(index_at, index_length).decode().splitlines():
            key, _, where = line.partition(" ")
            where = json.loads(where)
            if where["offset"] + where["length"] > length:
                raise ValueError("the index points beyond the archive")
            yield json.loads(key), gzip.decompress(self._range(at + where["offset"], where["length"]))


# ---- tables

def plan_records(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """``page_id, url, html`` with ``sha1, size, refers_to``: of equal payloads of ``min_revisit`` bytes or more, pages
    below the largest id revisit that one.

    Groups are reduced to their digest and largest id first, a group of any size to a row for each task; only digests
    of several pages join back.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns(
        {"sha1": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("bigint")})
    groups = rows.filter(F.col("size") >= min_revisit).groupBy(F.col("sha1").alias("_sha1"), F.col("size").alias("_size")).agg(
        F.max("page_id").alias("_top"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    groups = staged(groups, "payloads")
    joined = rows.join(groups, (F.col("sha1") == F.col("_sha1")) & (F.col("size") == F.col("_size")), "left")
    lower = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return joined.select("page_id", "url", "html", "sha1", "size", F.when(lower, F.col("_top")).alias("refers_to"))


def write_packages(records: DataFrame, folder: str, max_bytes: int = 32 << 20) -> DataFrame:
    """Write the rows of ``plan_records`` as packages of about ``max_bytes``; returns ``path, n_records``.

    A package gets its final name when it is whole, and a task tells of it then, so a task that is run again leaves at
    most files that no row names.
    """
    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)

        def close(package):
            name = f"{root}/{uuid.uuid4().hex}.zip"
            with store.open_output_stream(name + ".part") as sink:
                package.write(_Sink(sink))
            store.move(name + ".part", name)
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{os.path.basename(name)}", "n_records": len(package.index)}],
                                              pa.schema([("path", pa.string()), ("n_records", pa.int64())]))

        package = PackageWriter()
        for batch in batches:
            for k, (page_id, url, sha1, size, target) in enumerate(zip(*(batch.column(n).to_pylist() for n in (0, 1, 3, 4, 5)))):
                kind = "response" if target is None else "revisit"
                package.add(page_id, warc_record(page_id, url, kind, batch.column(2)[k].as_py().encode(), sha1, size, target))
                if package.size >= max_bytes:
                    yield close(package)
                    package = PackageWriter()
        if package.index:
            yield close(package)

    return staged(records.select("page_id", "url", "html", "sha1", "size", "refers_to").mapInArrow(
        run, "path string, n_records bigint"), "packages")


class _Sink(io.RawIOBase):
    """What ``zipfile`` needs of a stream that cannot seek."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self):
        return True

    def write(self, data):
        self.stream.write(bytes(data))
        return len(data)


def read_packages(packages: DataFrame) -> DataFrame:
    """The records of ``packages(path)``: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload``.

    Length and digest of a response are taken from what was read, and compared with its header; those of a revisit are
    its header's, as it has no payload of its own. One file is read by one task.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def rows_of(path):
        store, name = open_store(path)
        with store.open_input_file(name) as file:
            for key, record in Package(file).records():
                fields, payload = parse_record(record)
                digest = base64.b32decode(fields["warc-payload-digest"][len("sha1:"):]).hex()
                size, kind = int(fields["x-payload-length"]), fields["warc-type"]
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError("a payload differs from its digest")
                if _page(fields["warc-record-id"]) != key:
                    raise ValueError("the index names another record")
                yield (key, size, digest, kind, _page(fields["warc-refers-to"]) if kind == "revisit" else None,
                       fields["warc-target-uri"], payload if kind == "response" else None)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    held += len(row[6] or b"")
                    if held >= 8 << 20 or len(rows) >= 2_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # By number, which keeps each package apart: paths are few bytes, and would be put together again.
    paths, n = packages.select("path"), packages.count()
    return (paths.repartitionByRange(n, "path") if n > 1 else paths.coalesce(1)).mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "url string, payload binary")


def archive_pages(pages: DataFrame, min_revisit: int = 1000, max_bytes: int = 32 << 20) -> DataFrame:
    """Write a record for each page to packages in the shared folder and read them back.

    A null page counts as empty, as does a null URL. Equal pages below ``min_revisit`` bytes are all responses. Pages
    that repeat id and payload are all responses if theirs is the largest id, else all revisits; a null id refers to
    the largest id. An empty table gives no packages and no rows. Columns but ``page_id, url, html`` are not read.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return read_packages(write_packages(plan_records(pages, min_revisit), folder, max_bytes))
