"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package holds stored (never deflated) members: ``archive/data.warc.gz``, one gzip member
for each record, and ``indexes/index.cdxj``, one line for each record with its
place. The reader looks at a package's tail for the end of the central
directory (and the ZIP64 one, if a field is too large), parses the directory,
takes the index by its range, and fetches each record by its own range; nothing is
unpacked to disk and no member is read as a whole but the index.

Packages lie in the shared folder named by ``spark.checkpoint.dir``, or in any
folder of a store pyarrow can open. A task writes to a name of its own attempt, and only names that
the finished job returned are read, so lost and repeated tasks leave no trace in results.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.storage import scratch_path, store

PACKAGE_BYTES = 64 << 20  # a package is closed beyond this size
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
GAP = 1 << 16  # ranges nearer than this are fetched at once
SPAN = 8 << 20  # of a package, for one task
FETCH = 8 << 20  # but no more than this at once, unless one record is larger



class Layout:
    """A struct format that can be sent to executors."""

    def __init__(self, form: str):
        self.form, self.size = form, struct.calcsize(form)

    def pack(self, *values: Any) -> bytes:
        return struct.pack(self.form, *values)

    def unpack(self, raw: bytes) -> tuple:
        return struct.unpack(self.form, raw)

    def unpack_from(self, raw: bytes, at: int) -> tuple:
        return struct.unpack_from(self.form, raw, at)


# Layouts and marks of the ZIP format.
LOCAL, LOCAL_MARK = Layout("<4sHHHHHLLLHH"), b"PK\x03\x04"
CENTRAL, CENTRAL_MARK = Layout("<4sHHHHHHLLLHHHHHLL"), b"PK\x01\x02"
END, END_MARK = Layout("<4sHHHHLLH"), b"PK\x05\x06"
END64, END64_MARK = Layout("<4sQHHLLQQQQ"), b"PK\x06\x06"
LOCATOR, LOCATOR_MARK = Layout("<4sLQL"), b"PK\x06\x07"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
STAMP = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EXACT_URL = "X-Exact-URL"  # a header of our own
URL_SAFE = "%:/?#[]@!$&'()*+,;=~"  # what a URL may hold unescaped, besides letters, digits and -._


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP


class ZipWriter:
    """Stored members to a stream, with ZIP64 fields where a number needs them (or always)."""

    def __init__(self, out: Any, always64: bool = False):
        self.out, self.at, self.members, self.limit = out, 0, [], -1 if always64 else MAX32 - 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        """Starts a member whose size and checksum follow it."""
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        # Sizes come behind the data, as 64-bit numbers since the header announces a ZIP64 field.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(LOCAL.pack(LOCAL_MARK, 45, 0x0808, 0, 0, 0x21, 0, MAX32, MAX32, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Adds to the member; gives the place within it."""
        member = self.members[-1]
        place, member[2], member[3] = member[2], member[2] + len(data), zlib.crc32(data, member[3])
        self._write(data)
        return place

    def end(self) -> None:
        _, _, size, crc = self.members[-1]
        self._write(struct.pack("<4sLQQ", b"PK\x07\x08", crc, size, size))

    def close(self) -> None:
        start = self.at
        for raw, at, size, crc in self.members:
            wide = [x for x in (size, size, at) if x > self.limit]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            small = [min(x, MAX32) if x <= self.limit else MAX32 for x in (size, at)]
            head = CENTRAL.pack(
                CENTRAL_MARK, 45, 45, 0x0808, 0, 0, 0x21, crc, small[0], small[0], len(raw), len(extra), 0, 0, 0, 0, small[1]
            )
            self._write(head + raw + extra)
        size, n, end = self.at - start, len(self.members), self.at
        if self.limit < 0 or n >= MAX16 or max(size, start) > self.limit:
            self._write(END64.pack(END64_MARK, END64.size - 12, 45, 45, 0, 0, n, n, size, start))
            self._write(LOCATOR.pack(LOCATOR_MARK, 0, end, 1))
            n, size, start = MAX16, MAX32, MAX32
        self._write(END.pack(END_MARK, 0, 0, n, n, size, start, 0))


def directory(source: Any, size: int) -> dict[str, tuple[int, int]]:
    """Stored members of a package: name -> (place of the first data byte, size)."""

    def read(at: int, n: int) -> bytes:
        if at < 0 or at + n > size:
            raise ValueError("range beyond the package")
        source.seek(at)
        return source.read(n)

    tail_at = max(0, size - END.size - MAX16)
    tail = read(tail_at, size - tail_at)
    found = tail.rfind(END_MARK)
    while found >= 0 and (found + END.size > len(tail) or found + END.size + END.unpack_from(tail, found)[7] != len(tail)):
        found = tail.rfind(END_MARK, 0, found)
    if found < 0:
        raise ValueError("no ZIP package: the end of the directory is missing")
    n, length, start = (END.unpack_from(tail, found)[i] for i in (4, 5, 6))
    if n == MAX16 or MAX32 in (length, start):
        mark, _, end64, _ = LOCATOR.unpack(read(tail_at + found - LOCATOR.size, LOCATOR.size))
        if mark != LOCATOR_MARK:
            raise ValueError("the ZIP64 directory is missing")
        fields = END64.unpack(read(end64, END64.size))
        if fields[0] != END64_MARK:
            raise ValueError("the ZIP64 directory is damaged")
        n, length, start = fields[7:10]
    entries, raw, at = {}, read(start, length), 0
    for _ in range(n):
        head = CENTRAL.unpack_from(raw, at)
        if head[0] != CENTRAL_MARK:
            raise ValueError("the central directory is damaged")
        method, packed, full, n_name, n_extra, n_note, local = head[4], *head[8:13], head[16]
        at += CENTRAL.size
        name, extra = raw[at : at + n_name].decode(), raw[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_note
        wide = _zip64_field(extra)
        full, packed, local = (struct.unpack("<Q", wide.pop(0))[0] if x == MAX32 and wide else x for x in (full, packed, local))
        if method != 0:
            continue  # only stored members can be read by range
        mark, *_, name_size, extra_size = LOCAL.unpack(read(local, LOCAL.size))
        if mark != LOCAL_MARK:
            raise ValueError("a member's header is damaged")
        entries[name] = (local + LOCAL.size + name_size + extra_size, packed)
    return entries


def _zip64_field(extra: bytes) -> list[bytes]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return [extra[i : i + 8] for i in range(at + 4, at + 4 + n - 7, 8)]
        at += 4 + n
    return []


# --- WARC


def _urn(key: int | None) -> str:
    return f"<urn:page:{'null' if key is None else key}>"


def _key(urn: str) -> int | None:
    name = urn[len("<urn:page:") : -1]
    return None if name == "null" else int(name)


def _fits_header(url: str) -> bool:
    return bool(url) and url.isprintable() and url.strip() == url


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: a response with its payload, or a revisit without it."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(key),
        "WARC-Date": STAMP,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url:
        head["WARC-Target-URI"] = url if _fits_header(url) else quote(url, safe=URL_SAFE)
    if url is not None and not _fits_header(url):
        head[EXACT_URL] = quote(url, safe="")  # as it was, every odd character and percent sign included
    if revisit:
        head |= {"WARC-Profile": REVISIT, "WARC-Refers-To": _urn(refers_to)}
    else:
        block += payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + squeeze.flush()


def parse(member: bytes) -> dict[str, Any]:
    """Fields of one record; the payload's digest and length are checked where the payload is there."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].partition(":")[2]
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    return {
        "page_id": _key(fields["warc-record-id"]),
        "url": unquote(fields[EXACT_URL.lower()]) if EXACT_URL.lower() in fields else fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _key(fields["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload,
    }


# --- Spark


def with_record_types(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """page_id, url, html, refers_to, revisit of each page.

    Only digests and ids are grouped; texts move once, to meet their digest's largest
    id, in a join whose hot keys Spark can split.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    large = rows.filter(F.octet_length("html") >= least_bytes)
    latest = large.groupBy("digest").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n"))
    latest = store(latest.filter("n > 1").select("digest", "latest"), "latest")
    if latest.isEmpty():
        return rows.select("page_id", "url", "html", F.lit(None).cast("bigint").alias("refers_to"), F.lit(False).alias("revisit"))
    joined = rows.join(latest, "digest", "left")
    revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("latest")).alias("refers_to"), revisit.alias("revisit"))


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of its store, as Spark itself would find it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _places(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder, and the folder's path in it; a path without a scheme is a shared mount."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def write_packages(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """path and bytes of the packages written, one WARC record for each page.

    The payload is the html in UTF-8; null is empty. Of records with equal payloads of at
    least ``least_bytes`` bytes, the one with the largest page_id is a response and the
    others revisit it; smaller ones are all responses. Rows that repeat the largest id are all responses.
    A null page_id is smaller than any other. A null URL is left out; one that a header cannot
    hold (empty, with control or other unprintable characters, or blanks at an end) is percent-encoded, and a second
    header keeps it exactly. No pages: no packages. Repeated rows are records of their own. A folder without a scheme is in the
    cluster's default store, where Spark's own tables are. Other columns are not looked at.
    """
    folder = _qualified(pages.sparkSession, folder or scratch_path(pages.sparkSession, "warc"))
    rows = with_record_types(pages, id_col, url_col, html_col, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _places(folder)
        files.create_dir(root, recursive=True)
        context = TaskContext.get()
        for path, size in _packages(_rows(batches), files, f"{root}/{context.partitionId():06d}-{uuid.uuid4().hex}", package_bytes):
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size]}, schema=pa.schema([("path", pa.string()), ("bytes", pa.int64())]))

    return store(rows.mapInArrow(run, "path string, bytes bigint"), "packages").withColumn("folder", F.lit(folder))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        html = batch.column("html").cast(pa.binary())
        plain = [batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to", "revisit")]
        for i, (key, url, refers_to, revisit) in enumerate(zip(*plain)):
            yield key, url, html[i].as_py(), refers_to, revisit


def _packages(rows: Iterator[tuple], files: Any, stem: str, most: int) -> Iterator[tuple[str, int]]:
    number, row = 0, next(rows, None)
    while row is not None:
        path = f"{stem}-{number:04d}.zip"
        with files.open_output_stream(path, compression=None) as out:
            package, index = ZipWriter(out), []
            package.begin(DATA)
            while row is not None and (not index or package.at < most):
                key, url, payload, refers_to, revisit = row
                data = record(key, url, payload, base32_sha1(payload), refers_to, revisit)
                index.append({"id": key, "offset": package.write(data), "length": len(data)})
                row = next(rows, None)
            package.end()
            package.begin(INDEX)
            for line in index:
                package.write(json.dumps(line).encode() + b"\n")
            package.end()
            package.close()
        yield path, package.at
        number += 1


def read_index(packages: DataFrame) -> DataFrame:
    """folder, path, at, length of each record, from the packages' directories and indexes.

    ``packages`` has folder, path and bytes; a package listed twice is read twice, none gives no rows, and a null path is an
    error. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, path, size in zip(*[batch.column(c).to_pylist() for c in ("folder", "path", "bytes")]):
                files, _ = _places(folder)
                with files.open_input_file(path) as source:
                    members = directory(source, size)
                    data_at = members[DATA][0]
                    source.seek(members[INDEX][0])
                    lines = [json.loads(x) for x in source.read(members[INDEX][1]).splitlines()]
                columns = {
                    "folder": [folder] * len(lines),
                    "path": [path] * len(lines),
                    "at": [data_at + x["offset"] for x in lines],
                    "length": [x["length"] for x in lines],
                }
                yield pa.RecordBatch.from_pydict(columns)

    return packages.select("folder", "path", "bytes").mapInArrow(run, "folder string, path string, at bigint, length bigint")


def read_records(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits) of all records.

    Stretches of SPAN bytes of a package are dealt to tasks, as many as there are stretches; ranges that lie close are
    fetched at once. Records come as often as their package is listed; without packages there are none. A damaged record is an error.
    """
    index = read_index(packages)
    part = F.floor(F.col("at") / SPAN)
    # By number: Spark would judge by the few bytes of the index, not by what they point to.
    n_bytes = packages.agg(F.sum("bytes")).first()[0] or 0
    dealt = index.repartition(max(1, -(-n_bytes // SPAN)), "path", part).sortWithinPartitions("path", "at")
    out = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("folder", "path", "at", "length")]))
            for i in range(0, len(rows), 256):
                found = []
                for member in _ranges(rows[i : i + 256]):
                    fields = parse(member)
                    found.append(fields if payloads else fields | {"payload": None})
                yield pa.RecordBatch.from_pylist(found, schema=out)

    return dealt.mapInArrow(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    )


def _ranges(rows: list[tuple[str, str, int, int]]) -> Iterator[bytes]:
    """The bytes of each range; neighbours in a package come from one read."""
    i = 0
    while i < len(rows):
        folder, path, start, length = rows[i]
        j, end = i + 1, start + length
        while j < len(rows) and rows[j][1] == path and end <= rows[j][2] <= end + GAP and rows[j][2] + rows[j][3] - start <= FETCH:
            end, j = rows[j][2] + rows[j][3], j + 1
        files, _ = _places(folder)
        with files.open_input_file(path) as source:
            source.seek(start)
            data = source.read(end - start)
        for _, _, at, n in rows[i:j]:
            yield data[at - start : at - start + n]
        i = j

