"""Web archives: pages to WARC records in ZIP packages, and range reads back.

Writing: payloads of at least ``LEAST`` bytes that are equal (SHA-256) are kept
once, with the page of smallest id; the other pages become revisit records that
name it. Each record is an own gzip member of ``archive/data.warc.gz``, and the
package holds that file and ``indexes/index.cdxj`` stored, not compressed, so
any record can be read by one range. A task writes packages of about
``PACKAGE`` bytes into the shared folder and returns their paths; only the paths
of tasks that succeeded reach the manifest table, so a task that runs again
leaves no record twice.

Reading: a package's end record, ZIP64 end record where there is one, and central
directory locate its stored archive and index members. Index lines (or, where a
package has none, a pass over the archive member) become rows of (path, offset,
length); these are dealt out by stretches of the files, and each task reads its
ranges, joining those that touch, without extracting anything.

Defined results: a null page body is empty; empty bodies and those below
``LEAST`` bytes are responses of their own. Every row that holds the smallest id
of its payload is a response (repeated rows too); rows with a null id are never
referred to, and are responses if all rows of their payload have null ids. A
null url leaves the target out; control characters in a url are percent-encoded.
An empty table gives an empty manifest and no rows; other columns are not read.
Members that are compressed in the ZIP cannot be range-read and are passed over;
a file that is no ZIP package ends the job with its name.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.session import materialize, scratch_table_path

LEAST = 100
PACKAGE = 16 << 20         # compressed bytes of a package, but for a longer record
STRETCH = 16 << 20         # bytes of a package that one group of range reads covers
READ = 4 << 20             # bytes of one range read, but for a longer record
OUT_BYTES = 8 << 20        # payload of a result batch
DATE = "1970-01-01T00:00:00Z"      # of records whose page tells no time
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ID = "urn:page:"


def _file(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- records ----
def escaped(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(kind: str, page: str | None, url: str | None, payload: bytes, size: int, digest: str,
           refers: str | None = None, date: str = DATE) -> bytes:
    """One WARC record; a revisit's block ends with the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{page or ''}>"), ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else escaped(url)),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Refers-To", None if refers is None else f"<{ID}{refers}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head if v is not None), "\r\n"]).encode() + block + b"\r\n\r\n"


def _header(data: bytes) -> tuple[dict[str, str], int]:
    """Header fields (names in lower case) and where the body begins."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


class Record(NamedTuple):
    record_id: str
    record_type: str
    target_uri: str | None
    refers_to: str | None
    payload: bytes | None          # none for a revisit
    payload_bytes: int | None
    payload_digest: str | None


def parse(data: bytes) -> Record:
    """A record from its bytes, gzipped or not. A response's size and digest are
    taken of the payload itself, a revisit's from its headers."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    head, at = _header(data)
    block = data[at:at + int(head["content-length"])]
    payload, size, digest = block, len(block), None
    if head.get("content-type", "").startswith("application/http"):
        http, body = _header(block)
        payload, size = block[body:], int(http.get("content-length", len(block) - body))
    strip = lambda x: None if x is None else x.strip("<>").removeprefix(ID)
    if head["warc-type"] == "revisit":
        payload, digest = None, head.get("warc-payload-digest", "").removeprefix("sha256:") or None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return Record(strip(head.get("warc-record-id")), head["warc-type"], head.get("warc-target-uri"),
                  strip(head.get("warc-refers-to")), payload, size, digest)


def sort_key(url: str) -> str:
    """Host labels from the right, then the rest of the address: ``org,example)/a``."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)(.*)", url, re.I | re.S)
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


# --------------------------------------------------------------- packages ----
class Package:
    """A package under construction; records go in one by one."""

    def __init__(self):
        self.data, self.lines = io.BytesIO(), []

    def add(self, kind: str, url: str | None, digest: str, rec: bytes) -> None:
        member = gzip.compress(rec, 6, mtime=0)
        url = escaped(url or "")
        about = {"url": url, "mime": "text/html" if kind == "response" else "warc/revisit", "digest": f"sha256:{digest}",
                 "filename": DATA.split("/")[1], "offset": self.data.tell(), "length": len(member)}
        self.lines.append(f"{sort_key(url)} 19700101000000 {json.dumps(about)}\n")
        self.data.write(member)

    def save(self, folder: str) -> tuple[str, int, int]:
        """(path, records, bytes) of the package written under a new name."""
        fs, base = _file(folder)
        fs.create_dir(base, recursive=True)
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}))
            z.writestr(INDEX, "".join(sorted(self.lines)))
            z.writestr(DATA, self.data.getbuffer())
        name = f"{uuid.uuid4().hex}.zip"
        with fs.open_output_stream(f"{base}/{name}") as f:
            f.write(out.getbuffer())
        return f"{folder}/{name}", len(self.lines), out.getbuffer().nbytes


def _write_batches(folder: str, limit: int, date: str):
    """Task over (page, url, html, digest, refers, size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def saved() -> pa.RecordBatch:
            path, n, size = package.save(folder)
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})
        package = Package()
        for batch in batches:
            page, url, html, digest, refers, size = batch.columns
            html = html.cast(pa.large_binary())
            for i in range(batch.num_rows):
                to = refers[i].as_py()
                kind = "response" if to is None else "revisit"
                payload = html[i].as_py() if to is None else b""
                u = url[i].as_py()
                package.add(kind, u, digest[i].as_py(),
                            record(kind, page[i].as_py(), u, payload, size[i].as_py(), digest[i].as_py(), to, date))
                if package.data.tell() >= limit:
                    yield saved()
                    package = Package()
        if package.lines:
            yield saved()
    return run


def write(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html",
          limit: int = PACKAGE, date: str = DATE) -> DataFrame:
    """Write the packages of a page table into ``folder``; returns the manifest
    (path, n_records, bytes), itself a written table."""
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("html"))
    rows = rows.select("*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("size"))
    first = (rows.where(F.col("size") >= LEAST).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 and first is not null").drop("n"))
    # a payload that many pages hold is split by the skew join; its copies travel without the payload from here
    rows = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select(F.col("id").cast("string").alias("page"), "url", F.when(again, F.lit("")).otherwise(F.col("html")).alias("html"),
                       "digest", F.when(again, F.col("first")).cast("string").alias("refers"), "size")
    return materialize(rows.mapInArrow(_write_batches(folder, limit, date), "path string, n_records long, bytes long"), "warc-manifest")


# ---------------------------------------------------------------- reading ----
class Member(NamedTuple):
    name: str
    method: int            # 0: stored
    size: int
    packed: int
    header: int            # offset of the local header


# Record signatures and layouts of the ZIP format.
END, END64, LOCATOR, CENTRAL, LOCAL = (b"PK" + bytes(x) for x in ((5, 6), (6, 6), (6, 7), (1, 2), (3, 4)))


def directory(source, size: int) -> Iterator[Member]:
    """Members of a ZIP file, from its central directory; ``source`` has ``read_at(length, offset)``."""
    low = max(0, size - (1 << 16) - 22 - 20)
    tail = source.read_at(size - low, low)
    at = tail.rfind(END, 0, max(0, len(tail) - 18))          # 22 bytes and a comment up to the end of the file
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if tail[max(0, at - 20):at][:4] == LOCATOR:
        end64 = source.read_at(56, struct.unpack_from("<Q", tail, at - 12)[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end record where its locator points")
        count, length, begin = struct.unpack_from("<QQQ", end64, 32)
    held, place, stop = b"", begin, begin + length
    for _ in range(count):
        while True:                          # until the whole entry is at hand
            need = 46 + sum(struct.unpack_from("<HHH", held, 28)) if len(held) >= 46 else 46
            if len(held) >= need:
                break
            more = source.read_at(min(READ, stop - place), place)
            if not more:
                raise ValueError("central directory ends early")
            held, place = held + more, place + len(more)
        if held[:4] != CENTRAL:
            raise ValueError("no entry where the central directory should be")
        method, = struct.unpack_from("<H", held, 10)
        packed, plain, n, m, _ = struct.unpack_from("<IIHHH", held, 20)
        header, = struct.unpack_from("<I", held, 42)
        extra = held[46 + n:46 + n + m]
        while len(extra) >= 4:
            tag, k = struct.unpack_from("<HH", extra)
            if tag == 1:                     # ZIP64: the values that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{k // 8}Q", extra, 4))
                plain, packed, header = (next(wide) if x == 0xFFFFFFFF else x for x in (plain, packed, header))
            extra = extra[4 + k:]
        yield Member(held[46:46 + n].decode("utf-8", "replace"), method, plain, packed, header)
        held = held[need:]


def data_offset(source, member: Member) -> int:
    head = source.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError("no local header where the directory points")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def _chunks(source, begin: int, size: int) -> Iterator[bytes]:
    for at in range(begin, begin + size, READ):
        yield source.read_at(min(READ, begin + size - at), at)


def index_entries(source, begin: int, member: Member) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of an index member's lines, a range at a time."""
    unpack = zlib.decompressobj(31) if member.name.endswith(".gz") else None
    held = b""
    for part in _chunks(source, begin, member.size):
        while part:
            held += unpack.decompress(part) if unpack else part
            part = unpack.unused_data if unpack else b""
            if part:                         # gzip members one after the other
                unpack = zlib.decompressobj(31)
        *lines, held = held.split(b"\n")
        yield from map(_entry, filter(None, lines))
    if held.strip():
        yield _entry(held)


def _entry(line: bytes) -> tuple[str, int, int]:
    about = json.loads(line[line.index(b"{"):])
    return about["filename"], int(about["offset"]), int(about["length"])


def scanned(source, begin: int, member: Member) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of an archive without an index."""
    unpack, start, seen = zlib.decompressobj(31), 0, 0
    for part in _chunks(source, begin, member.size):
        while part:
            unpack.decompress(part)
            rest = unpack.unused_data
            seen += len(part) - len(rest)
            if unpack.eof:
                yield start, seen - start
                unpack, start = zlib.decompressobj(31), seen
            part = rest


def located(source, size: int) -> Iterator[tuple[str, int, int]]:
    """(member, offset in the package, length) of every record of a package."""
    members = [m for m in directory(source, size) if m.method == 0]
    data = {m.name.rsplit("/", 1)[-1]: m for m in members if re.fullmatch(r"archive/.+\.warc(\.gz)?", m.name)}
    begin = {name: data_offset(source, m) for name, m in data.items()}
    listed = set()
    for m in members:
        if re.fullmatch(r"indexes/.+\.cdxj?(\.gz)?", m.name):
            for name, offset, length in index_entries(source, data_offset(source, m), m):
                if name in data:
                    listed.add(name)
                    yield data[name].name, begin[name] + offset, length
    for name, m in data.items():
        if name not in listed and name.endswith(".gz"):
            for offset, length in scanned(source, begin[name], m):
                yield m.name, begin[name] + offset, length


def _locate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, name = _file(path)
            out = []
            with fs.open_input_file(name) as f:
                try:
                    for row in located(f, f.size()):
                        out.append((path, *row))
                        if len(out) == 10_000:
                            yield _located(out)
                            out = []
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e
            if out:
                yield _located(out)


def _located(rows: list[tuple]) -> pa.RecordBatch:
    path, member, offset, length = zip(*rows)
    return pa.RecordBatch.from_pydict({"path": path, "member": member, "offset": pa.array(offset, pa.int64()), "length": pa.array(length, pa.int64())})


def locate(packages: DataFrame) -> DataFrame:
    """(path, member, offset, length) of every record of the packages named in ``path``."""
    return packages.select("path").mapInArrow(_locate_batches, "path string, member string, offset long, length long")


def _ranges(paths: list, offsets: list, lengths: list) -> Iterator[bytes]:
    """The bytes of each range, in order; ranges that touch are read together."""
    i, n, open_path, f = 0, len(paths), None, None
    try:
        while i < n:
            if paths[i] != open_path:
                if f:
                    f.close()
                open_path = paths[i]
                fs, name = _file(open_path)
                f = fs.open_input_file(name)
            j, end = i + 1, offsets[i] + lengths[i]
            while j < n and paths[j] == open_path and offsets[j] == end and end - offsets[i] < READ:
                end += lengths[j]
                j += 1
            data = f.read_at(end - offsets[i], offsets[i])
            for k in range(i, j):
                yield data[offsets[k] - offsets[i]:offsets[k] - offsets[i] + lengths[k]]
            i = j
    finally:
        if f:
            f.close()


_RECORD = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
                     ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                     ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
RECORD = ("path string, offset long, length long, record_id string, record_type string, target_uri string, "
          "refers_to string, payload binary, payload_bytes long, payload_digest string")


def _read_batches(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            paths, offsets, lengths = (c.to_pylist() for c in batch.columns)
            for *place, data in zip(paths, offsets, lengths, _ranges(paths, offsets, lengths)):
                r = parse(data)
                out.append((*place, *(r if with_payload else r._replace(payload=None))))
                held += len(out[-1][7] or b"") + 200
                if held > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _RECORD)], schema=_RECORD)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _RECORD)], schema=_RECORD)
    return run


def read(packages: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the packages named in ``path``, read by ranges. With a
    column ``bytes`` (as in a manifest) a task reads about ``STRETCH`` bytes."""
    spark = packages.sparkSession
    total = packages.agg(F.sum("bytes")).first()[0] or 0 if "bytes" in packages.columns else 0
    # a number given outright: by the size of the places alone, Spark would merge all of them into one task
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // STRETCH))
    places = locate(packages).select("path", "offset", "length")
    places = (places.withColumn("part", F.expr(f"offset div {STRETCH // 4}")).repartition(tasks, "path", "part")
              .sortWithinPartitions("path", "offset").drop("part"))
    return places.mapInArrow(_read_batches(payload), RECORD)


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND first <> page_id THEN first END AS refers_to
FROM f
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every page through a package and back."""
    kept = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_table_path(spark, "warc"))
    back = read(kept, payload=False)
    return back.select(F.expr("nullif(record_id, '')").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))
