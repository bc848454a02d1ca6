"""WARC records in ZIP packages: a writer, and a reader that takes single records out by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member for each record) and ``indexes/index.cdxj``
(offset and length of each), both stored without further compression, so a record is one contiguous
range of the package. The reader finds the members by the central directory (ZIP64 too), reads the
index, and then only the ranges that hold records; nothing is extracted. A package without an index is
scanned once for record bounds.

Packages are written by the tasks themselves to a folder that all executors reach (any URI that
pyarrow's file systems open). Every attempt writes files of its own, and only the files named by the
manifest, which Spark commits, count; an attempt that is lost leaves a file that nothing reads.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.tables import Scratch, shuffle_partitions

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads below this size are never replaced by a revisit.
LEAST_REVISIT = 100
#: A package is closed when its records reach this size.
PACKAGE_BYTES = 128 << 20
#: Neighbouring records are read together up to this size (one larger record is read alone).
RANGE_BYTES = 4 << 20
LEVEL = 1
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop's names of S3 are understood."""
    for prefix in ("s3a://", "s3n://"):
        if uri.startswith(prefix):
            uri = "s3://" + uri[len(prefix):]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


# ---- records

def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if ord(c) >= 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in value)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 response or revisit. A revisit keeps the HTTP head, whose Content-Length is that of the
    full payload, and refers to the response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    headers: dict[str, str]  # lower-case names
    http: dict[str, str]  # of the HTTP head, if any
    payload: bytes


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def parse(raw: bytes) -> Record:
    """A record from its bytes, gzip-compressed or plain."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompressobj(31).decompress(raw)
    if not raw.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = _fields(head.split(b"\r\n")[1:])
    block = rest[:int(headers.get("content-length", len(rest)))]
    if not headers.get("content-type", "").startswith("application/http"):
        return Record(headers, {}, block)
    http, _, payload = block.partition(b"\r\n\r\n")
    return Record(headers, _fields(http.split(b"\r\n")[1:]), payload)


# ---- ZIP directories

class Member(NamedTuple):
    name: str
    method: int
    encrypted: bool
    size: int  # as stored
    header: int  # place of the local header


def members(file) -> list[Member]:
    """The central directory of a random-access file, with ZIP64 fields and bytes before the archive."""
    size = file.size()
    tail_at = max(0, size - 65557)
    tail = read_at(file, tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no ZIP directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    locator = read_at(file, end - 20, 20) if end >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        end64 = struct.unpack_from("<Q", locator, 8)[0]
        for place in (end64, end - 20 - 56):  # bytes before the archive shift it
            fields = read_at(file, place, 56) if 0 <= place <= size - 56 else b""
            if fields[:4] == b"PK\x06\x06":
                count, length, offset = struct.unpack_from("<QQQ", fields, 32)
                end = place
                break
        else:
            raise ValueError("no ZIP64 directory")
    elif count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        raise ValueError("no ZIP64 locator")
    shift = end - length - offset
    data = read_at(file, offset + shift, length)
    out, at = [], 0
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        stored, full, n, m, k = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + n:at + 46 + n + m]
        place = 0
        while place + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, place)
            if tag == 1:  # ZIP64: only the fields that do not fit, in this order
                values = iter(struct.unpack_from(f"<{width // 8}Q", extra, place + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                stored = next(values) if stored == 0xFFFFFFFF else stored
                header = next(values) if header == 0xFFFFFFFF else header
            place += 4 + width
        out.append(Member(name, method, bool(flags & 1), stored, header + shift))
        at += 46 + n + m + k
    return out


def read_at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    data = file.read(length)
    if len(data) != length:
        raise ValueError("the package is cut off")
    return data


def data_start(file, member: Member) -> int:
    """Place of a member's data; the local header's name and extra field have lengths of their own."""
    head = read_at(file, member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def bounds(file, start: int, size: int, chunk: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a WARC member without an index, from its start; reads on in chunks."""
    at = 0
    while at < size:
        if read_at(file, start + at, min(2, size - at)) == b"\x1f\x8b":
            inflate, used = zlib.decompressobj(31), 0
            while not inflate.eof:
                if at + used >= size:
                    raise ValueError("the last record is cut off")
                part = read_at(file, start + at + used, min(chunk, size - at - used))
                used += len(part)
                while part and not inflate.eof:
                    inflate.decompress(part, chunk)
                    part = inflate.unconsumed_tail
            used -= len(inflate.unused_data)
        else:
            head = b""
            while b"\r\n\r\n" not in head:
                if at + len(head) >= size:
                    raise ValueError("the last record is cut off")
                head += read_at(file, start + at + len(head), min(4096, size - at - len(head)))
            headers, _, _ = head.partition(b"\r\n\r\n")
            used = len(headers) + 4 + int(_fields(headers.split(b"\r\n"))["content-length"]) + 4
        yield at, used
        at += used


# ---- writing

def _write_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_fs(folder)
        system.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        package = stream = member = None
        index: list[str] = []
        name, at = "", 0

        def close() -> None:
            nonlocal package
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "".join(index))
            package.close()
            stream.close()
            done.append((f"{folder}/{name}", len(index)))
            index.clear()
            package = None

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            for page_id, url, html, digest, refers_to in zip(*columns):
                if package is None:
                    name, at = f"{uuid.uuid4().hex}.zip", 0
                    stream = system.open_output_stream(f"{base}/{name}")
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                    member = package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
                kind = "response" if refers_to is None else "revisit"
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = squeeze.compress(record(kind, page_id, url, html.encode(), digest, refers_to)) + squeeze.flush()
                member.write(raw)
                index.append(f"{_clean(url or '-').replace(' ', '%20')} {DATE} "
                             f"{json.dumps({'filename': ARCHIVE, 'offset': at, 'length': len(raw), 'digest': digest})}\n")
                at += len(raw)
                if at >= PACKAGE_BYTES:
                    close()
        if package is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         names=["package", "records"])
    return run


def write(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write one record for every row of pages (page_id, url, html; a null html is empty) to packages in
    the shared folder; return the manifest (package, records).

    Of rows with equal payloads of at least LEAST_REVISIT bytes the one with the smallest page_id is the
    response and the others refer to it (rows that repeat the smallest page_id are responses too).
    """
    scratch = Scratch(spark, "warc")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    again = (base.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first"))
    firsts = scratch.table(again, "repeated")
    rows = base.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    return scratch.table(rows.mapInArrow(_write_batches(f"{scratch.path}/packages"), "package string, records long"), "manifest")


# ---- reading

def tiles(places: list[tuple[int, int]], size: int) -> bool:
    """Whether sorted (offset, length) places cover a member from end to end without gaps and overlaps."""
    at = 0
    for offset, length in places:
        if offset != at or length <= 0:
            return False
        at += length
    return at == size


def _plan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of neighbouring records: place in the package, and the records' places within the range."""
    for batch in batches:
        for uri in batch.column("package").to_pylist():
            system, path = open_fs(uri)
            with system.open_input_file(path) as file:
                indexed: dict[str, set[tuple[int, int]]] = {}
                archives = []
                for m in members(file):
                    archive = m.name.startswith("archive/") and m.name.endswith((".warc", ".warc.gz"))
                    if archive and (m.encrypted or m.method != 0):
                        raise ValueError(f"{uri}: {m.name} is {'encrypted' if m.encrypted else 'compressed'} in the package, its records can't be read in ranges")
                    if archive:
                        archives.append(m)
                    elif m.name.startswith("indexes/") and m.name.endswith(".cdxj") and m.method == 0 and not m.encrypted:
                        for line in io.BytesIO(read_at(file, data_start(file, m), m.size)):
                            entry = json.loads(line[line.index(b"{"):])
                            indexed.setdefault(entry["filename"], set()).add((int(entry["offset"]), int(entry["length"])))
                for m in archives:
                    start = data_start(file, m)
                    places = sorted(indexed.get(m.name, ()))
                    if not tiles(places, m.size):  # no index, or one that leaves records out
                        places = bounds(file, start, m.size)
                    held: list[tuple[int, int]] = []

                    def out() -> pa.RecordBatch:
                        first, last = held[0][0], held[-1][0] + held[-1][1]
                        return pa.RecordBatch.from_arrays(
                            [pa.array([uri]), pa.array([m.name]), pa.array([start + first], pa.int64()), pa.array([last - first], pa.int64()),
                             pa.array([[o - first for o, _ in held]], pa.list_(pa.int64())), pa.array([[n for _, n in held]], pa.list_(pa.int64()))],
                            names=["package", "member", "start", "size", "offsets", "lengths"])

                    for offset, length in places:
                        if held and (offset != held[-1][0] + held[-1][1] or offset + length - held[0][0] > RANGE_BYTES):
                            yield out()
                            held = []
                        held.append((offset, length))
                    if held:
                        yield out()


_RECORD = ("package string, member string, place long, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, http_length long, payload binary")


def _read_batches(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_fs(row["package"])
                with system.open_input_file(path) as file:
                    data = read_at(file, row["start"], row["size"])
                found = []
                for offset, length in zip(row["offsets"], row["lengths"]):
                    r = parse(data[offset:offset + length])
                    h = r.headers
                    body = r.http.get("content-length", "")
                    found.append((row["package"], row["member"], row["start"] + offset, h.get("warc-type"), h.get("warc-record-id", "").strip("<>"),
                                  h.get("warc-target-uri"), h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                                  h.get("warc-payload-digest"), int(body) if body.isdigit() else None, r.payload if payloads else None))
                kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
                names = [f.strip().split(" ")[0] for f in _RECORD.split(",")]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)], names=names)
    return run


def read(spark: SparkSession, packages: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the packages (a column ``package`` of URIs): package, member, place of the record in
    the package, record_type, record_id, target_uri, refers_to, payload_digest and http_length (of the
    HTTP head) as the record has them, and payload. Entries that indexes repeat count once; a member whose index
    leaves records out, or is itself compressed, is scanned from its start. A package without records gives none; a
    broken one, and one with an archive member that is compressed or encrypted, raises an error."""
    n = shuffle_partitions(spark)
    ranges = packages.select("package").repartition(n).mapInArrow(
        _plan_batches, "package string, member string, start long, size long, offsets array<long>, lengths array<long>")
    return ranges.repartition(n).mapInArrow(_read_batches(payloads), _RECORD)


def page_of(record_id):
    """The page_id of a record written here; null for a page without one."""
    return F.regexp_extract(record_id, f"^{_ID}(-?[0-9]+)$", 1).try_cast("long")


def report(records: DataFrame) -> DataFrame:
    """Per record: page_id, bytes and digest of the full payload (of a revisit, as its head has them; of a
    response, of the bytes read), its type, and the page that a revisit refers to."""
    revisit = F.col("record_type") == "revisit"
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_extract("payload_digest", "^sha256:(.*)$", 1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type", F.when(revisit, page_of(F.col("refers_to"))).alias("refers_to"))
