import hashlib
import io
import random
import zipfile
import zlib

import pyarrow as pa
import pytest

from shelfrank.llm import warc as A

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        n = sum(h == x for _, _, x in rows) if h else 0
        ref = first.get(h) if n > 1 else None
        ref = None if ref == i else ref
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def test_round_trip(spark):
    rnd = random.Random(2)
    bodies = ["".join(rnd.choices("abc é日\r\n<>", k=n)) for n in (0, 1, 99, 100, 101, 5000, 200_000)] + ["x" * 99, "y" * 100, None, "\r\n\r\n" * 50]
    rows = [(i * 3, rnd.choice(["http://a.net/x y", "weird\r\nurl\x00", None, "http://é.org/"]), rnd.choice(bodies)) for i in range(120)]
    rows += [(7, "u", "z" * 300), (7, "u", "z" * 300), (8, "u", "z" * 300), (None, "u", "z" * 300), (None, None, None), (-5, "u", "w" * 400), (4, "u", "w" * 400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' as digest", "1 as first", "2 as package")
    got = A.report(A.read(spark, A.write(spark, df))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_texts_and_urls_come_back(spark):
    rows = [(1, "http://a.net/", "é" * 80), (2, "http://b.net/", "é" * 80)]
    got = {r.record_id: r for r in A.read(spark, A.write(spark, spark.createDataFrame(rows, SCHEMA))).collect()}
    one, two = got["urn:x-page:1"], got["urn:x-page:2"]
    assert bytes(one.payload).decode() == "é" * 80 and one.target_uri == "http://a.net/" and one.refers_to is None
    assert bytes(two.payload) == b"" and two.refers_to == "urn:x-page:1" and two.http_length == 160


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert A.report(A.read(spark, A.write(spark, none))).collect() == []


def records(n):
    rnd = random.Random(n)
    return [A.record("response", i, f"http://x/{i}", bytes(rnd.randrange(256) for _ in range(rnd.randrange(3000))), "d", None) for i in range(n)]


def package(parts, gz=True, index=False, prefix=b"", comment=b"", extra=()):
    out, data, at, lines = io.BytesIO(), b"", 0, []
    out.write(prefix)
    for raw in parts:
        if gz:
            c = zlib.compressobj(6, zlib.DEFLATED, 31)
            raw = c.compress(raw) + c.flush()
        lines.append(f'x 2000 {{"filename": "archive/a.warc{".gz" * gz}", "offset": {at}, "length": {len(raw)}}}\n')
        at += len(raw)
        data += raw
    with zipfile.ZipFile(out, "a" if prefix else "w") as z:
        for name, body, method in extra:
            z.writestr(name, body, method)
        z.writestr(f"archive/a.warc{'.gz' * gz}", data)
        if index:
            z.writestr("indexes/i.cdxj", "".join(reversed(lines)))
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("case", ["plain", "gz", "index", "prefix", "comment", "zip64", "others"])
def test_packages_of_others(spark, tmp_path, monkeypatch, case):
    parts = records(30)
    if case == "zip64":
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    monkeypatch.setattr(A, "RANGE_BYTES", 5000)
    blob = package(parts, gz=case != "plain", index=case in ("index", "zip64"), prefix=b"#!stub\n" * (case == "prefix"),
                   comment=b"PK\x05\x06 not the end" * (case == "comment"),
                   extra=[("é.txt", b"hello" * 100, zipfile.ZIP_DEFLATED), ("archive/z.txt.gz", b"abc", zipfile.ZIP_DEFLATED), ("indexes/z.cdxj", b"x" * 99, zipfile.ZIP_DEFLATED)] if case == "others" else ())
    (tmp_path / "p.zip").write_bytes(blob)
    df = spark.createDataFrame([(f"file://{tmp_path}/p.zip",)], "package string")
    got = sorted((int(r.record_id[11:]), bytes(r.payload)) for r in A.read(spark, df).collect())
    assert got == [(i, A.parse(p).payload) for i, p in enumerate(parts)]


def test_bounds_in_small_chunks():
    parts = records(8)
    for gz in (True, False):
        blob = package(parts, gz=gz)
        file = pa.BufferReader(blob)
        (m,) = A.members(file)
        start = A.data_start(file, m)
        found = list(A.bounds(file, start, m.size, chunk=64))
        assert [A.parse(blob[start + o:start + o + n]).payload for o, n in found] == [A.parse(p).payload for p in parts]


def test_cut_package_is_an_error():
    blob = package(records(3))
    for bad in (blob[:-30], blob[:100], b""):
        with pytest.raises(ValueError):
            file = pa.BufferReader(bad)
            [A.data_start(file, m) for m in A.members(file)]


def written(spark, tmp_path, blob):
    (tmp_path / "p.zip").write_bytes(blob)
    df = spark.createDataFrame([(f"file://{tmp_path}/p.zip",)], "package string")
    return sorted((int(r.record_id[11:]), bytes(r.payload)) for r in A.read(spark, df).collect())


@pytest.mark.parametrize("fault", ["gap", "double", "overlap", "two"])
def test_indexes_that_do_not_fit_lose_and_double_nothing(spark, tmp_path, fault):
    parts = records(12)
    lines, at = [], 0
    for raw in parts:
        lines.append(f'x 2000 {{"filename": "archive/b.warc", "offset": {at}, "length": {len(raw)}}}\n')
        at += len(raw)
    more = {"gap": lines[:5] + lines[6:], "double": lines + lines, "overlap": [*lines, lines[3].replace('"length": ', '"length": 1')], "two": lines}[fault]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/b.warc", b"".join(parts))
        z.writestr("indexes/i.cdxj", "".join(more))
        if fault == "two":
            z.writestr("indexes/j.cdxj", "".join(lines[:4]))
    assert written(spark, tmp_path, out.getvalue()) == [(i, A.parse(p).payload) for i, p in enumerate(parts)]


@pytest.mark.parametrize("fault", ["compressed", "encrypted"])
def test_members_that_cannot_be_read_are_an_error(spark, tmp_path, fault):
    blob = package(records(3), extra=[("archive/z.warc", b"".join(records(2)), zipfile.ZIP_DEFLATED if fault == "compressed" else zipfile.ZIP_STORED)])
    if fault == "encrypted":  # the flag of the first member, in its central entry
        at = blob.index(b"PK\x01\x02")
        blob = blob[:at + 8] + bytes([blob[at + 8] | 1]) + blob[at + 9:]
    with pytest.raises(Exception, match=f"archive/z.warc is {fault}"):
        written(spark, tmp_path, blob)
