"""Secret scan with structural confirmation.

Base kinds are pattern matches with a least length: assignments to secret-like names (``assign``),
access key ids (``access``) and long hex runs (``hex``). The method adds spans whose decoded bytes have
the structure of a secret:

* ``jwt``: a signed token, header and payload of which decode to JSON objects, the header with "alg";
* ``der``: a base64 or hex run that decodes to a private key in ASN.1, with every nested length exact;
* ``openssh``: a base64 run that decodes to an OpenSSH private key with length-prefixed fields that fit;
* ``pem``: a private-key block whose body decodes to one of the two encodings.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.tables import replaced

#: In the order of equal starts.
KINDS = ("assign", "access", "hex", "jwt", "der", "openssh", "pem")
# The base patterns and their least lengths.
_ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_VALUE = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS = 20
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs: shorter ones are dropped anyway
# Shortest encoded runs of a private key: 44 bytes (32 of the key itself, and the elements around it).
# The letter of an escaped line break is none of a run's; no private key begins with it.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:(?<=\\)[nr])?([A-Za-z0-9+/_-]{58,}={0,2})")
_HEXKEY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{88,}|[0-9A-F]{88,})(?![0-9A-Za-z])")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[A-Za-z0-9_-]{10,})\.(e[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY)-----([^-]*)-----END \1-----")
_ESCAPED = re.compile(r"\\+[nr]")  # line breaks in JSON and .env text
#: Every access, hex and encoded span holds a run of so many of these characters.
_RUN = 20
_RUNS = np.zeros(256, bool)
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-":
    _RUNS[_c] = True


def decode64(run: str) -> bytes | None:
    """Bytes of a base64 run, standard or URL-safe, with or without padding; None if it is no such run."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) elements that make up ``data`` in DER; None unless the lengths fit exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at:at + n], "big")
            if size < 0x80 or data[at] == 0:  # DER takes the shortest form
                return None
            at += n
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06


def private_key(data: bytes) -> bool:
    """Whether ``data`` is one private key in DER: PKCS#1, PKCS#8, encrypted PKCS#8, SEC1 or DSA."""
    top = elements(data)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    parts = elements(top[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    numbers = [int.from_bytes(c, "big") for t, c in parts if t == INTEGER]
    if tags[:2] == [SEQUENCE, OCTETS] and len(parts) == 2:  # encrypted: algorithm, data
        inner = elements(parts[0][1])
        return bool(inner) and inner[0][0] == OID and len(inner) == 2
    if tags[0] != INTEGER or numbers[0] > 1:
        return False
    if tags[1:3] == [SEQUENCE, OCTETS]:  # version, algorithm, key
        inner = elements(parts[1][1])
        return bool(inner) and inner[0][0] == OID and elements(parts[2][1]) is not None
    if tags[1:2] == [OCTETS]:  # version 1, key, then the curve or the public key
        return numbers[0] == 1 and len(parts[1][1]) >= 16 and all(t in (0xA0, 0xA1) and elements(c) is not None for t, c in parts[2:])
    if tags == [INTEGER] * 9:  # version, modulus, exponents, primes, ...
        return numbers[1] > 1 << 500 and numbers[4] * numbers[5] == numbers[1]
    return tags == [INTEGER] * 6 and numbers[1] > 1 << 500


def openssh_key(data: bytes) -> bool:
    """Whether ``data`` is an OpenSSH private key: magic, cipher, kdf, options, count, public and private parts."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        (size,) = struct.unpack_from(">I", data, at)
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size:at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    (keys,) = struct.unpack_from(">I", data, at)
    at += 4
    return 1 <= keys <= 64 and all(field() for _ in range(keys + 1)) and at == len(data)


def signed_token(header: str, payload: str) -> bool:
    """Whether two segments are the JSON header, with "alg", and the JSON payload of a signed token."""
    found = []
    for segment in (header, payload):
        raw = decode64(segment)
        try:
            found.append(json.loads(raw) if raw is not None else None)
        except (ValueError, RecursionError):
            return False
    return isinstance(found[0], dict) and isinstance(found[0].get("alg"), str) and isinstance(found[1], dict)


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of signed tokens; where three segments are none, the search goes on at the next segment."""
    at = 0
    while m := _JWT.search(text, at):
        if signed_token(m[1], m[2]):
            yield m.start(), m.end()
            at = m.end()
        else:
            at = m.start(2)


def scan(text: str, runs: bool = True) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), code points, end exclusive, by start and then kind.

    ``runs``: whether the text may hold a run of 20 encoding characters; without one only
    assignments are possible."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if runs:
        if "AKIA" in text:
            out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS]
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        if "." in text:
            out += [("jwt", a, b) for a, b in signed_tokens(text)]
        for m in _BASE64.finditer(text):
            raw = decode64(m[1])
            if raw is not None:
                out += [("der", m.start(1), m.end())] * private_key(raw) + [("openssh", m.start(1), m.end())] * openssh_key(raw)
        out += [("der", m.start(), m.end()) for m in _HEXKEY.finditer(text)
                if (m.end() - m.start()) % 2 == 0 and private_key(bytes.fromhex(m[0]))]
        if "-----BEGIN " in text:
            for m in _PEM.finditer(text):
                raw = decode64("".join(_ESCAPED.sub("", m[2]).split()))
                if raw is not None and (private_key(raw) or openssh_key(raw)):
                    out.append(("pem", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo, hi in W.slices(whole.column("text")):
            batch = whole.slice(lo, hi - lo)
            starts, ends, rows = W.split(*W.flat(batch.column("text")), _RUNS)
            long_runs = np.concatenate([[0], np.cumsum(ends - starts >= _RUN)])[rows]
            some = (np.diff(long_runs) > 0).tolist()
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(text, runs)] if text else []
                     for text, runs in zip(batch.column("text").to_pylist(), some)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _SPANS)], names=[*batch.schema.names, "spans"])


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (a string column text; other columns pass through) with spans, an array of
    struct<kind, start, end> in code points, end exclusive, by start and then in the order of KINDS.
    A null or empty text has none."""
    base = docs.drop("spans").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(_scan_batches, f"{schema}, spans array<struct<kind: string, start: long, end: long>>")


def redact(found: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``find`` with every span (overlapping ones together) replaced by ``mask``, and n_chars,
    if there is such a column, the new length."""
    rows = found.withColumn("text", replaced(F.col("text"), F.col("spans"), "start", "end", mask))
    if "n_chars" in rows.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return rows.drop("spans")


def report(found: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
