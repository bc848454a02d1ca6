import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import repeats as R
from shelfrank.llm import suffixes as S


def brute(rows, length):
    """rows: distinct (doc_id, text) in document order."""
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(piece)
        spans, at = [], 0
        while at < len(data):
            end = at
            while end < len(data) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append((at, end))
            at = end
        out[doc, text or ""] = len(data), spans, bytes(b for b, g in zip(data, gone) if not g)
    return out


def check(df, rows, length, ordered=None):
    found = R.without_repeats(df.sparkSession, df, length)
    assert found.columns[-3:] == ["n_bytes", "spans", "kept"]
    want = brute(ordered or rows, length)
    got = [(r["doc_id"], r["text"], (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))) for r in found.collect()]
    assert sorted(((d, t) for d, t, _ in got), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    for doc, text, result in got:
        assert result == want[doc, text], (doc, text)
    report = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in R.report(found).collect()}
    assert report == {(d, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for (d, _), (n, s, k) in want.items()}
    return want


def texts(seed, n, alphabet, size, passages):
    rnd = random.Random(seed)
    shared = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(10, 60))) for _ in range(passages)]
    return ["".join(rnd.choice(shared) if rnd.random() < 0.4 else "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(20)))
                    for _ in range(rnd.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("seed,alphabet,length,hot", [(1, "ab", 12, 10_000), (2, "abcé漢", 20, 10_000), (3, "abcdefgh .", 40, 10), (4, "a", 33, 3)])
def test_random_texts(docs, monkeypatch, seed, alphabet, length, hot):
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "BUFFER", 2_000)
    monkeypatch.setattr(R, "CHUNK", 500)
    rows = list(enumerate(texts(seed, 60, alphabet, 12, 6)))
    want = check(docs(rows, extra=True), rows, length)
    assert sum(len(s) for _, s, _ in want.values()) > 20


def test_copies_and_a_passage_in_a_third_of_all_documents(docs):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(rnd.randrange(2, 9)))
    passage = " ".join(word() for _ in range(50))
    base = [word() for _ in range(300)]
    rows = []
    for i in range(240):
        own = " ".join(word() for _ in range(60))
        kind = i % 6
        rows.append((1000 - i, own + passage[rnd.randrange(30):] + own[:7] if kind < 2 else " ".join(base[:150] + [word()] + base[150:]) if kind == 2 else " ".join(base) if kind == 3 else own))
    rows.sort()
    check(docs(rows), rows, R.LENGTH)


def test_contract_edges(docs):
    line = "0123456789" * 10
    rows = [(1, line), (2, line[:99]), (3, "x" + line), (4, line + line), (5, None), (6, ""), (7, "a" * 350), (8, "b" * 99 + "é"), (9, "ü" * 75)]
    want = check(docs(rows), rows, 100)
    assert want[1, line][1] == [] and want[3, "x" + line][1] == [(1, 101)] and want[4, line + line][1] == [(0, 200)]
    assert want[7, "a" * 350][1] == [(1, 350)] and want[2, line[:99]][1] == []


def test_repeated_rows_null_ids_and_shared_ids(spark, docs):
    a, b, c = ("".join(random.Random(i).choice("abcdefg") for _ in range(150)) for i in range(3))
    rows = [(1, a), (1, a), (1, a), (2, b + a), (2, b + c), (None, c + b), (None, c), (None, c), (0, c[:120])]
    df = docs(rows)
    order = {(r[0], r[1]): r[2] for r in df.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect()}
    ordered = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, order[r]))
    check(df, rows, 100, ordered)


def test_empty_table(docs):
    assert R.without_repeats(docs([(1, "x")]).sparkSession, docs([(1, "x")]).where("doc_id = 2")).collect() == []


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(200):
        text = rng.integers(trial % 2, int(rng.integers(2, 6)), int(rng.integers(1, 120))).astype(np.uint8)
        text[-1] = 0
        depth = int(rng.choice([8, 24, 100]))
        order = S.suffix_array(text, depth)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [text[i:i + depth].tobytes().partition(b"\0") for i in order]
        assert [a + z for a, z, _ in keys] == sorted(a + z for a, z, _ in keys)
        wanted = rng.random(len(text)) < 0.2
        some = S.suffix_array(text, depth, wanted=wanted)
        assert set(np.flatnonzero(wanted)) <= set(some.tolist()) and len(set(some.tolist())) == len(some)
        keys = [text[i:i + depth].tobytes().partition(b"\0") for i in some]
        assert [a + z for a, z, _ in keys] == sorted(a + z for a, z, _ in keys)
        long = order[order < len(text) - 16]
        shared = S.common_prefixes(S.words_at(text), long, 16)
        for k in range(1, len(long)):
            a, b = text[long[k]:long[k] + 16], text[long[k - 1]:long[k - 1] + 16]
            assert shared[k] == next((i for i in range(16) if a[i] != b[i]), 16)
