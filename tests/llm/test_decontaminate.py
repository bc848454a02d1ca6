import random

import numpy as np
import pytest

from shelfrank.llm import decontaminate as D


def words(text):
    import re
    t = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(text, items, window):
    w, hit, ids = words(text), set(), set()
    for item, body in items:
        b = words(body)
        n = min(window, len(b))
        for j in range(len(b) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == b[j:j + n]:
                    hit.update(range(i, i + n))
                    ids.add(item)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None)


def tables(seed, small):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(6 if small else 40)] + ["É", "日本"]
    items = [(i, "-".join(rnd.choices(vocab, k=rnd.choice([0, 1, 2, 4, 9, 12, 30])))) for i in range(12)]
    items += [(3, "Twice Used Id and its other words in a row of eleven"), (None, "no id here"), (50, None), (51, "")]
    docs = []
    for i in range(40):
        parts = rnd.choices(vocab, k=rnd.choice([0, 3, 20, 60]))
        if i % 3 == 0:
            parts.insert(len(parts) // 2, rnd.choice(items)[1] or "")
        docs.append((i, " ".join(parts)))
    return docs + [(100, None), (101, ""), (102, "v1 " * 3000), (103, "no id here, No ID HERE")], items


@pytest.mark.parametrize("seed,small,most,most_bytes", [(1, True, 100_000, D.PASS_BYTES), (2, False, 100_000, D.PASS_BYTES),
                                                        (3, True, 15, 6_000), (4, False, 30, D.PASS_BYTES), (5, True, 60, 1)])
def test_against_brute_force(spark, docs, seed, small, most, most_bytes):
    rows, items = tables(seed, small)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find(spark, docs(rows, extra=True), bench, window=4, most=most, most_bytes=most_bytes)
    assert "node" in got.columns
    for r in got.collect():
        n, hit, ids = brute(dict(rows)[r.doc_id], items, 4)
        assert (r.n_words, sum(h.b - h.a for h in r.hits), r["items"]) == (n, hit, ids), r.doc_id


def test_removal_and_coverage(spark, docs):
    passage = " ".join(f"p{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage.upper())], "item_id long, text string")
    filler = " ".join(f"é{i}" for i in range(40))
    found = D.find(spark, docs([filler, passage, f"{filler} {passage}, {filler}", None]), bench)
    got = {r.doc_id: r for r in D.remove(found, 0.5).collect()}
    assert sorted(got) == [0, 2, 3] and got[0].text == filler and got[3].text is None
    assert got[2].text == f"{filler} , {filler}" and got[2].n_chars == len(got[2].text)


@pytest.mark.parametrize("max_span", [1, 15])
def test_removal_of_touching_spans_of_several_automata(spark, docs, max_span):
    parts = [" ".join(f"{c}{i}" for i in range(12)) for c in "pqr"]
    bench = spark.createDataFrame(list(enumerate(parts)), "item_id long, text string")
    filler = " ".join(f"é{i}" for i in range(60))
    rows = [f"{filler} {parts[0]}, {parts[1]} {filler} {parts[2]} {filler}", f"{filler} {parts[2]} {parts[0]} {parts[1]}"]
    want = [f"{filler}  {filler}  {filler}" if max_span == 1 else f"{filler}  {filler} {parts[2]} {filler}", f"{filler} "]
    assert len(list(D.automata(bench, most=12))) == 3
    for most, most_bytes in ((12, 1), (12, D.PASS_BYTES), (D.SHARD_WORDS, D.PASS_BYTES)):  # three passes, one of three automata, one
        found = D.find(spark, docs(rows), bench, most=most, most_bytes=most_bytes)
        assert all(len(r.hits) == len(r.cuts) for r in found.collect())
        assert [r.text for r in D.remove(found, 0.5, max_span).orderBy("doc_id").collect()] == want


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [r.contaminated for r in D.report(D.find(spark, docs(["a b c"]), none)).collect()] == [False]
    assert D.report(D.find(spark, docs([]), bench)).collect() == []


def test_passes_and_their_tables(spark, docs, monkeypatch):
    """Automata share a pass up to the byte limit; only the last table between passes is left."""
    assert list(D.passes(iter([b"aa", b"bbb", b"c", b"dddddd", b"e"]), 5)) == [[b"aa", b"bbb"], [b"c"], [b"dddddd"], [b"e"]]
    made, gone = [], []
    table, drop = D.Scratch.table, D.Scratch.drop
    monkeypatch.setattr(D.Scratch, "table", lambda self, df, name: made.append(name) or table(self, df, name))
    monkeypatch.setattr(D.Scratch, "drop", lambda self, *names: gone.extend(names) or drop(self, *names))
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(6)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"{a} and {b}" for (_, a), (_, b) in zip(items, items[1:])]
    blobs = list(D.automata(bench, most=12))
    for most_bytes, tables in ((D.PASS_BYTES, 0), (2 * max(map(len, blobs)), 2), (1, 5)):
        made.clear(), gone.clear()
        got = D.find(spark, docs(texts), bench, most=12, most_bytes=most_bytes).orderBy("doc_id").collect()
        assert [r["items"] for r in got] == [[str(i), str(i + 1)] for i in range(5)]
        assert made == [f"pass-{i + 1}" for i in range(tables)] and gone == made[:-1]


def test_an_automaton_is_small():
    """States with one successor, the most of them, are flat numbers; items that share windows share a list."""
    rnd = np.random.default_rng(5)
    a = D.build([(i, rnd.integers(0, 3000, 200).astype(np.uint64)) for i in range(250)])
    assert len(a.word) > 50_000 and len(a.several) < len(a.word) / 4 and len(a.sets) == 251
    text = np.arange(30, dtype=np.uint64)
    both = D.build([(1, text), (2, text[5:]), (3, text[:4])])
    assert set(both.sets) == {(), (1,), (1, 2)} and D.match(both, list(range(30)))[1] == {1, 2, 3}
