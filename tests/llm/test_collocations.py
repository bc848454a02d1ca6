import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import automata as A
from shelfrank.llm import collocations as C


def brute(rows, threshold, longest, top):
    """rows: (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cands = {key: a for key, a in f.items() if a >= threshold and len(key[1]) > 1}
    gone = {(lang, p[i:j]) for (lang, p), a in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and (lang, p[i:j]) in cands and a >= cands[lang, p[i:j]]}
    out = []
    for lang in n:
        scored = []
        for (other, p), a in cands.items():
            if other == lang and (lang, p) not in gone:
                cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def check(spark, rows, threshold=4, longest=5, top=2000, partitions=3):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(partitions).withColumns({c: F.lit("x") for c in ("n", "range", "phrase", "kind", "f")})
    got = C.phrases(spark, df, threshold, longest, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, threshold, longest, top)
    assert sorted(tuple(r) for r in got.collect()) == want
    return want


def corpus(seed, n, vocabulary, langs=("en", "fr", None)):
    rnd = random.Random(seed)
    phrases = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(2, 8))) for _ in range(12)]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.randrange(30)):
            text += rnd.choice(phrases) if rnd.random() < 0.3 else rnd.choice(vocabulary)
            text += rnd.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"])
        rows.append((rnd.choice(langs), rnd.choice([text, text.upper(), text.title()])))
    return rows


@pytest.mark.parametrize("shard", [C.SHARD, 300])
def test_random_texts(spark, monkeypatch, shard):
    monkeypatch.setattr(C, "SHARD", shard)
    vocabulary = ["a", "b", "the", "von", "été", "漢", "x-y", "of", " ", "q'"]
    assert len(check(spark, corpus(1, 200, vocabulary))) > 50
    check(spark, corpus(2, 60, [f"w{i}" for i in range(40)]), threshold=2, top=7)


def test_hot_word_and_other_lengths(spark):
    rnd = random.Random(3)
    rows = [("en", " ".join("the" if rnd.random() < 0.4 else rnd.choice("abcdef") for _ in range(60))) for _ in range(60)]
    check(spark, rows, threshold=20, longest=3)
    check(spark, rows, threshold=20, longest=2)


def test_frequent_tails_go_with_their_longer_phrase(spark):
    rows = [("en", "new york city hall")] * 6 + [("en", "york city")] * 3 + [("en", "City Hall, new. york")] * 2
    phrases = {r[2] for r in check(spark, rows, threshold=4)}
    assert "york city" in phrases and "city hall" in phrases and "new york" not in phrases and "new york city hall" in phrases


def test_nulls_empties_repeats_and_ties(spark):
    rows = [(None, "a b")] * 5 + [("und", "a b, c d")] * 5 + [("de", None), ("fr", ""), ("es", " .,\t\n")] + [("it", "x y x y x y x y x y")] + [("en", "b a. a c. d e")] * 4
    check(spark, rows)
    assert check(spark, []) == []
    assert check(spark, [("en", "a b c")]) == []


def test_a_very_long_text(spark):
    check(spark, [("en", " ".join(random.Random(1).choices("abcdefgh", k=60_000)))], threshold=100)


def test_scores_are_exact_beyond_64_bits(spark):
    a, n = 3 * 10 ** 12 + 7, 9 * 10 ** 13 + 11
    cuts = [(a + 1, a + 5), (a, a + 1), (a + 2, 2 * a), (2 * a, a + 2)]
    row = spark.createDataFrame([(a, n, [x for x, _ in cuts], [y for _, y in cuts])], "a long, n long, l array<long>, r array<long>")
    want = min((1000 * a * n // (x * y), k) for k, (x, y) in enumerate(cuts))
    assert tuple(row.select(F.expr(C.BEST).alias("best")).first()["best"]) == want


def test_automata_are_minimal_and_unite():
    rng = np.random.default_rng(0)
    total = Counter()
    union = A.Union(3, most=50)
    for _ in range(20):
        rows = rng.integers(0, 4, (60, 3))
        cut = rng.integers(1, 4, 60)
        rows[np.arange(3) >= cut[:, None]] = -1
        ranges = rows[:, 0] % 2
        order = np.lexsort([*rows.T[::-1], ranges])
        names = pa.array([b"a", b"b", "é".encode(), b"c d"], pa.large_binary())
        packed = A.pack(rows[order], ranges[order], np.ones(60, np.int64), names)
        assert packed["range"].to_pylist() == sorted(set(ranges.tolist()))
        for row in rows.tolist():
            for d in range(1, 4):
                if row[d - 1] >= 0:
                    total[tuple(names[i].as_py() for i in row[:d])] += 1
        union.add(*A.paths(packed, 3))
    union.merge()
    got = {tuple(union.names[int(i)].as_py() for i in row): int(w) for rows, weights in union.levels for row, w in zip(rows, weights)}
    assert got == dict(total)


def test_equal_tails_are_one_state():
    rows = np.array([[i, 7, 8] for i in range(5)] + [[5, 7, 9]])
    _, levels, _ = A.build(rows, np.zeros(6, np.int64), np.ones(6, np.int64))
    assert [len(x.sizes) for x in levels] == [1, 2, 2]  # root; "7 8" shared by five, "7 9"
    assert [x.weights.tolist() for x in levels] == [[1] * 6, [1, 1], [1, 1]]


def test_lookups_by_composition():
    rows = np.array([[0, 1, -1], [0, 1, 2], [0, 3, -1], [4, -1, -1]])
    counter = A.Counter(rows, np.array([9, 5, 7, 3]))
    asked = np.array([[0, 1, 2], [0, 1, -1], [0, -1, -1], [4, -1, -1], [4, 1, -1], [0, 3, 3]])
    assert counter.walk(asked)[1].tolist() == [5, 9, 0, 3, 0, 0]
