import random

import numpy as np
import pytest

from shelfrank.llm import near_dup as N


def shingles(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets), key=str)


def check(spark, df, rows):
    got = N.near_duplicates(spark, df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def edited(rnd, words, k):
    words = list(words)
    for i in rnd.sample(range(len(words)), k):
        words[i] = f"e{rnd.randrange(10**6)}"
    return words


def test_copies_stars_and_chains(spark, docs):
    rnd = random.Random(2)
    texts = []
    for _ in range(8):
        base = [f"w{rnd.randrange(3000)}" for _ in range(300)]
        texts += [" ".join(base)] * rnd.choice([1, 4])
        texts += [" ".join(edited(rnd, base, k)) for k in (1, 2, 4, 4, 6, 12)]  # copies unlike each other, alike the base
        chain = base
        for _ in range(6):
            chain = edited(rnd, chain, 4)
            texts.append(" ".join(chain).upper())
    rnd.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    check(spark, docs(rows, extra=True), rows)


def test_large_bucket_around_a_late_base(spark, docs, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_NODES", 16)  # many blocks for one bucket
    monkeypatch.setattr(N, "CENTER_SHARE", 10)
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(edited(rnd, base, 5))) for i in range(90)] + [(500, " ".join(base))]
    check(spark, docs(rows), rows)
    assert len({r[2] for r in brute(rows)}) == 1


def test_nulls_short_long_ties_empty(spark, docs):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, long), (8, long + " end"),
            (9, "a b c d e"), (10, "y" * 5000), (11, "y" * 5000), (None, "one two"), (None, None), (4, "one two")]
    check(spark, docs(rows), rows)
    assert N.near_duplicates(spark, docs([])).collect() == []


def test_texts_that_share_a_doc_id_keep_all_their_near_copies(spark, docs):
    rnd = random.Random(6)
    rows = []
    for i in range(20):
        for k in range(3):  # three texts under one doc_id, a near copy of each under its own
            base = [f"w{rnd.randrange(5000)}" for _ in range(200)]
            rows += [(i, " ".join(base)), (100 * (k + 1) + i, " ".join(edited(rnd, base, 1)))]
    check(spark, docs(rows), rows)
    assert sum(keep for _, _, _, keep in brute(rows)) == 60  # the 60 rows of the 20 shared doc_ids


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 2**63, 1000).astype(np.uint64)
    for keep in (0.95, 0.8, 0.5):
        y = np.concatenate([x[:int(keep * 1000)], rnd.integers(0, 2**63, 1000 - int(keep * 1000)).astype(np.uint64)])
        true = int(keep * 1000) / (2000 - int(keep * 1000))
        sig = N.signatures(np.concatenate([x, y]), np.array([0, 1000, 2000]), 1000)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.06


@pytest.mark.parametrize("columns", [7, 4096])
def test_common_counts(columns, monkeypatch):
    monkeypatch.setattr(N, "_COLUMNS", columns)
    rnd = np.random.default_rng(3)
    groups = [np.unique(rnd.integers(0, 90, rnd.integers(1, 60))).astype(np.uint64) for _ in range(12)]
    got = N.common_counts(groups[:5], groups[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in groups[5:]] for a in groups[:5]]
