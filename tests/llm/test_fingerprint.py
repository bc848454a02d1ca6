import hashlib
import random

import numpy as np
import pyarrow as pa

from shelfrank.llm import fingerprint as FP


def brute(rows):
    """(doc_id, text) rows in descending order with their next text, wrapping around."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1] or ""
        t = t or ""
        k = len(t) // 3
        yield d, t, t[:len(t) - k] + nxt[:k], nxt


def jaccard(a, b):
    def shingle(t):
        w = t.translate({i: i + 32 for i in range(65, 91)}).split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    x, y = shingle(a), shingle(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def rows(seed=3, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["é", "ß", "日本"]
    return [(i * 7, " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 5, 40, 300])))) for i in range(n)]


def test_edits_order_and_likeness(spark, docs):
    data = rows() + [(5000, None), (5001, ""), (5002, "x" * 3000), (5003, "a b " * 20000)]
    got = {r.doc_id: r for r in FP.with_next(spark, docs(data, extra=True)).collect()}
    assert len(got) == len(data)
    for d, t, e, nxt in brute(data):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b, c = FP.fingerprints(pa.array([t, e, nxt]))
        assert (r.fingerprint, r.edited_fingerprint) == (a, b)
        assert abs(r.near_edited - jaccard(t, e)) < 0.2 and abs(r.near_next - jaccard(t, nxt)) < 0.2


def test_ties_nulls_empty_and_single(spark, docs):
    data = [(1, "a b c"), (1, "b c d"), (None, "n n n"), (2, "x y z"), (2, "x y z"), (None, None)]
    got = FP.with_next(spark, docs(data)).collect()
    want = sorted((str(d), hashlib.sha256(e.encode()).hexdigest()) for d, _, e, _ in brute(data))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == want
    assert FP.with_next(spark, docs([])).collect() == []
    one = FP.with_next(spark, docs(["one two three"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_estimate_is_unbiased():
    rnd = random.Random(5)
    base = [f"t{rnd.randrange(10**9)}" for _ in range(600)]
    errors = []
    for trial in range(60):
        other = list(base)
        for i in rnd.sample(range(600), 30):
            other[i] = f"u{rnd.randrange(10**9)}"
        pre = f"s{trial} "
        a, b = pre + " ".join(base), pre + " ".join(other)
        x, y = FP.fingerprints(pa.array([a, b]))
        errors.append(FP.likeness(x, y) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_densified_bins_come_from_filled_bins():
    table = FP.bins(np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([0, 0, 1, 39]))
    full = FP.densify(table)
    assert (full[0] == table[0]).all()  # nothing to take from
    for r in (1, 2):
        assert set(full[r].tolist()) <= set(table[r][table[r] != FP._EMPTY].tolist())
    assert FP.likeness("", "") == 1 and FP.likeness("", FP.fingerprints(pa.array(["a"]))[0]) == 0
