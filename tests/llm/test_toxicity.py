import random

import numpy as np

from shelfrank.llm import quality as Q
from shelfrank.llm import toxicity as X

SYLLABLES = ["th", "on", "er", "ing", "tion", "re", "an", "ed", "es", "ou", "ble", "st"]
INSULTS = ["blockhead", "nitwit", "dimwitted", "numbskull"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choices(SYLLABLES, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(30, 150))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rnd.randrange(3, 6)):
                words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        rows.append((i, " ".join(words).capitalize() + ".", int(toxic)))
    return rows


def test_held_out_accuracy(spark, docs):
    rows = corpus(900)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    frame = docs([(i, t) for i, t, _ in rows], extra=True).drop("score")
    got = X.score(spark, frame, X.fit(frame, labels, "toxic")).select("doc_id", "score", "predicted", Q.held_out().alias("held")).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    caught = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.03


def test_windows_cover_the_whole_text():
    rnd = random.Random(2)
    for text in ("", "a", "x" * 1000, "é " * 300, " ".join("w" * rnd.randrange(1, 90) for _ in range(200))):
        parts = X.windows(text)
        assert "".join(parts) == text and all(0 < len(p) <= X.WINDOW for p in parts)


def test_gain_shows_what_the_toxic_dictionary_knows():
    ordinary = X.compressor(b"the quick brown fox jumps over the lazy dog " * 20)
    toxic = X.compressor(b"blockhead nitwit " + b"the quick brown fox jumps over the lazy dog " * 20)
    assert X.gains("you blockhead the lazy dog", ordinary, toxic).max() >= 3
    assert abs(X.gains("the quick brown fox and the lazy dog", ordinary, toxic)).max() <= 1


def test_nulls_ties_and_empty_tables(spark, docs):
    frame = docs([(1, None), (2, ""), (None, "x y"), (3, "y"), (3, "y"), (4, "z " * 50_000)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score(spark, frame, X.fit(frame, none, "toxic")).collect()} == {X.score(spark, docs(["q"]), X.fit(frame, none, "toxic")).first().score}
    few = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (3, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    got = X.score(spark, frame, X.fit(frame, few, "toxic")).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert X.score(spark, docs([]), X.fit(docs([]), few, "toxic")).collect() == []


def test_rare_marks_count_at_any_sample_size(spark, docs):
    """A word of some 1 % of the toxic documents, and of no ordinary one, is learnt from many rows too."""
    rows = corpus(9000)
    clean = {w: "on" for w in INSULTS}
    rare = [(i, " ".join(clean.get(w, w) for w in t.split()) + " zounderkite" * 4 if y and i % 540 == 0 else t, y) for i, t, y in rows]
    labels = spark.createDataFrame([(i, y) for i, _, y in rare], "doc_id long, toxic int")
    model = X.fit(docs([(i, t) for i, t, _ in rare]), labels, "toxic")
    assert b"zounderkite" in model.toxic


def test_toxic_dictionary_holds_every_word():
    words = [f"blockhead{i}mark###" for i in range(3000)] + ["é" * 500]
    made = X.with_all(b"blockhead7mark### trained", words)
    assert all(w[:X.WINDOW].encode() in made for w in words) and made.endswith(b"blockhead7mark### trained") and made.count(b"blockhead7mark###") == 1
