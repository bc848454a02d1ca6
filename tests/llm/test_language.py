import random

import numpy as np

from shelfrank.llm import language as L

ENDINGS = {"aa": ["ing", "tion", "the", "ed"], "bb": ["ung", "heit", "der", "ö"], "cc": ["ción", "mente", "los", "ñ"]}


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(ENDINGS))
        words = ["".join(rnd.choices(ENDINGS[lang] + ["a", "s", "t"], k=rnd.randrange(1, 5))) for _ in range(rnd.randrange(4, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_held_out_accuracy(spark):
    rows = corpus(400)
    model = L.fit(frame(spark, rows[:250]))
    assert model.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in L.predict(spark, frame(spark, rows[250:]).drop("lang"), model).collect()}
    assert np.mean([got[i].lang_pred == g for i, _, g in rows[250:]]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def plain_scores(model, text):
    """The method word by word."""
    out, n = np.zeros(len(model.languages)), 0
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            x = L.letters([word])
            n += 1
            h = L.word_hashes(x)[0]
            if h in model.keys[0]:
                out += model.logs[0][np.searchsorted(model.keys[0], h)]
            else:
                for order in L.ORDERS:
                    hashes = [h for h in L.gram_hashes(x, np.array([0]), order)[0] if h in model.keys[order]]
                    if hashes:
                        out += np.mean([model.logs[order][np.searchsorted(model.keys[order], h)] for h in hashes], axis=0)
                        break
        word = ""
    return out / max(n, 1), n


def test_backoff_word_by_word(spark):
    rows = corpus(60)
    model = L.fit(frame(spark, rows), entries=400)
    texts = ["the thing xyz", "", "12 ! 3", "ungheit losción QQQ İstanbul", "ж", "a" * 6000 + " the", rows[0][1]]
    got = L.scores(model, texts)
    for t, s in zip(texts, got):
        want, n = plain_scores(model, t)
        assert n == s[-1] and np.allclose(s[:-1], want, atol=1e-3), t


def test_hashes_depend_on_the_word_only():
    x = L.letters(["one two", "two, ONE!", "x" * 5000])
    h = L.word_hashes(x).tolist()
    assert h[0] == h[3] and h[1] == h[2] and len(set(h)) == 3
    a, n = L.gram_hashes(x, np.array([0, 3]), 3)
    assert a[:n[0]].tolist() == a[n[0]:].tolist() and n.tolist() == [3, 3]


def test_nulls_ties_empty(spark):
    rows = corpus(50) + [(900, None, "aa"), (901, "", "bb"), (902, "123", None), (903, "the the", None), (None, "ungheit", "bb"), (5, "los", "cc"), (5, "los", "cc"), (904, "9", "dd")]
    model = L.fit(frame(spark, rows))
    got = L.predict(spark, frame(spark, rows).withColumnRenamed("lang", "node"), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] in ENDINGS
    empty = L.fit(frame(spark, []))
    assert [tuple(r)[-2:] for r in L.predict(spark, frame(spark, [(1, "the", "aa")]), empty).collect()] == [("und", 0.0)]
    assert L.predict(spark, frame(spark, []), model).collect() == []
