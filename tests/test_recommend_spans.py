"""Users are copied to spans of blocks; queries that read the split often store it."""

import random

import pytest

from shelfrank.operators import recommend
from shelfrank.plans import registry as R


def test_a_user_is_copied_to_spans(spark, monkeypatch):
    rnd = random.Random(3)
    users = [(u, [rnd.random() for _ in range(3)]) for u in range(30)]
    items = [(i, [rnd.random() * (1 + i % 5) for _ in range(3)]) for i in range(200)]
    seen = {(u, i) for u in range(30) for i in range(0, 200, 3) if (u + i) % 2}
    copies, scored = [], recommend._scored
    monkeypatch.setattr(recommend, "_scored", lambda u, *rest: (copies.append(u.groupBy("user_id").count().agg({"count": "max"}).first()[0]), scored(u, *rest))[1])
    got = recommend.score_top_n(spark.createDataFrame(users, "user_id long, factors array<double>"), spark.createDataFrame(items, "product_id long, factors array<double>"),
                                spark.createDataFrame(sorted(seen), "user_id long, product_id long"), 3, n=6, user_block=8, item_block=4)
    want = set()
    for u, w in users:
        rows = sorted((-sum(a * b for a, b in zip(w, h)), i) for i, h in items if (u, i) not in seen)[:6]
        want |= {(u, i, place + 1) for place, (_, i) in enumerate(rows)}
    assert {(r["user_id"], r["product_id"], r["rec_rank"]) for r in got.collect()} == want
    assert copies == [1, 1]  # the first block, and one span of all others


@pytest.mark.parametrize("name", ["model_metrics", "export_recommendations", "lookup_fixed_recommendations", "lookup_recommendations"])
def test_split_is_stored(monkeypatch, name):
    made = []

    def context(spark, d, stored=False):
        made.append(stored)
        raise InterruptedError
    monkeypatch.setattr(R, "Ctx", context)
    with pytest.raises(InterruptedError):
        R.QUERIES[name](None, "")
    assert made == [True]
