"""The greedy feed fold (F3, F4) on hand-made cases with written-out results. The twins check it on whole tables."""

import pytest

from conftest import SF01
from shelfrank.operators import feed
from shelfrank.plans import registry as R

# Products 1-9 are of category A, 11-19 of B, 21-29 of C.
PRODUCTS = [(i, "ABC"[i // 10]) for i in range(1, 30) if i % 10]
#: name: (anchors with similar and complementary slots, similar lists, complementary lists, categories, popular lists, feed)
CASES = {
    "slots are filled anchor by anchor, similar first": (
        [(1, 2, 1), (2, 1, 1)], {1: [3, 4, 5], 2: [6, 7]}, {1: [11, 12], 2: [13, 14]}, ["A", "B"], {},
        [3, 4, 11, 6, 13]),
    "what is taken is not taken again, the next one is": (
        [(1, 2, 0), (2, 2, 0)], {1: [3, 4], 2: [3, 4, 5, 6, 7]}, {}, ["A"], {},
        [3, 4, 5, 6]),
    "anchors are never shown": (
        [(1, 2, 1), (3, 1, 0)], {1: [3, 4, 5], 3: [1, 6]}, {1: [3, 7]}, ["A"], {},
        [4, 5, 7, 6]),
    "other categories and unknown products are passed over": (
        [(1, 2, 2)], {1: [21, 99, 3, 4]}, {1: [22, 11, 12]}, ["A", "B"], {},
        [3, 4, 11, 12]),
    "fewer than six are padded by popular ones in category order": (
        [(1, 1, 1)], {1: [3]}, {1: [11]}, ["B", "A"], {"A": [3, 5, 1, 6], "B": [12, 11, 13], "C": [21]},
        [3, 11, 12, 13, 5, 6]),
    "padding ends at fourteen": (
        [(1, 1, 0)], {1: [2]}, {}, ["A", "B"], {"A": [2, 3, 4, 5, 6, 7, 8, 9], "B": [11, 12, 13, 14, 15, 16, 17, 18]},
        [2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, 16]),
    "six are not padded": (
        [(1, 6, 0)], {1: [2, 3, 4, 5, 6, 7]}, {}, ["A"], {"A": [8, 9]},
        [2, 3, 4, 5, 6, 7]),
    "a product that is an anchor's own similar twice over": (
        [(1, 1, 1), (11, 1, 1)], {1: [2], 11: [12]}, {1: [12], 11: [2, 3]}, ["A", "B"], {},
        [2, 12, 3]),
    "no categories, no feed": ([(1, 3, 3)], {1: [2, 3]}, {1: [11]}, [], {"A": [4]}, []),
}


@pytest.fixture(scope="module")
def feeds(spark):
    slots, sims, comps, cats, pops = [], [], [], [], []
    names = list(CASES)
    for u, name in enumerate(names):
        anchors, sim, comp, categories, popular, _ = CASES[name]
        base = 1000 * u  # every case has products and categories of its own
        slots += [(u, base + a, r + 1, s, c) for r, (a, s, c) in enumerate(anchors)]
        sims += [(base + a, base + p, r + 1) for a, lst in sim.items() for r, p in enumerate(lst)]
        comps += [(base + a, base + p, r + 1) for a, lst in comp.items() for r, p in enumerate(lst)]
        cats.append((u, [f"{u}{c}" for c in categories]))
        pops += [(f"{u}{c}", base + p, r + 1) for c, lst in popular.items() for r, p in enumerate(lst)]
    products = [(1000 * u + p, f"{u}{c}") for u in range(len(names)) for p, c in PRODUCTS]
    out = feed.personal_feed(
        spark.createDataFrame(slots, "user_id long, product_id long, weight_rank int, sim_slots int, comp_slots int"),
        spark.createDataFrame(sims, "source_product_id long, similar_product_id long, sim_rank int"),
        spark.createDataFrame(comps, "source_product_id long, comp_product_id long, comp_rank int"),
        spark.createDataFrame(products, "product_id long, category string"),
        spark.createDataFrame(cats, "user_id long, categories array<string>"),
        spark.createDataFrame(pops, "category string, product_id long, rank int"))
    got = {}
    for r in out.orderBy("user_id", "position").collect():
        got.setdefault(names[r.user_id], []).append(r.product_id % 1000)
    return got


@pytest.mark.parametrize("name", CASES)
def test_case(feeds, name):
    assert feeds.get(name, []) == CASES[name][-1]


def test_feeds_are_short_without_repeats_or_anchors(spark):
    inputs = R.feed_inputs(spark, SF01)
    anchors = {(r.user_id, r.product_id) for r in inputs["slots"].collect()}
    rows = [(r.user_id, r.product_id) for r in feed.personal_feed(**inputs).collect()]
    assert rows and len(set(rows)) == len(rows) and not set(rows) & anchors
    assert max(sum(u == v for v, _ in rows) for u in {u for u, _ in rows}) <= 14
