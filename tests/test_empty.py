"""Operators on empty inputs: no error, empty (or zero) results."""

from pyspark.sql import functions as F

from conftest import SF01
from shelfrank.operators import baseline, catalog, clean, factor, feed, matrix, recommend, state
from shelfrank.plans import registry as R
from shelfrank.sources import testdata as td


def test_empty_inputs(spark):
    c = R.Ctx(spark, SF01)
    log = clean.clean_interactions(td.interactions(spark, SF01).filter(F.lit(False)))
    products = c.products
    assert log.count() == 0
    assert catalog.popular_by_category(products, log).count() == 0
    stats = catalog.product_engagement(products, log)
    assert stats.filter("total_engagement > 0").count() == 0
    assert catalog.similar_products(stats.filter(F.lit(False))).count() == 0
    m = matrix.user_product_matrix(log)
    split = matrix.train_test_split(matrix.matrix_input(m))
    model = factor.fit_nmf(spark, split, k=3, max_iter=2)
    assert model.iterations == 0 and model.user_factors.count() == 0
    assert recommend.recommend_top_n(model.user_factors, model.item_factors, split, products, 3).count() == 0
    hist = feed.recent_interactions(log)
    slots = feed.feed_slots(feed.time_decay_weights(hist, feed.latest_ts(log)))
    assert slots.count() == 0
    assert feed.personal_feed(slots, c.similar, c.complementary, products, c.user_cats, c.popular).count() == 0
    assert baseline.baseline_recommender(log, products).count() == 0
    assert state.wishlist_state(c.toggles.filter(F.lit(False))).count() == 0
