"""Feed weights / slots and toggle state on hand-made histories (F1, F2, W7, ST2, ST3, ST5)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from shelfrank.operators import feed, state

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def hist(spark, rows):
    return spark.createDataFrame(rows, "user_id long, event_id long, product_id long, interaction_type string, ts timestamp_ntz")


def test_decay_weight_values_and_future_event(spark):
    rows = [(1, 1, 10, "view", T0 - dt.timedelta(hours=48)), (1, 2, 10, "view", T0 - dt.timedelta(hours=48)),
            (1, 3, 11, "view", T0 + dt.timedelta(hours=5)),         # in the future: counts as 0 hours
            (1, 4, 12, "view", T0)]
    w = feed.time_decay_weights(hist(spark, rows), F.lit(T0))
    got = {r.product_id: r.weight for r in w.collect()}
    assert math.isclose(got[10], 0.5 * (1 + math.log2(3)))
    assert math.isclose(got[11], 1.0 * (1 + math.log2(2)))
    assert math.isclose(got[12], 1 + math.log2(2))


def test_slots_match_reference_rounding(spark):
    # weights chosen so that weight / total * 14 hits .5 exactly and several slot counts
    ws = [(1, p, w) for p, w in [(1, 7.0), (2, 3.5), (3, 2.5), (4, 1.0), (5, 0.0001)]]
    df = spark.createDataFrame(ws, "user_id long, product_id long, weight double")
    got = {r.product_id: (r.slots, r.sim_slots, r.comp_slots, r.weight_rank) for r in feed.feed_slots(df).collect()}
    total = sum(w for _, _, w in ws)
    for _, p, w in ws:
        slots = max(1, math.floor(w / total * 14 + 0.5))
        assert got[p][0] == slots
        assert got[p][1] == math.ceil(slots * 0.6) and got[p][2] == slots - math.ceil(slots * 0.6)
    assert [p for p, v in sorted(got.items(), key=lambda kv: kv[1][3])] == [1, 2, 3, 4, 5]


def test_ceil_formula_for_all_slot_counts():
    for s in range(1, 15):
        assert (3 * s + 4) // 5 == math.ceil(s * 0.6)


def test_history_cap_and_equal_timestamps(spark):
    rows = [(1, i, i % 7, "view", T0 + dt.timedelta(minutes=i // 2), "s") for i in range(60)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, product_id long, interaction_type string, ts timestamp_ntz, session_id string")
    h = feed.recent_interactions(df).collect()
    assert len(h) == 50
    assert {r.event_id for r in h} == set(range(10, 60))
    first = [r for r in h if r.recency_rank == 1][0]
    assert first.event_id == 59                         # equal ts: larger event id is newer


def toggles(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, product_id long, action string, ts timestamp_ntz")


def test_toggle_parity_order_and_reset(spark):
    t = [(1, 1, 5, "like_toggle", T0), (2, 1, 5, "like_toggle", T0 + dt.timedelta(1)),
         (3, 1, 5, "like_toggle", T0 + dt.timedelta(2)),               # on, off, on -> in list
         (4, 1, 6, "like_toggle", T0 + dt.timedelta(hours=1)),         # added before 5's last add
         (5, 2, 7, "like_toggle", T0), (7, 2, 7, "like_toggle", T0 + dt.timedelta(2)),   # second toggle after reset
         (8, 2, 8, "cart_toggle", T0 + dt.timedelta(3))]
    resets = spark.createDataFrame([(2, 6)], "user_id long, reset_event_id long")
    wl = {(r.user_id, r.product_id): r.position for r in state.wishlist_state(toggles(spark, t), resets).collect()}
    assert wl == {(1, 6): 1, (1, 5): 2, (2, 7): 1}
    cart = {(r.user_id, r.product_id) for r in state.cart_state(toggles(spark, t), resets).collect()}
    assert cart == {(2, 8)}


def test_preferences_last_valid_wins(spark):
    products = spark.createDataFrame([(i, c) for i, c in enumerate("ABCDEF")], "product_id long, category string")
    upd = spark.createDataFrame([(1, 1, T0, 0, 1, 2), (2, 1, T0 + dt.timedelta(1), 3, 4, 3),
                                 (3, 1, T0 + dt.timedelta(2), 5, 0, 1)],        # n = 1: invalid, ignored
                                "event_id long, user_id long, ts timestamp_ntz, c1 long, c2 long, n_categories long")
    got = feed.latest_preferences(upd, products).collect()
    assert [(r.user_id, list(r.categories)) for r in got] == [(1, ["D", "E", "F"])]


def test_a_hot_users_list_is_numbered_in_many_tasks(spark):
    """One user with half of all toggles: the same positions as one window a user, and no large group."""
    from pyspark.sql import Window
    n = 6000
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50 + 100).cast("long").alias("user_id"),
        (F.col("id") % 5000).alias("product_id"), F.lit("like_toggle").alias("action"),
        F.when(F.col("id") % 997 != 0, F.timestamp_add("MINUTE", F.col("id") * 7 % 9000, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))).alias("ts"))
    rows = rows.unionByName(rows.filter("user_id = 101").withColumn("user_id", F.lit(None).cast("long")))
    got = state.wishlist_state(rows)
    w = Window.partitionBy("user_id").orderBy("added_ts", "added_event_id")
    plain = got.withColumn("want", F.row_number().over(w))
    assert plain.filter("position <> want").count() == 0 and got.filter("user_id IS NULL").count() > 0
    hot = got.filter("user_id = 7")
    assert hot.count() > 1000 and hot.select(F.max("position")).first()[0] == hot.count()
    hours = hot.groupBy(F.date_trunc("hour", "added_ts")).count().agg(F.max("count"), F.count("*")).first()
    assert hours[0] < hot.count() / 20 and hours[1] > 100
