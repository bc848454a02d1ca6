"""User state from event logs, batch form (ST2-ST6, A20).

The stream versions in ``shelfrank.streaming`` produce the same tables from the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.columns import ntz_micros, session_key
from shelfrank.operators.feed import after_reset

HOUR_US = 3_600_000_000


def toggle_state(toggles: DataFrame, action: str, resets: DataFrame | None = None) -> DataFrame:
    """ST2/ST3: a product is in the list when its number of toggles (after the last reset) is odd;
    list order is the order of the last toggle, which is then an add."""
    t = after_reset(toggles.filter(F.col("action") == action), resets)
    per = t.groupBy("user_id", "product_id").agg(F.count("*").alias("n_toggles"),
                                                 F.max(F.struct("ts", "event_id")).alias("_last"))
    kept = per.filter(F.col("n_toggles") % 2 == 1).select(
        "user_id", "product_id", F.col("_last.event_id").alias("added_event_id"), F.col("_last.ts").alias("added_ts"))
    return numbered(kept)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (user_id, added_ts, added_event_id, ...) with their position in the user's list, by time and event. Places are counted within the
    hours of a user, in as many tasks as there are hours, and the hours before a row's own are added from a table of one count
    for each hour; so no task numbers a whole list. Rows without a time come first."""
    rows = rows.withColumn("_hour", F.coalesce(F.floor(ntz_micros("added_ts") / HOUR_US), F.lit(-(1 << 62))))
    sizes = rows.groupBy("user_id", "_hour").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("user_id").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("user_id").alias("_user"), F.col("_hour").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("user_id", "_hour").orderBy("added_ts", "added_event_id")
    placed = rows.withColumn("_place", F.row_number().over(inside))
    same = placed["user_id"].eqNullSafe(before["_user"]) & (placed["_hour"] == before["_of"])
    return placed.join(before, same).withColumn("position", (F.col("_before") + F.col("_place")).cast("int")).drop("_hour", "_user", "_of", "_before", "_place")


def wishlist_state(toggles: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    return toggle_state(toggles, "like_toggle", resets)


def cart_state(toggles: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    return toggle_state(toggles, "cart_toggle", resets)


def additions(toggles: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    """The toggles that add a product to a list: the odd ones of each user, product and list after the
    last reset. Each is an event of the log, a ``like`` or an ``add_to_cart``; a removal is none."""
    t = after_reset(toggles, resets)
    w = Window.partitionBy("user_id", "product_id", "action").orderBy("ts", "event_id")
    kind = F.when(F.col("action") == "like_toggle", "like").otherwise("add_to_cart")
    return (t.withColumn("_n", F.row_number().over(w)).filter((F.col("_n") % 2 == 1) & F.col("product_id").isNotNull())
            .select("event_id", "user_id", "product_id", kind.alias("interaction_type"), "ts"))


def with_additions(interactions: DataFrame, toggles: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    """The clean log together with the additions of the toggles, as the re-ranker sees it."""
    cols = ["event_id", "user_id", "product_id", "interaction_type", "ts"]
    return interactions.select(cols).unionByName(additions(toggles, resets))


def profile_counts(wishlist: DataFrame, cart: DataFrame, history: DataFrame) -> DataFrame:
    """Per user the wishlist, cart and history sizes (users with any of them). One union and one
    aggregation (partial before the shuffle) instead of two full outer joins."""
    def tag(df, w, c, h):
        return df.select("user_id", F.lit(w).alias("w"), F.lit(c).alias("c"), F.lit(h).alias("h"))
    u = tag(wishlist, 1, 0, 0).unionByName(tag(cart, 0, 1, 0)).unionByName(tag(history, 0, 0, 1))
    return u.groupBy("user_id").agg(F.sum("w").cast("bigint").alias("wishlist_count"),
                                    F.sum("c").cast("bigint").alias("cart_count"),
                                    F.sum("h").cast("bigint").alias("interaction_count"))


def state_after_reset(resets: DataFrame, wishlist: DataFrame, cart: DataFrame, history: DataFrame) -> DataFrame:
    """ST5: for every user with a reset, what survives it."""
    counts = profile_counts(wishlist, cart, history)
    return (resets.join(counts, "user_id", "left")
            .fillna(0, subset=["wishlist_count", "cart_count", "interaction_count"]))


def hourly_sessions(interactions: DataFrame) -> DataFrame:
    """ST6: tumbling one-hour activity buckets per user, with the hour's session key."""
    g = interactions.groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n_events"))
    return g.select("user_id", F.col("w.start").alias("window_start"), "n_events",
                    session_key("user_id", F.col("w.start")).alias("hour_session_id"))
