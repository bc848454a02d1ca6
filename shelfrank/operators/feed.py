"""Feed re-ranker, batch form.

A user's feed comes from the user's recent history: the last ``HISTORY_CAP`` events after the last
reset. Per product of that history a time-decayed weight decides how many slots its similar and
complementary lists get; ``personal_feed`` fills the slots greedily (see ``feed_fold``).
Every per-user list is bounded (50 events, 5 + 5 candidates per product, 8 popular per category).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import constants as C
from shelfrank.functions.columns import decay_weight, hours_between, md5_order, round_half_up
from shelfrank.operators.ordering import md5_positions, walk


def after_reset(events: DataFrame, resets: DataFrame | None) -> DataFrame:
    """ST5 tombstone: drop each user's events up to and including the last reset event id."""
    if resets is None:
        return events
    r = resets.select("user_id", "reset_event_id")
    return (events.join(r, "user_id", "left")
            .filter(F.col("reset_event_id").isNull() | (F.col("event_id") > F.col("reset_event_id")))
            .drop("reset_event_id"))


def recent_interactions(interactions: DataFrame, resets: DataFrame | None = None,
                        cap: int = C.HISTORY_CAP) -> DataFrame:
    """Each user's last ``cap`` events (newest = recency_rank 1), ordered by ts, then event_id.
    row_number <= cap is a WindowGroupLimit: a hot user sends at most ``cap`` rows per task."""
    ev = after_reset(interactions, resets)
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return (ev.withColumn("recency_rank", F.row_number().over(w)).filter(F.col("recency_rank") <= cap)
            .select("user_id", "event_id", "product_id", "interaction_type", "ts", "recency_rank"))


def recency_frequency(history: DataFrame) -> DataFrame:
    """Per (user, product) of the history the last timestamp and the number of events."""
    return history.groupBy("user_id", "product_id").agg(F.max("ts").alias("last_ts"),
                                                        F.count("*").alias("event_count"))


def latest_ts(interactions: DataFrame) -> F.Column:
    """The default ``now`` of the re-ranker: max(ts) of the log, as a scalar subquery (no driver trip)."""
    return interactions.select(F.max("ts")).scalar()


def time_decay_weights(history: DataFrame, now, half_life: float = C.DECAY_HALF_LIFE_HOURS) -> DataFrame:
    """F1: weight = 0.5^(max(0, hours since last event) / half_life) * (1 + log2(1 + count)); a future
    event counts as 0 hours. ``now`` is a timestamp column or literal."""
    rf = recency_frequency(history)
    hours = hours_between(now, F.col("last_ts"))
    return (rf.withColumn("hours_ago", F.greatest(F.lit(0.0), hours))
            .withColumn("weight", decay_weight(F.col("hours_ago"), F.col("event_count"), half_life)))


def feed_slots(weights: DataFrame, feed_size: int = C.FEED_SIZE) -> DataFrame:
    """per anchor product, slots = max(1, round_half_up(weight / user total * feed_size)),
    similar share = ceil(0.6 * slots) computed exactly as (3 * slots + 4) div 5, rest complementary.
    weight_rank orders anchors by weight desc, product_id asc (the reference's stable sort)."""
    per_user = Window.partitionBy("user_id")
    ranked = Window.partitionBy("user_id").orderBy(F.desc("weight"), F.asc("product_id"))
    slots = F.greatest(F.lit(1), F.floor(F.col("weight") / F.col("total_weight") * F.lit(float(feed_size)) + 0.5)).cast("int")
    return (weights.withColumn("total_weight", F.sum("weight").over(per_user))
            .withColumn("weight_rank", F.row_number().over(ranked))
            .withColumn("slots", slots)
            .withColumn("sim_slots", F.floor((F.col("slots") * 3 + 4) / 5).cast("int"))
            .withColumn("comp_slots", F.col("slots") - F.col("sim_slots")))


def top_influencers(slots: DataFrame, products: DataFrame, n: int = C.INFLUENCERS_SHOWN) -> DataFrame:
    """The ``n`` heaviest anchors per user with their names; unknown products are dropped
    after the cut (so a user may get fewer than n)."""
    top = slots.filter(F.col("weight_rank") <= n).select("user_id", "product_id", F.col("weight_rank").alias("influence_rank"))
    return top.join(products.select("product_id", "product_name"), "product_id")


def profile_history(history: DataFrame, products: DataFrame, n: int = C.HISTORY_SHOWN) -> DataFrame:
    """The ``n`` newest events per user with the product name, or 'Product #<id>' if unknown."""
    h = history.filter(F.col("recency_rank") <= n)
    return (h.join(products.select("product_id", "product_name"), "product_id", "left")
            .select("user_id", "recency_rank", "event_id", "product_id", "interaction_type", "ts",
                    F.coalesce(F.col("product_name"),
                               F.concat(F.lit("Product #"), F.col("product_id").cast("string"))).alias("label")))


def user_top_products(interactions: DataFrame, n: int = C.BASELINE_TOP_PRODUCTS) -> DataFrame:
    """Per user the ``n`` products with the highest summed score (ties: product_id asc)."""
    s = interactions.groupBy("user_id", "product_id").agg(F.sum("interaction_score").cast("bigint").alias("score"))
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("product_id"))
    return s.withColumn("top_rank", F.row_number().over(w)).filter(F.col("top_rank") <= n)


def user_top_category(top_products: DataFrame, products: DataFrame) -> DataFrame:
    """The most frequent category among a user's top products; a tie goes to the category seen
    first in rank order. Products missing from the catalogue are skipped."""
    j = top_products.join(products.select("product_id", "category"), "product_id")
    c = j.groupBy("user_id", "category").agg(F.count("*").alias("category_count"),
                                             F.min("top_rank").alias("first_rank"))
    w = Window.partitionBy("user_id").orderBy(F.desc("category_count"), F.asc("first_rank"))
    return (c.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("user_id", F.col("category").alias("top_category"), "category_count"))


# ---------------------------------------------------------------- categories of a user

def category_index(products: DataFrame) -> DataFrame:
    """Categories numbered 0.. in sorted order (a dimension table: one row per category)."""
    cats = products.select("category").filter(F.col("category").isNotNull()).distinct()
    return cats.withColumn("ci", F.row_number().over(Window.orderBy("category")) - 1)


def latest_preferences(updates: DataFrame, products: DataFrame, resets: DataFrame | None = None,
                       min_categories: int = C.MIN_PREFERRED_CATEGORIES) -> DataFrame:
    """ST4: per user the last valid preference update (at least ``min_categories``), last write by
    (ts, event_id) wins, updates up to a reset ignored. Categories are [c1, c2, c2 + 1] (indices into
    the sorted categories, wrapping), the first n_categories of them, as an ordered array."""
    valid = after_reset(updates, resets).filter(F.col("n_categories") >= min_categories)
    last = valid.groupBy("user_id").agg(
        F.max_by(F.struct("event_id", "c1", "c2", "n_categories"), F.struct("ts", "event_id")).alias("u"))
    return name_categories(last.select("user_id", "u.*"), products)


def latest_preference_lists(updates: DataFrame, resets: DataFrame | None = None,
                            min_categories: int = C.MIN_PREFERRED_CATEGORIES) -> DataFrame:
    """ST4 on updates that hold the chosen categories themselves: (event_id, user_id, ts, categories
    array<string>). Per user the last update by (ts, event_id) with at least ``min_categories`` entries, nulls
    not counted, in the order chosen; updates up to a reset are ignored."""
    known = updates.withColumn("categories", F.filter("categories", lambda c: c.isNotNull()))
    valid = after_reset(known, resets).filter(F.size("categories") >= min_categories)
    return valid.groupBy("user_id").agg(
        F.max_by(F.struct("event_id", "categories"), F.struct("ts", "event_id")).alias("u")).select("user_id", "u.*")


def name_categories(picks: DataFrame, products: DataFrame) -> DataFrame:
    """(user_id, event_id, c1, c2, n_categories) -> (user_id, event_id, categories): the first
    n_categories of [c1, c2, c2 + 1] (indices into the sorted categories, wrapping), named, in order."""
    idx = category_index(products)
    n_cat = idx.select(F.count("*")).scalar()
    slots = F.slice(F.array(F.col("c1"), F.col("c2"), F.pmod(F.col("c2") + 1, n_cat)), 1,
                    F.col("n_categories").cast("int"))
    exploded = picks.select("user_id", "event_id", F.posexplode(slots).alias("cat_order", "ci"))
    named = exploded.join(idx, "ci")
    return (named.groupBy("user_id", "event_id")
            .agg(F.array_sort(F.collect_list(F.struct("cat_order", "category"))).alias("_c"))
            .select("user_id", "event_id", F.transform("_c", lambda s: s["category"]).alias("categories")))


def user_categories(users: DataFrame, preferences: DataFrame, products: DataFrame) -> DataFrame:
    """Each user's chosen categories: the latest valid update, else [preferred_category, the next
    category in sorted order]."""
    idx = category_index(products)
    n_cat = idx.select(F.count("*")).scalar()
    pref = users.select("user_id", "preferred_category").join(
        idx.select(F.col("category").alias("preferred_category"), "ci"), "preferred_category", "left")
    nxt = idx.select(F.col("ci").alias("next_ci"), F.col("category").alias("next_category"))
    default = (pref.withColumn("next_ci", F.pmod(F.col("ci") + 1, n_cat)).join(nxt, "next_ci", "left")
               .select("user_id", F.filter(F.array("preferred_category", "next_category"),
                                           lambda x: x.isNotNull()).alias("default_categories")))
    return (default.join(preferences.select("user_id", "categories"), "user_id", "left")
            .select("user_id", F.coalesce("categories", "default_categories").alias("categories")))


# ---------------------------------------------------------------- cold start, sections, detail

def cold_start_feed(users_categories: DataFrame, popular: DataFrame, active_users: DataFrame,
                    per_category: int = C.COLD_START_PER_CATEGORY, size: int = C.COLD_START_SIZE) -> DataFrame:
    """F5 + W12: users without history get the top ``per_category`` popular products of each chosen
    category, in a per-user md5 shuffle, the first ``size``."""
    cold = users_categories.join(active_users.select("user_id").distinct(), "user_id", "left_anti")
    cats = cold.select("user_id", F.posexplode("categories").alias("cat_order", "category"))
    top = popular.filter(F.col("rank") <= per_category).select("category", "product_id")
    cand = cats.join(top, "category")
    w = Window.partitionBy("user_id").orderBy(md5_order("user_id", "product_id"), F.asc("product_id"))
    return (cand.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= size)
            .select("user_id", "position", "product_id"))


def category_sections(users_categories: DataFrame, products: DataFrame,
                      picks: int = C.CATEGORY_SECTION_PICKS) -> DataFrame:
    """F8 + W9: per user and chosen category the category's product count and ``picks`` products of a
    per-user shuffle (consecutive md5 positions from a hashed start), as an ordered id list."""
    positioned = md5_positions(products.select("category", "product_id").filter(F.col("category").isNotNull()),
                               ["category"], "product_id", size_col="category_count")
    req = users_categories.select("user_id", F.posexplode("categories").alias("cat_order", "category"))
    got = walk(req, positioned, ["category"], ["user_id", "category"], picks, size_col="category_count")
    counts = positioned.select("category", "category_count").distinct()
    sect = (got.groupBy("user_id", "cat_order", "category")
            .agg(F.array_sort(F.collect_list(F.struct("step", "product_id"))).alias("_p")))
    return (sect.join(counts, "category")
            .select("user_id", "cat_order", "category", "category_count",
                    F.array_join(F.transform("_p", lambda s: s["product_id"].cast("string")), ",").alias("picks")))


def ranked_ids(df: DataFrame, key: str, rank: str, item: str, out: str) -> DataFrame:
    """Per ``key`` the ``item`` ids in ``rank`` order as an array (lists here hold at most 5 ids)."""
    return (df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(rank, item))).alias("_l"))
            .select(key, F.transform("_l", lambda s: s[item]).alias(out)))


def product_detail(products: DataFrame, similar: DataFrame, complementary: DataFrame) -> DataFrame:
    """F7 + J10: each product with its similar and complementary id lists (empty when none)."""
    sim = ranked_ids(similar, "source_product_id", "sim_rank", "similar_product_id", "similar_ids")
    comp = ranked_ids(complementary, "source_product_id", "comp_rank", "comp_product_id", "complementary_ids")
    empty = F.array().cast("array<bigint>")
    return (products.select("product_id", "product_name", "category", "sub_category", "brand", "price", "avg_rating")
            .join(sim.withColumnRenamed("source_product_id", "product_id"), "product_id", "left")
            .join(comp.withColumnRenamed("source_product_id", "product_id"), "product_id", "left")
            .withColumn("similar_ids", F.coalesce("similar_ids", empty))
            .withColumn("complementary_ids", F.coalesce("complementary_ids", empty)))


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_half_up(c, digits) for c in cols})


# ---------------------------------------------------------------- greedy fill

def _fill_candidates(slots: DataFrame, similar: DataFrame, complementary: DataFrame, products: DataFrame,
                     user_cats: DataFrame) -> DataFrame:
    """Per (user, anchor) the similar (src 0) and complementary (src 1) candidates with their quota
    and whether the candidate is in the catalogue and in one of the user's categories."""
    anchors = slots.select("user_id", F.col("product_id").alias("anchor_id"), "weight_rank", "sim_slots", "comp_slots")
    sim = similar.select(F.col("source_product_id").alias("anchor_id"), F.lit(0).alias("src"),
                         F.col("sim_rank").alias("cand_rank"), F.col("similar_product_id").alias("pid"))
    comp = complementary.select(F.col("source_product_id").alias("anchor_id"), F.lit(1).alias("src"),
                                F.col("comp_rank").alias("cand_rank"), F.col("comp_product_id").alias("pid"))
    lists = sim.unionByName(comp)
    cand = anchors.join(lists, "anchor_id")
    cand = cand.join(products.select(F.col("product_id").alias("pid"), F.col("category").alias("pcat")), "pid", "left")
    cand = cand.join(user_cats.select("user_id", "categories"), "user_id", "left")
    ok = F.col("pcat").isNotNull() & F.coalesce(F.array_contains("categories", F.col("pcat")), F.lit(False))
    return cand.select(
        "user_id",
        F.struct((F.col("weight_rank") * 2 + F.col("src")).cast("int").alias("key"),
                 F.col("cand_rank").cast("int").alias("cand_rank"),
                 F.col("pid").cast("bigint").alias("pid"),
                 F.when(F.col("src") == 0, F.col("sim_slots")).otherwise(F.col("comp_slots")).cast("int").alias("quota"),
                 ok.alias("ok")).alias("c"))


def personal_feed(slots: DataFrame, similar: DataFrame, complementary: DataFrame, products: DataFrame,
                  user_cats: DataFrame, popular: DataFrame, size: int = C.FEED_SIZE,
                  pad_below: int = C.FEED_PAD_BELOW) -> DataFrame:
    """F3 + F4: each user's feed (user_id, position, product_id).

    F3: anchors in weight order; for each, up to sim_slots similar then up to comp_slots
    complementary products are taken, skipping products already seen (the anchors and earlier
    picks) and products outside the user's categories. F4: when fewer than ``pad_below`` were taken,
    popular products of the user's categories (category order, then rank) are appended while the
    feed is shorter than ``size``, skipping seen ones (slots do not apply). The result is cut to ``size``.

    Both steps are ``aggregate`` folds over one bounded array per user (at most 50 anchors x 10
    candidates, and 8 popular per category): sequential per user, parallel over users, no Python.
    """
    cand = _fill_candidates(slots, similar, complementary, products, user_cats)
    per_user = cand.groupBy("user_id").agg(F.array_sort(F.collect_list("c")).alias("cands"))
    anchors = slots.groupBy("user_id").agg(F.collect_list(F.col("product_id").cast("bigint")).alias("anchors"))
    pop = (user_cats.select("user_id", F.posexplode("categories").alias("cat_order", "category"))
           .join(popular.filter(F.col("category").isNotNull())
                 .select("category", F.col("rank").alias("pop_rank"), F.col("product_id").cast("bigint").alias("pid")),
                 "category")
           .groupBy("user_id")
           .agg(F.array_sort(F.collect_list(F.struct("cat_order", "pop_rank", "pid"))).alias("pops")))
    base = (anchors.join(per_user, "user_id", "left").join(pop, "user_id", "left")
            .withColumn("cands", F.coalesce("cands", F.array().cast(per_user.schema["cands"].dataType)))
            .withColumn("pops", F.coalesce("pops", F.array().cast(pop.schema["pops"].dataType))))

    empty = F.array().cast("array<bigint>")
    start = F.struct(empty.alias("picked"), F.lit(-1).alias("key"), F.lit(0).alias("used"))

    def take(acc, c):
        used = F.when(c["key"] != acc["key"], F.lit(0)).otherwise(acc["used"])
        ok = ((used < c["quota"]) & c["ok"] & ~F.array_contains(F.col("anchors"), c["pid"])
              & ~F.array_contains(acc["picked"], c["pid"]))
        return F.struct(F.when(ok, F.concat(acc["picked"], F.array(c["pid"]))).otherwise(acc["picked"]).alias("picked"),
                        c["key"].alias("key"),
                        F.when(ok, used + 1).otherwise(used).alias("used"))

    def pad(acc, p):
        ok = ((F.size(acc) < size) & ~F.array_contains(F.col("anchors"), p["pid"])
              & ~F.array_contains(acc, p["pid"]))
        return F.when(ok, F.concat(acc, F.array(p["pid"]))).otherwise(acc)

    filled = base.withColumn("picked", F.aggregate("cands", start, take, lambda s: s["picked"]))
    padded = filled.withColumn(
        "picked", F.when(F.size("picked") < pad_below, F.aggregate("pops", F.col("picked"), pad)).otherwise(F.col("picked")))
    return (padded.select("user_id", F.posexplode(F.slice("picked", 1, size)).alias("pos0", "product_id"))
            .select("user_id", (F.col("pos0") + 1).alias("position"), "product_id"))


def feed_candidates(slots: DataFrame, similar: DataFrame, complementary: DataFrame, user_cats: DataFrame,
                    popular: DataFrame) -> DataFrame:
    """Every user's candidate products from several sources, first occurrence wins: similar
    lists of the anchors (source 0), their complementary lists (source 1), then popular products of
    the user's categories (source 2); order = (source, anchor weight rank / category order, rank).
    The user's own anchors are not candidates."""
    a = slots.select("user_id", F.col("product_id").alias("anchor_id"), "weight_rank")
    sim = a.join(similar.select(F.col("source_product_id").alias("anchor_id"), F.col("sim_rank").alias("cand_rank"),
                                F.col("similar_product_id").alias("product_id")), "anchor_id")
    comp = a.join(complementary.select(F.col("source_product_id").alias("anchor_id"), F.col("comp_rank").alias("cand_rank"),
                                       F.col("comp_product_id").alias("product_id")), "anchor_id")
    pop = (user_cats.join(a.select("user_id").distinct(), "user_id", "left_semi")
           .select("user_id", F.posexplode("categories").alias("weight_rank", "category"))
           .join(popular.filter(F.col("category").isNotNull())
                 .select("category", F.col("rank").alias("cand_rank"), "product_id"), "category"))
    u = (sim.select("user_id", "product_id", F.lit(0).alias("source"), "weight_rank", "cand_rank")
         .unionByName(comp.select("user_id", "product_id", F.lit(1).alias("source"), "weight_rank", "cand_rank"))
         .unionByName(pop.select("user_id", "product_id", F.lit(2).alias("source"), "weight_rank", "cand_rank")))
    u = u.join(slots.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    first = Window.partitionBy("user_id", "product_id").orderBy("source", "weight_rank", "cand_rank")
    return (u.withColumn("_f", F.row_number().over(first)).filter("_f = 1").drop("_f"))


def feed_explanation(influencers: DataFrame) -> DataFrame:
    """per user the names of the top influencing products, in influence order, as one text."""
    g = influencers.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("influence_rank", "product_name"))).alias("_n"))
    return g.select("user_id", F.array_join(F.transform("_n", lambda s: s["product_name"]), ", ").alias("influenced_by"))


def user_product_detail(detail: DataFrame, requests: DataFrame, wishlist: DataFrame, cart: DataFrame) -> DataFrame:
    """product detail for (user_id, product_id) requests with the user's wishlist and cart flags."""
    wl = wishlist.select("user_id", "product_id", F.lit(True).alias("in_wishlist"))
    ct = cart.select("user_id", "product_id", F.lit(True).alias("in_cart"))
    return (requests.select("user_id", "product_id").distinct()
            .join(detail, "product_id")
            .join(wl, ["user_id", "product_id"], "left").join(ct, ["user_id", "product_id"], "left")
            .fillna(False, subset=["in_wishlist", "in_cart"]))
