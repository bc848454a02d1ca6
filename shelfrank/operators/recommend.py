"""Top-n unseen products per user from factor tables.

The users x products table is never materialised. Products lie in blocks of descending norm, users in buckets; a
``cogroup`` on (bucket, block) hands one task a bounded W block and H block, numpy multiplies them, masks the pairs
the user has seen and keeps each user's top n. Only n candidates per user per block leave the task; a final
row_number <= n per user merges the blocks.

Most pairs are never scored. The first block holds the products of the greatest norms; every user meets it, and the user's
n-th best score there is a bound. No product of a block can beat it if the user's norm times the block's greatest
norm doesn't (Cauchy-Schwarz), and as norms only fall from block to block, a user needs a prefix of the blocks.
Users go to these only, in buckets of users that need about as many, and a block goes to the buckets that need it.

A task holds one user block and one item block and scores CHUNK users at a time, so large blocks cost little memory.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.functions import constants as C
from shelfrank.functions.columns import round_half_up
from shelfrank.plans.store import Store

#: Users scored together (times the item block, a matrix of doubles).
CHUNK = 256

#: Products that a user copy meets at least, where there are as many (times CHUNK users, a matrix of doubles).
SPAN = 16_384

CANDIDATE_SCHEMA = "user_id long, product_id long, score double"


def _block(col: str, n: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


def _norm(factors: str = "factors") -> Column:
    return F.sqrt(F.aggregate(factors, F.lit(0.0), lambda s, x: s + x * x))


#: Norms are binned by sixteenths of a power of two; finite doubles have some 34,000 such bins, so this is all
#: that the driver ever holds of them.
BINS_PER_OCTAVE = 16
#: Scores and norms are rounded; a block is skipped only if it is this much (relatively) too light.
SLACK = 1e-9


def _bin(norm: Column) -> Column:
    """Greater norms have smaller bins. Norms that are not finite come first (and are never skipped), zeros last."""
    finite = (norm > 0) & (norm < F.lit(float("inf")))
    step = -F.floor(F.log2(F.when(finite, norm)) * BINS_PER_OCTAVE)
    return F.when(norm == 0, F.lit(1 << 20)).otherwise(F.coalesce(step, F.lit(-(1 << 20)))).cast("int")


def norm_blocks(spark: SparkSession, items: DataFrame, item_block: int) -> tuple[DataFrame, list[float]]:
    """``items`` with their block ``ib``, and each block's greatest norm, descending. A block has about ``item_block`` rows at most:
    neighbouring bins share one, and a larger bin is split by a hash of the id."""
    items = items.withColumn("_norm", _norm()).withColumn("_bin", _bin(F.col("_norm")))
    places, tops, room = [], [], 0
    for b, n, top in sorted(tuple(r) for r in items.groupBy("_bin").agg(F.count("*"), F.max("_norm")).collect()):
        parts = max(1, math.ceil(n / item_block))
        top = top if top is not None and math.isfinite(top) else math.inf
        if n > room:
            tops += [top] * parts
            room = item_block if parts == 1 else 0
        places.append((b, len(tops) - parts, parts))
        room = max(0, room - n)
    bins = spark.createDataFrame(places, "_bin int, _first int, _parts int")
    part = F.pmod(F.xxhash64("product_id"), F.col("_parts"))
    return items.join(F.broadcast(bins), "_bin").withColumn("ib", (F.col("_first") + part).cast("int")).drop("_norm", "_bin", "_first", "_parts"), tops


def _reach(tops: list[float]):
    """How many blocks a user needs: those whose greatest norm times the user's can reach the bound. All without a bound."""
    falling = -np.array(tops)

    @F.pandas_udf("int")
    def reach(norm: pd.Series, bound: pd.Series) -> pd.Series:
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(norm > 0, bound / norm, np.where(bound > 0, np.inf, -np.inf)) * (1 - SLACK)
        needed = np.where(np.isnan(needed) | (bound <= 0), -np.inf, needed)
        return pd.Series(np.searchsorted(falling, -needed, side="right"))
    return reach


def bounds(first: DataFrame, users: DataFrame, tops: list[float], n: int) -> DataFrame:
    """(user_id, reach): the prefix of blocks that a user needs, from the best rows of the first block."""
    best = first.groupBy("user_id").agg(F.min("score").alias("bound"), F.count("*").alias("found"))
    rows = users.select("user_id", _norm().alias("norm")).join(best, "user_id", "left")
    bound = F.when(F.col("found") >= n, F.col("bound"))
    return rows.select("user_id", _reach(tops)("norm", bound.cast("double")).alias("reach"))


def _seen_lists(seen: DataFrame, items: DataFrame) -> DataFrame:
    """Seen products by (user, item block): a copy of a user row carries only those of its block, so the seen pairs are moved
    once in total, not once per block."""
    return (seen.select("user_id", "product_id").join(items.select("product_id", "ib"), "product_id")
            .groupBy("user_id", "ib").agg(F.collect_set("product_id").alias("seen")))


def _scored(users: DataFrame, items: DataFrame, seen_lists: DataFrame | None, n: int) -> DataFrame:
    """The best ``n`` unseen products of each user (user_id, factors, ub, ib) in each block that the user is sent to."""
    if seen_lists is not None:
        users = users.join(seen_lists, ["user_id", "ib"], "left")
    users = users.withColumn("seen", F.coalesce("seen", F.array().cast("array<bigint>")))

    def top_block(u: pd.DataFrame, it: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(u) and len(it):
            it = it.sort_values("product_id")
            pids, H = it["product_id"].to_numpy(np.int64), np.vstack(it["factors"].to_numpy())
            uids, W = u["user_id"].to_numpy(np.int64), np.vstack(u["factors"].to_numpy())
            lengths = u["seen"].map(len).to_numpy()
            seen = np.concatenate([np.asarray(x, np.int64) for x in u["seen"]]) if lengths.sum() else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(u)), lengths)
            col = np.searchsorted(pids, seen)
            col[col == len(pids)] = 0
            known = pids[col] == seen
            row, col = row[known], col[known]
            parts = []
            for at in range(0, len(u), CHUNK):
                S = W[at:at + CHUNK] @ H.T
                mine = (row >= at) & (row < at + CHUNK)
                S[row[mine] - at, col[mine]] = -np.inf
                m = min(n, S.shape[1])
                # Everything at least as good as the m-th best, ties too; the cut below takes the smaller ids.
                least = -np.partition(-S, m - 1, axis=1)[:, m - 1:m]
                r, c = np.nonzero((S >= least) & np.isfinite(S))
                order = np.lexsort((c, -S[r, c], r))
                r, c = r[order], c[order]
                place = np.arange(len(r)) - np.searchsorted(r, r)
                r, c = r[place < m], c[place < m]
                parts.append((uids[at + r], pids[c], S[r, c]))
            out = [np.concatenate(x) for x in zip(*parts)]
        return pd.DataFrame({"user_id": out[0], "product_id": out[1], "score": out[2]})

    return (users.groupBy("ub", "ib").cogroup(items.select("product_id", "factors", "ub", "ib").groupBy("ub", "ib"))
            .applyInPandas(top_block, CANDIDATE_SCHEMA))


def score_top_n(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame, k: int,
                n: int = C.RECOMMENDATIONS_PER_USER, user_block: int = 16_384, item_block: int = 16_384) -> DataFrame:
    """Per user the ``n`` best products not in ``seen`` (user_id, product_id), by score desc, product_id asc.

    user_factors: (user_id, factors); item_factors: (product_id, factors). Returns (user_id,
    product_id, score, rec_rank). Users with fewer than n unseen products get fewer rows.
    """
    spark = user_factors.sparkSession
    counts = (user_factors.select(F.count("*").alias("c")).first()["c"],
              item_factors.select(F.count("*").alias("c")).first()["c"])
    users, items = user_factors.select("user_id", "factors"), item_factors.select("product_id", "factors")
    if counts[1] <= item_block:  # one block: nothing to skip
        lists = seen.select("user_id", "product_id").groupBy("user_id").agg(F.collect_set("product_id").alias("seen"))
        n_ub = max(1, math.ceil(counts[0] / user_block))
        all_users = users.withColumn("ub", _block("user_id", n_ub)).withColumn("ib", F.lit(0)).join(lists, "user_id", "left")
        buckets = F.explode(F.sequence(F.lit(0), F.lit(n_ub - 1)))
        cand = _scored(all_users, items.withColumn("ib", F.lit(0)).withColumn("ub", buckets), None, n)
    else:
        cand = _pruned(spark, users, items, seen, n, counts[0], user_block, item_block)
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("product_id"))
    return cand.withColumn("rec_rank", F.row_number().over(w)).filter(F.col("rec_rank") <= n)


def _pruned(spark: SparkSession, users: DataFrame, items: DataFrame, seen: DataFrame, n: int, n_users: int, user_block: int, item_block: int) -> DataFrame:
    """Candidates of all users: from the first block, then from the other blocks of each user's prefix."""
    store = Store(spark, "recommend")
    items, tops = norm_blocks(spark, items, item_block)
    items = store.table(items, "items")
    lists = store.table(_seen_lists(seen, items), "seen")
    n_ub = max(1, math.ceil(n_users / user_block))
    head = items.filter("ib = 0").withColumn("ub", F.explode(F.sequence(F.lit(0), F.lit(n_ub - 1))))
    first = store.table(_scored(users.withColumn("ub", _block("user_id", n_ub)).withColumn("ib", F.lit(0)), head, lists, n), "first")
    reach = store.table(bounds(first, users, tops, n), "reach").filter("reach > 1")
    # Beyond the first block a user is copied to spans of blocks, not to each: what is moved follows the spans, however small the blocks.
    width = max(1, SPAN // item_block)

    def span(block: Column) -> Column:
        return F.when(block == 0, 0).otherwise(F.floor((block - 1) / width) + 1).cast("int")

    items = items.withColumn("ib", span(F.col("ib")))
    reach = reach.withColumn("reach", span(F.col("reach") - 1) + 1)
    lists = (lists.filter("ib > 0").groupBy("user_id", span(F.col("ib")).alias("ib")).agg(F.flatten(F.collect_list("seen")).alias("seen")))

    # Users of one class need a like number of blocks (powers of two), so a bucket's blocks are not for one user only.
    kind = F.ceil(F.log2("reach")).cast("int")
    classes = [(c, max(1, math.ceil(m / user_block)), most) for c, m, most in
               sorted(tuple(r) for r in reach.groupBy(kind.alias("c")).agg(F.count("*"), F.max("reach")).collect())]
    if not classes:
        return first
    start, buckets = 0, []
    for c, m, most in classes:
        buckets.append((c, start, m, most))
        start += m
    table = F.array(*[F.struct(*[F.lit(x).alias(name) for x, name in zip(row, ("c", "start", "n", "most"))]) for row in buckets])
    mine = F.filter(table, lambda x: x["c"] == kind)[0]
    ub = (mine["start"] + F.pmod(F.xxhash64("user_id"), mine["n"])).cast("int")
    more = users.join(reach, "user_id").withColumn("ub", ub).withColumn("ib", F.explode(F.sequence(F.lit(1), F.col("reach") - 1))).drop("reach")
    wanted = F.flatten(F.transform(F.filter(table, lambda x: x["most"] > F.col("ib")), lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)))
    rest = items.filter("ib > 0").withColumn("ub", F.explode(wanted))
    return first.unionByName(_scored(more, rest, lists, n))


def recommend_top_n(user_factors: DataFrame, item_factors: DataFrame, entries: DataFrame, products: DataFrame,
                    k: int, n: int = C.RECOMMENDATIONS_PER_USER, **blocks) -> DataFrame:
    """M5 + J1: top ``n`` unseen products per user (seen = any observed cell, train or test, trap T5),
    with catalogue details; predicted_score rounded to 3 decimals after ranking (trap T10)."""
    seen = entries.select("user_id", "product_id")
    top = score_top_n(user_factors, item_factors, seen, k, n, **blocks)
    details = products.select("product_id", "product_name", "category", "sub_category", "brand", "price", "avg_rating")
    return (top.join(details, "product_id", "left")
            .select("user_id", "rec_rank", "product_id", "product_name", "category", "sub_category", "brand", "price",
                    "avg_rating", round_half_up("score", 3).alias("predicted_score")))
